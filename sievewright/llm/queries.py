"""The registered queries of the text operators, with their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.llm import (
    compression_quality,
    decontamination,
    hmm,
    language_id,
    line_dedup,
    minhash,
    mixing,
    repetition,
    simhash,
    token_alignment,
    toxicity,
    url_rules,
    vector_codes,
)
from sievewright.llm.common import is_fold, ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


URL_RULES = [
    url_rules.UrlRule("allow", "com"),
    url_rules.UrlRule("block", "example.com", "/en/"),
    url_rules.UrlRule("allow", "www.example.com", "/en/"),
    url_rules.UrlRule("block", "net", "/es/"),
    url_rules.UrlRule("block", "net", "/fr/"),
]


@query("op1_url_filters")
def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_rules.judge(_table(spark, folder, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", *[F.col(f"judged.{c}").alias(c) for c in ("host", "path", "rule", "verdict", "mined")])


def _coverage_sql() -> str:
    """Coverage by repeated word n-grams, a window per length."""
    tables, columns = [], []
    for length, _ in repetition.RULES.ngram_limits:
        gram = " || ' ' || ".join(["w", *(f"lead(w, {i}) OVER o" for i in range(1, length))])
        tables.append(
            f"""
    g{length} AS (SELECT doc_id, p, w, {gram} AS g FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
    d{length} AS (SELECT doc_id, p, w, (g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1)::INT AS twice FROM g{length}),
    c{length} AS (SELECT doc_id, w, max(twice) OVER (PARTITION BY doc_id ORDER BY p ROWS {length - 1} PRECEDING) AS inside FROM d{length}),
    t{length} AS (SELECT doc_id, count(*) AS n, sum(length(w)) AS chars FROM c{length} WHERE inside = 1 GROUP BY doc_id)"""
        )
        columns.append(f"coalesce(t{length}.chars, 0)::BIGINT AS dup_chars_{length}")
    joins = " ".join(f"LEFT JOIN t{length} USING (doc_id)" for length, _ in repetition.RULES.ngram_limits)
    over = " AND ".join(
        f"100 * dup_chars_{length} <= {most} * word_chars" for length, most in repetition.RULES.ngram_limits
    )
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    lists AS (SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM texts),
    words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM lists),
    rows AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS p FROM texts),
    ranked AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY p) AS nth
        FROM rows WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
    lines AS (SELECT doc_id, count(*) AS n, sum(length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g'))) AS chars
        FROM ranked WHERE nth > 1 GROUP BY doc_id),
    g3 AS (SELECT doc_id, p, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o AS g
        FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
    d3 AS (SELECT doc_id, p, (g IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, g) > 1)::INT AS twice FROM g3),
    c3 AS (SELECT doc_id, max(twice) OVER (PARTITION BY doc_id ORDER BY p ROWS 2 PRECEDING) AS inside FROM d3),
    t3 AS (SELECT doc_id, sum(inside) AS n FROM c3 GROUP BY doc_id),
    {",".join(tables)},
    measured AS (
        SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(lines.n, 0)::BIGINT AS n_dup_lines,
            coalesce(t3.n, 0)::BIGINT AS n_repeat_words, coalesce(lines.chars, 0)::BIGINT AS dup_line_chars, {", ".join(columns)}
        FROM lists LEFT JOIN lines USING (doc_id) LEFT JOIN t3 USING (doc_id) {joins}),
    judged AS (SELECT *, n_words < {repetition.RULES.min_words}
        OR 100 * n_repeat_words > {repetition.RULES.max_repeat_words} * n_words AS base_failed FROM measured)
    SELECT *, NOT base_failed AND 100 * dup_line_chars <= {repetition.RULES.max_line_characters} * word_chars AND {over} AS kept
    FROM judged
    """


@query("op2_quality_rules", _coverage_sql())
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.judge(_table(spark, folder, "documents"))


@query("op3_decontamination")
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def _labelled(spark: SparkSession, folder: str, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, label) of the labelled ids outside the held-out fold."""
    labels = _table(spark, folder, "labels").filter(~is_fold("doc_id", folds, held_out))
    return labels.select("doc_id", F.col(label).alias("label"))


def _predicted(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    held = is_fold("doc_id", folds, held_out).alias("held_out")
    return scored.select("doc_id", held, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op4_quality_classifier")
def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = compression_quality.train(docs, _labelled(spark, folder, "quality", 5, 0))
    return _predicted(compression_quality.score(docs, model), 5, 0)


@query("op5_language_id")
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(~is_fold("doc_id", 4, 2)))
    found = language_id.predict(docs, model)
    return found.select("doc_id", is_fold("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def mixed_sql(documents: str = "documents") -> str:
    """Rates and copies of the mix, as common table expressions that end in ``mixed``."""
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return f"""
    sized AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM {documents}),
    sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighted AS (SELECT *, {mixing.MOST_REPEATS} * source_size AS most,
        ([{weights}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1]::BIGINT AS weight FROM sums),
    steps AS (SELECT *, (sum(source_size) OVER ())::DOUBLE AS total,
        coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS filled,
        (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS open FROM weighted),
    levels AS (SELECT *, max(CASE WHEN (total - filled) / open * weight <= most THEN (total - filled) / open END) OVER () AS level FROM steps),
    rates AS (SELECT source, source_size, least(most::DOUBLE, level * weight) AS target,
        CASE WHEN source_size > 0 THEN least(most::DOUBLE, level * weight) / source_size ELSE 0.0 END AS rate FROM levels),
    mixed AS (SELECT d.*, source_size, target, rate, (floor(rate) + CASE WHEN
        CAST('0x' || md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, '')))[1:{mixing._HASH_DIGITS}] AS BIGINT)::DOUBLE / {float(16**mixing._HASH_DIGITS)!r}
        < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
        FROM sized d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source)
    """


@query(
    "op6_mixing",
    f"WITH {mixed_sql()} SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM mixed",
)
def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    mixed = mixing.with_copies(docs)
    parts = [F.col(f"mix.{c}").alias(c) for c in ("size", "source_size", "target")]
    return mixed.select("doc_id", *parts, (F.col("mix.size") * F.col("mix.copies")).alias("taken"), F.col("mix.copies").alias("copies"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _labelled(spark, folder, "toxic", 4, 2))
    return _predicted(toxicity.score(docs, model), 4, 2)


@query(
    "op8_line_dedup",
    f"""
    WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
    lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS p FROM texts),
    keyed AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
    repeated AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= {line_dedup.RULES.min_characters}
        GROUP BY k HAVING count(DISTINCT doc_id) >= {line_dedup.RULES.min_documents}),
    marked AS (SELECT doc_id, line, p, coalesce(doc_id > first, false) AS gone FROM keyed LEFT JOIN repeated USING (k))
    SELECT doc_id, count(*) AS n_lines, sum(gone::INT)::BIGINT AS n_dropped,
        sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(docs)
    return done.select("doc_id", "lines.n_lines", "lines.n_dropped", F.sha2("lines.text", 256).alias("kept_sha256"))


@query("op9_lm_scoring")
def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    scored, words, _ = hmm.train_and_score(docs, is_fold("doc_id", 5, 1))
    held, total = is_fold("doc_id", 5, 1).alias("held_out"), F.lit(words.total).cast("long").alias("train_tokens")
    return scored.select("doc_id", held, "n_tokens", "n_known", total, "base_score", "score")


@query("op10_simhash")
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


@query("op11_minhash")
def op11_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, folder, "documents"), minhash.MinHashRules(shingle=2))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_tokenizers(_table(spark, folder, "documents"))[0]


def _lloyd_sql(rules: vector_codes.CodeRules) -> str:
    """Every part against its whole codebook, once per round."""
    most = vector_codes.MOST
    steps = []
    for n in range(rules.rounds + 1):
        steps.append(f"""
    near{n} AS MATERIALIZED (SELECT vec_id, label, p, x, min((list_inner_product(x, x) - 2 * list_inner_product(x, c)
        + list_inner_product(c, c))::BIGINT * {rules.entries} + e) AS best FROM pieces JOIN book{n} USING (p) GROUP BY ALL),
    mean{n} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, (best % {rules.entries}) AS e, i, floor(sum(x[i]) / count(*)) AS m
        FROM near{n}, LATERAL (SELECT unnest(range(1, len(x) + 1)) AS i) GROUP BY ALL) GROUP BY ALL),
    book{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(mean{n}.c, book{n}.c) AS c FROM book{n} LEFT JOIN mean{n} USING (p, e))""")
    last = rules.rounds
    return f"""
    WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: greatest(least(floor({rules.scale} * x::DOUBLE), {most}), -{most})) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pieces AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {rules.parts} + 1 : (p + 1) * len(v) // {rules.parts}] AS x
        FROM kept, range({rules.parts}) t(p)),
    book0 AS MATERIALIZED (SELECT p, e, x AS c FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM pieces)
        WHERE e < {rules.entries}), {",".join(steps)},
    numbers AS (SELECT p, e, unnest(c)::BIGINT AS c, generate_subscripts(c, 1) AS i FROM book{last}),
    books AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, i)) AS h FROM numbers),
    codes AS (SELECT vec_id, label, string_agg(printf('%02x', best % {rules.entries}), '' ORDER BY p) AS code,
        sum(best // {rules.entries})::BIGINT AS error FROM near{last} GROUP BY vec_id, label)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, h AS codebooks_sha256 FROM codes, books
    """


@query("op13_vector_codes", _lloyd_sql(vector_codes.RULES))
def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = vector_codes.encode(_table(spark, folder, "embeddings"))
    done = vector_codes.with_label_errors(coded).select("vec_id", "code", "error", "label_error")
    return done.withColumn("codebooks_sha256", F.lit(vector_codes.books_sha256(books)))
