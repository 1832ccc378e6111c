"""Lists, keywords and text on documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright import defaults
from sievewright.operators import textops
from sievewright.queries.registry import query, rounded, table


def _tagged(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with a delimited tag list."""
    key = F.col("doc_id")
    tags = F.concat("lang", F.lit(" |"), "source", F.lit("| t"), (key % 5).cast("string"), F.lit("||"))
    return table(spark, folder, "documents").select(
        "doc_id", "lang", "n_chars", F.when(key % 9 != 0, tags).alias("tags")
    )


_TAGS = """
    tagged AS (SELECT doc_id, lang, n_chars, CASE WHEN doc_id % 9 <> 0
               THEN lang || ' |' || source || '| t' || (doc_id % 5) || '||' END AS tags FROM documents),
    elements AS (SELECT doc_id, lang, n_chars, trim(unnest(string_split(tags, '|'))) AS element FROM tagged)
"""


@query(
    "list_element_counts",
    f"WITH {_TAGS} SELECT element, count(*) AS rows FROM elements WHERE element <> '' GROUP BY element",
)
def list_element_counts(spark: SparkSession, folder: str) -> DataFrame:
    return textops.element_counts(_tagged(spark, folder), "tags")


@query(
    "list_element_counts_by_group",
    f"WITH {_TAGS} SELECT lang, element, count(*) AS rows FROM elements WHERE element <> '' GROUP BY ALL",
)
def list_element_counts_by_group(spark: SparkSession, folder: str) -> DataFrame:
    return textops.element_counts(_tagged(spark, folder), "tags", ["lang"])


@query(
    "list_array_elements",
    "SELECT label, count(*) AS elements, round(sum(x), 4) AS total FROM (SELECT label, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY label",
)
def list_array_elements(spark: SparkSession, folder: str) -> DataFrame:
    elements = textops.explode_list(table(spark, folder, "embeddings"), "embedding", ["label"])
    totals = elements.groupBy("label").agg(
        F.count("*").alias("elements"), F.sum(F.col("element").cast("double")).alias("total")
    )
    return rounded(totals, 4)


@query(
    "list_element_statistics",
    f"""
    WITH {_TAGS}
    SELECT element, count(*) AS count, round(avg(n_chars), 4) AS mean, round(quantile_cont(n_chars::DOUBLE, 0.5), 4) AS median
    FROM elements WHERE element <> '' GROUP BY element HAVING count(*) >= 30
    """,
)
def list_element_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(textops.element_statistics(_tagged(spark, folder), "tags", "n_chars", 30), 4)


KEYWORDS = ("the", "and", "la", "der", "license", "email", "zzz never")
_KEYWORD_ROWS = " UNION ALL ".join(
    rf"""SELECT '{k}' AS keyword, n_chars FROM documents
    WHERE regexp_matches(lower(text), '(?:^|[^\p{{L}}\p{{N}}_]){k}(?:$|[^\p{{L}}\p{{N}}_])')"""
    for k in KEYWORDS
)
_KEYWORD_LIST = ", ".join(f"('{k}')" for k in KEYWORDS)


@query(
    "keyword_statistics",
    f"""
    SELECT keyword, count(n_chars) AS occurrences, count(n_chars) AS "values", coalesce(round(avg(n_chars), 4), -1) AS mean,
           coalesce(round(quantile_cont(n_chars::DOUBLE, 0.5), 4), -1) AS median
    FROM (VALUES {_KEYWORD_LIST}) AS k(keyword) LEFT JOIN ({_KEYWORD_ROWS}) USING (keyword) GROUP BY keyword
    """,
)
def keyword_statistics(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = rounded(textops.keyword_statistics(documents, "text", "n_chars", KEYWORDS), 4)
    return found.fillna(-1.0, subset=["mean", "median"])


@query(
    "frequency_tiers",
    """
    SELECT count(*) AS distinct_values, count(*) FILTER (WHERE n = 1) AS seen_once, count(*) FILTER (WHERE n >= 5) AS at_least_5,
           count(*) FILTER (WHERE n >= 10) AS at_least_10, count(*) FILTER (WHERE n >= 50) AS at_least_50
    FROM (SELECT count(*) AS n FROM part GROUP BY p_name)
    """,
)
def frequency_tiers(spark: SparkSession, folder: str) -> DataFrame:
    return textops.frequency_tiers(table(spark, folder, "part"), "p_name")


@query(
    "text_lengths",
    r"""
    WITH clean AS (SELECT conv_id, turn, text, trim(regexp_replace(text, '[\s\x0b\x1c-\x1f\x85\p{Z}]+', ' ', 'g')) AS t FROM conversations)
    SELECT conv_id, turn, length(text) AS characters, CASE WHEN t = '' THEN 0 ELSE len(string_split(t, ' ')) END AS words FROM clean
    """,
)
def text_lengths(spark: SparkSession, folder: str) -> DataFrame:
    lengths = textops.text_lengths(F.col("text"))
    return table(spark, folder, "conversations").select("conv_id", "turn", *[c.alias(n) for n, c in lengths.items()])


_STOP = ", ".join(f"'{w}'" for w in defaults.TITLE_STOP_WORDS)
_TOKENS = f"""
    tokens AS (SELECT list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: w NOT IN ({_STOP})) AS t FROM documents)
"""


@query(
    "text_top_unigrams",
    f"WITH {_TOKENS} SELECT term, count(*) AS rows FROM (SELECT unnest(t) AS term FROM tokens) GROUP BY term ORDER BY rows DESC, term LIMIT 25",
)
def text_top_unigrams(spark: SparkSession, folder: str) -> DataFrame:
    return textops.top_unigrams(table(spark, folder, "documents"), "text", defaults.TITLE_STOP_WORDS, 25)


_TOP_BIGRAMS = f"""
    WITH {_TOKENS},
    pairs AS (SELECT unnest(list_zip(t[1:len(t) - 1], t[2:])) AS p FROM tokens WHERE len(t) > 1)
    SELECT p[1] || ' ' || p[2] AS term, count(*) AS rows FROM pairs GROUP BY 1 ORDER BY rows DESC, term LIMIT 25
"""


@query("text_top_bigrams_by_bounds", _TOP_BIGRAMS)
def text_top_bigrams_by_bounds(spark: SparkSession, folder: str) -> DataFrame:
    pairs = textops.bigrams(table(spark, folder, "documents"), "text", defaults.TITLE_STOP_WORDS)
    return textops.top_by_bounds(pairs, "term", 25, buckets=1 << 14)


@query("text_top_bigrams", _TOP_BIGRAMS)
def text_top_bigrams(spark: SparkSession, folder: str) -> DataFrame:
    return textops.top_bigrams(table(spark, folder, "documents"), "text", defaults.TITLE_STOP_WORDS, 25)


_LEAK = r"\$|salary|compensation|\bpay\b|per hour|per year|annually|license|@"


@query(
    "text_pattern_rates",
    rf"""
    SELECT count(*) AS rows, count(*) FILTER (WHERE hit) AS hits, round(100.0 * avg(hit::INT), 6) AS rate_percent,
           round(100.0 * avg(hit::INT) FILTER (WHERE lang = 'en'), 6) AS subset_rate_percent
    FROM (SELECT lang, regexp_matches(lower(text), '{_LEAK}') AS hit FROM documents)
    """,
)
def text_pattern_rates(spark: SparkSession, folder: str) -> DataFrame:
    patterns = (*defaults.SALARY_PATTERNS, "license", "@")
    return rounded(textops.pattern_rates(table(spark, folder, "documents"), "text", patterns, F.col("lang") == "en"))


@query(
    "text_snippets",
    """
    WITH hits AS (
      SELECT page_id, html, coalesce(nullif(instr(lower(html), 'salary'), 0), nullif(instr(lower(html), '</title>'), 0),
                                     nullif(instr(lower(html), '$'), 0)) AS position FROM pages)
    SELECT page_id, position, md5(substring(html, greatest(position - 60, 1), position + 80 - greatest(position - 60, 1))) AS digest
    FROM hits WHERE position IS NOT NULL
    """,
)
def text_snippets(spark: SparkSession, folder: str) -> DataFrame:
    found = textops.snippets(table(spark, folder, "pages"), ["page_id"], "html", ("salary", "</title>", "$"))
    return found.select("page_id", F.col("position").cast("bigint").alias("position"), F.md5("snippet").alias("digest"))
