"""List, keyword and text queries. Texts are processed whole, in the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import columns as X
from sievewright.operators import quantiles



def explode_list(df: DataFrame, column: str, keep: Sequence[str] = (), element: str = "element") -> DataFrame:
    """One row per element of a list column (array or delimited text)."""
    items = X.parse_list(F.col(column), dict(df.dtypes)[column])
    return df.select(*keep, F.explode(items).alias(element))


def element_counts(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per list element, overall or within groups."""
    return explode_list(df, column, by).groupBy(*by, "element").agg(F.count("*").alias("rows"))


def element_statistics(df: DataFrame, column: str, value: str, min_support: int = 30) -> DataFrame:
    """Count, mean and median of a value per list element with enough rows."""
    elements = explode_list(df, column, [value]).filter(F.col(value).isNotNull())
    aggregates = [F.count("*").alias("count"), F.avg(value).alias("mean")]
    stats = quantiles.group_statistics(elements, ["element"], value, {"median": 0.5}, aggregates)
    return stats.filter(F.col("count") >= min_support)


def whole_word(keyword: str) -> str:
    """Pattern of a keyword between word boundaries; accented letters are letters.

    The keyword comes first, so the boundaries are only looked at where it occurs.
    """
    return rf"{keyword}(?<![\p{{L}}\p{{N}}_]{keyword})(?![\p{{L}}\p{{N}}_])"


def keyword_statistics(df: DataFrame, text: str, value: str, keywords: Sequence[str]) -> DataFrame:
    """Per keyword: texts that hold it as a whole word, and statistics of a value.

    Only hits are turned into rows; keywords without hits are kept with count 0.
    """
    lower = F.lower(F.col(text))
    hits = F.array_compact(F.array(*[F.when(lower.contains(k) & lower.rlike(whole_word(k)), F.lit(k)) for k in keywords]))
    found = df.select(F.explode(hits).alias("keyword"), F.col(value).cast("double").alias("value"))
    aggregates = [F.count("*").alias("occurrences"), F.count("value").alias("values"), F.avg("value").alias("mean")]
    stats = quantiles.group_statistics(found, ["keyword"], "value", {"median": 0.5}, aggregates)
    every = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(k) for k in keywords])).alias("keyword"))
    joined = every.join(stats, "keyword", "left")
    return joined.fillna(0, subset=["occurrences", "values"])


def frequency_tiers(df: DataFrame, column: str, tiers: Sequence[int] = (5, 10, 50)) -> DataFrame:
    """Distinct values, values seen once, and values seen at least n times."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(
        F.count("*").alias("distinct_values"),
        F.count_if(F.col("n") == 1).alias("seen_once"),
        *[F.count_if(F.col("n") >= t).alias(f"at_least_{t}") for t in tiers],
    )


def text_lengths(text: Column) -> dict[str, Column]:
    return {"characters": F.length(text).cast("bigint"), "words": X.word_count(text)}


def tokens(text: Column, stop_words: Sequence[str]) -> Column:
    """Lower-case runs of a-z without stop words, found by one pattern."""
    skip = rf"(?!(?:{'|'.join(stop_words)})(?![a-z]))" if stop_words else ""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"(?<![a-z]){skip}([a-z]+)"), 1)


def top_unigrams(df: DataFrame, text: str, stop_words: Sequence[str], n: int) -> DataFrame:
    words = df.select(F.explode(tokens(F.col(text), stop_words)).alias("term"))
    counts = words.groupBy("term").agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), "term").limit(n)


def top_by_bounds(terms: DataFrame, term: str, n: int, buckets: int = 1 << 16, first: int = 16) -> DataFrame:
    """:func:`top_unigrams` of a column of terms that shuffles few of them. Runs two jobs.

    Terms are counted per hash bucket first, ``buckets`` rows per task however
    many terms there are; a bucket's count bounds the count of every term in it.
    The terms of the ``first * n`` fullest buckets are counted, and the n-th of
    them bounds the n-th of all from below. Only terms of buckets that reach this
    bound can be among the first n, and the others never leave their tasks. The
    source is read three times. Exact, ties by term; null terms are no terms.
    """
    placed = terms.select(term, F.pmod(F.xxhash64(term), F.lit(buckets)).alias("_sw_bucket")).filter(F.col(term).isNotNull())
    bounds = placed.groupBy("_sw_bucket").agg(F.count(F.lit(1)).alias("rows"))
    ranked = bounds.orderBy(F.desc("rows"), "_sw_bucket").collect()  # one row per bucket

    def counted(chosen: Sequence[int]) -> DataFrame:
        keys = terms.sparkSession.createDataFrame([(b,) for b in chosen], "_sw_bucket bigint")
        kept = placed.join(F.broadcast(keys), "_sw_bucket", "left_semi")  # no more rows than buckets
        return kept.groupBy(term).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), term).limit(n)

    found = counted([r["_sw_bucket"] for r in ranked[: first * n]]).collect()  # n rows
    least = found[-1]["rows"] if len(found) == n else 0
    return counted([r["_sw_bucket"] for r in ranked if r["rows"] >= least])


def bigrams(df: DataFrame, text: str, stop_words: Sequence[str]) -> DataFrame:
    """``(term)``: every pair of neighbours after stop words are gone."""
    split = df.select(tokens(F.col(text), stop_words).alias("t"))
    last = F.greatest(F.size("t") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("t", F.lit(1), last), F.slice("t", F.lit(2), last), lambda a, b: F.concat_ws(" ", a, b))
    return split.select(F.explode(pairs).alias("term"))


def top_bigrams(df: DataFrame, text: str, stop_words: Sequence[str], n: int) -> DataFrame:
    """Most frequent neighbours after stop words are gone (linear in the text)."""
    split = df.select(tokens(F.col(text), stop_words).alias("t"))
    # no filter on the size: it would be pushed below the projection and tokenise every text twice
    last = F.greatest(F.size("t") - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice("t", F.lit(1), last).alias("a"), F.slice("t", F.lit(2), last).alias("b"))
    counts = split.select(F.inline(pairs).alias("a", "b")).groupBy("a", "b").agg(F.count("*").alias("rows"))
    terms = counts.select(F.concat_ws(" ", "a", "b").alias("term"), "rows")
    return terms.orderBy(F.desc("rows"), "term").limit(n)


def matches(text: Column, pattern: str) -> Column:
    """Whether a pattern occurs. Patterns without operators are searched as plain
    text; word boundaries are Unicode-aware."""
    bare = re.sub(r"\\([^\w\s])", r"\1", pattern)
    if not set(re.sub(r"\\[^\w\s]", "", pattern)) & set(".^$*+?{}[]\\|()"):
        return text.contains(bare)
    word = re.fullmatch(r"\\b([\w ]+)\\b", pattern)
    if word:
        return text.contains(word.group(1)) & text.rlike(whole_word(word.group(1)))
    return text.rlike(f"(?U){pattern}")


def pattern_rates(df: DataFrame, text: str, patterns: Sequence[str], subset: Column) -> DataFrame:
    """Share of texts, in percent, that match any pattern: overall and in a subset."""
    lower = F.lower(F.col(text))
    hit = F.coalesce(reduce(lambda a, b: a | b, [matches(lower, p) for p in patterns]), F.lit(False))
    counted = df.select(hit.alias("hit"), subset.alias("inside")).agg(
        F.count("*").alias("rows"),
        F.count_if("hit").alias("hits"),
        F.count_if("inside").alias("_sw_inside"),
        F.count_if(F.col("hit") & F.col("inside")).alias("_sw_both"),
    )
    return counted.select(
        "rows",
        "hits",
        X.ratio(F.col("hits"), F.col("rows")).alias("rate_percent"),
        X.ratio(F.col("_sw_both"), F.col("_sw_inside")).alias("subset_rate_percent"),
    )


def snippets(
    df: DataFrame, key: Sequence[str], text: str, terms: Sequence[str], before: int = 60, after: int = 80
) -> DataFrame:
    """Text around the first of ``terms`` that occurs; terms are tried in order."""
    lower = F.lower(F.col(text))
    positions = [F.nullif(F.instr(lower, t), F.lit(0)) for t in terms]
    found = df.select(*key, F.col(text), F.coalesce(*positions).alias("_sw_at")).filter("_sw_at is not null")
    start = F.greatest(F.col("_sw_at") - before, F.lit(1))
    return found.select(
        *key, F.col("_sw_at").alias("position"), F.substring(text, start, F.col("_sw_at") + after - start).alias("snippet")
    )
