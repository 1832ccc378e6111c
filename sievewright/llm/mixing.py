"""Mixing sources to target weights, by repeating documents.

Tokens are summed per source in partial aggregates; targets and repetition
rates are computed on that small table. A document is emitted floor(rate)
times, plus one copy if a hash of its id, seeded, falls below the fraction.
Only DataFrame functions are used.

Null texts have size 0. Null sources are one source, the last. Without any
words every rate is 0. The draw follows the doc_id, and the text where there is
none: rows of one doc_id share a draw, and so do rows of one text without ids.
Reruns and other partitionings give the same copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievewright.llm.common import WORD, fresh, materialize, sized

WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = "mix-1"
_HASH_DIGITS = 13


def token_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size, target, rate) from (source, size), a row per document.

    Sources by code point, null last, take the weights in turn. A target stops
    at ``most`` times its source's size and the excess is shared again by
    weight: that fills all sources to one level per weight, found by passing
    over them in the order in which they reach their limits.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.row_number().over(ordered) - 1) % len(weights) + 1)
    weighted = per_source.withColumn("weight", weight.cast("long"))
    limit = F.col("source_size") * most
    filling = Window.orderBy((limit / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    steps = weighted.select(
        "source", "source_size", "weight", limit.alias("limit"),
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum(limit).over(before), F.lit(0)).alias("filled"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open"),
    )
    # the level per weight if just the sources before this one have reached their limits; the true one is the
    # first, and so the largest, that does not pass the limit of the source it stands at
    level = (F.col("total") - F.col("filled")) / F.col("open")
    fits = level * F.col("weight") <= F.col("limit")
    levels = steps.withColumn("level", F.max(F.when(fits, level)).over(everything))
    target = F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(0.0)
    return levels.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def draw(key: Column, otherwise: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from the text of ``key``, or from the text ``otherwise`` where there is no key."""
    instead = F.concat(F.lit("text:"), F.coalesce(otherwise, F.lit("")))
    text = F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), instead))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, _HASH_DIGITS), 16, 10).cast("double") / float(16**_HASH_DIGITS)


def copies(rate: Column, key: Column, otherwise: Column, seed: str = SEED) -> Column:
    extra = draw(key, otherwise, seed) < rate - F.floor(rate)
    return (F.floor(rate) + F.when(extra, 1).otherwise(0)).cast("long")


def with_copies(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    seed: str = SEED,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    result: str = "mix",
) -> DataFrame:
    """``docs`` with a column ``result`` (size, source_size, target, rate, copies)."""
    size = token_count(F.col(f"`{text_column}`"))
    rates = materialize(targets(docs.select(F.col(f"`{source_column}`").alias("source"), size.alias("size")), weights, most))
    source, share = fresh(docs, "_sw_source"), fresh(docs, "_sw_share")
    rates = sized(rates.select(F.col("source").alias(source), F.struct("source_size", "target", "rate").alias(share)))
    joined = docs.join(rates, F.col(f"`{source_column}`").eqNullSafe(F.col(source)), "left")
    rate = F.col(f"{share}.rate")
    made = F.struct(
        size.alias("size"),
        F.col(f"{share}.source_size").alias("source_size"),
        F.col(f"{share}.target").alias("target"),
        rate.alias("rate"),
        copies(rate, F.col(f"`{id_column}`"), F.col(f"`{text_column}`"), seed).alias("copies"),
    )
    return joined.withColumn(result, made).drop(source, share)


def mix(docs: DataFrame, **options) -> DataFrame:
    """Every document as many times as the mix takes it: the columns of ``docs`` and ``copy`` (from 1)."""
    result, copy = fresh(docs, "_sw_mix"), fresh(docs, "copy")
    done = with_copies(docs, result=result, **options).filter(F.col(f"{result}.copies") > 0)
    numbers = F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{result}.copies")))
    return done.withColumn(copy, numbers).drop(result)
