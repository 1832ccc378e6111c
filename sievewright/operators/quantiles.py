"""Exact order statistics that hold for groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. Here
a group is cut into value ranges instead, by one plan for all sizes:

1. count each ``(group, value)`` (partial sums per task),
2. take range bounds per group from a bounded sketch (``percentile_approx``),
   and place the values by them; the few groups with a large share of all values
   are dealt out by salt, so theirs meet their bounds in :data:`SALTS` tasks,
3. sum the counts per ``(group, range)`` and run them up: at most ``RANGES``
   small rows per group,
4. order only inside ``(group, range)``, which spreads one hot group over many tasks.

The bounds only place the cuts, so the result is exact whatever the sketch says.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# ranges per group: a power of two, found by binary search in the bounds
RANGES = 128
# tasks in which the values of a heavy group meet its bounds
SALTS = 32
# share of all distinct values from which a group is heavy: there are fewer than 200 such groups
HEAVY_SHARE = 0.005
_N, _TOTAL, _BELOW = "_sw_n", "_sw_total", "_sw_below"
_BOUNDS, _RANGE, _START, _SALT, _HEAVY = "_sw_bounds", "_sw_range", "_sw_start", "_sw_salt", "_sw_heavy"


def value_counts(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Rows per ``(group, value)``; null groups and null values are left out."""
    names = [*by, value]
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in names])
    return df.filter(present).groupBy(*names).agg(F.count(F.lit(1)).alias(_N))


def _locate(df: DataFrame, value: str, ranges: int) -> DataFrame:
    """Number of bounds below the value, by binary search.

    One short expression per step stays inside generated code, where a lambda
    over the array would be interpreted and copy the array for every row.
    """
    df = df.withColumn(_RANGE, F.lit(0))
    step = ranges // 2
    while step:
        bound = F.get(F.col(_BOUNDS), F.col(_RANGE) + (step - 1))
        df = df.withColumn(_RANGE, F.when(bound < F.col(value), F.col(_RANGE) + step).otherwise(F.col(_RANGE)))
        step //= 2
    return df


def _heavy_groups(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups with more than :data:`HEAVY_SHARE` of the distinct values; bounded by that share, so it may be broadcast."""
    sizes = counts.groupBy(*by).agg(F.count(F.lit(1)).alias("_sw_values"))
    total = sizes.agg(F.sum("_sw_values").cast("double")).scalar()
    return F.broadcast(sizes.filter(F.col("_sw_values") > total * HEAVY_SHARE).select(*by, F.lit(True).alias(_HEAVY)))


def _ranged(counts: DataFrame, by: Sequence[str], value: str, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Counts with their range number and group total, and the start and size of each range."""
    shares = [(i + 1) / ranges for i in range(ranges - 1)]
    # a group of few values has few bounds
    sketch = F.array_distinct(F.percentile_approx(value, shares, F.lit(20 * ranges))).alias(_BOUNDS)
    bounds = counts.groupBy(*by).agg(sketch, F.sum(_N).alias(_TOTAL))
    if by:
        heavy = _heavy_groups(counts, by)
        salt = F.when(F.col(_HEAVY), F.pmod(F.hash(value), F.lit(SALTS))).otherwise(F.lit(0))
        salted = counts.join(heavy, list(by), "left").withColumn(_SALT, salt).drop(_HEAVY)
        last = F.when(F.col(_HEAVY), F.lit(SALTS - 1)).otherwise(F.lit(0))
        copies = bounds.join(heavy, list(by), "left").withColumn(_SALT, F.explode(F.sequence(F.lit(0), last))).drop(_HEAVY)
        placed = salted.join(copies, [*by, _SALT]).drop(_SALT)
    else:
        one = bounds.select(F.struct(_BOUNDS, _TOTAL)).scalar()
        placed = counts.withColumn("_sw_one", one).select(*counts.columns, "_sw_one.*")
    placed = _locate(placed, value, ranges).drop(_BOUNDS)
    # the total is kept on both branches, so that they are one exchange to Spark
    sizes = placed.groupBy(*by, _RANGE, _TOTAL).agg(F.sum(_N).alias("_sw_size"))
    earlier = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return placed, sizes.withColumn(_START, F.coalesce(F.sum("_sw_size").over(earlier), F.lit(0)))


def _run_up(placed: DataFrame, starts: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    inside = Window.partitionBy(*by, _RANGE).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    joined = placed.join(starts.select(*by, _RANGE, _START), [*by, _RANGE])
    return joined.withColumn(_BELOW, F.col(_START) + F.coalesce(F.sum(_N).over(inside), F.lit(0)))


def cumulative_counts(df: DataFrame, by: Sequence[str], value: str, ranges: int = RANGES) -> DataFrame:
    """``(*by, value, rows, below, total)``: rows with the value, rows with a
    smaller value, and rows in all, per group."""
    run = _run_up(*_ranged(value_counts(df, by, value), by, value, ranges), by, value)
    return run.select(
        *by, value, F.col(_N).alias("rows"), F.col(_BELOW).alias("below"), F.col(_TOTAL).alias("total")
    )


def average_ranks(df: DataFrame, value: str, rank: str) -> DataFrame:
    """``(value, rank)`` with 1-based ranks, ties sharing their average."""
    run = cumulative_counts(df, [], value)
    return run.select(value, (F.col("below") + (F.col("rows") + 1) / F.lit(2.0)).alias(rank))


def _quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Mapping[str, float], ranges: int) -> DataFrame:
    placed, starts = _ranged(value_counts(df, by, value), by, value, ranges)

    def position(p: float) -> Column:
        return (F.col(_TOTAL) - 1) * F.lit(float(p))

    wanted = [f(position(p)).cast("bigint") for p in probs.values() for f in (F.floor, F.ceil)]
    # only ranges that hold a wanted position are ordered
    holds = [(F.col(_START) <= w) & (w < F.col(_START) + F.col("_sw_size")) for w in wanted]
    picked = starts.filter(reduce(lambda a, b: a | b, holds))
    run = _run_up(placed, picked, by, value)

    def at(position: Column) -> Column:
        here = (F.col(_BELOW) <= position) & (position < F.col(_BELOW) + F.col(_N))
        return F.max(F.when(here, F.col(value)))

    parts = [F.first(_TOTAL).alias(_TOTAL)]
    for name, p in probs.items():
        parts += [at(F.floor(position(p)).cast("bigint")).alias(f"_lo_{name}")]
        parts += [at(F.ceil(position(p)).cast("bigint")).alias(f"_hi_{name}")]
    found = run.groupBy(*by).agg(*parts)
    share = {name: position(p) - F.floor(position(p)) for name, p in probs.items()}
    return found.select(
        *by,
        *[(F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * share[n]).alias(n) for n in probs],
    )


def group_statistics(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    aggregates: Sequence[Column] = (),
    *,
    ranges: int = RANGES,
) -> DataFrame:
    """``(*by, *aggregates, *quantiles)``, quantiles interpolated linearly.

    Groups with a null key are left out. ``aggregates`` are ordinary aliased
    aggregates over the same rows.
    """
    data = df.withColumn(value, F.col(value).cast("double")) if dict(df.dtypes)[value] != "double" else df
    if by:
        data = data.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in by]))
    needed = data.select(*by, value)
    if not probs:
        return data.groupBy(*by).agg(*aggregates)
    quantiles = _quantiles(needed, by, value, probs, ranges)
    if not aggregates:
        return quantiles
    stats = data.groupBy(*by).agg(*aggregates)
    if by:
        # a group without values has statistics but no quantiles
        return stats.join(quantiles, list(by), "left")
    row = quantiles.select(F.struct(*probs)).scalar()
    return stats.withColumn("_sw_q", row).select(*stats.columns, *[F.col(f"_sw_q.{n}").alias(n) for n in probs])


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, median)`` of several numeric columns, one row each."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = long.unpivot([], list(columns), "column", "value").filter("value is not null")
    return group_statistics(long, ["column"], "value", {"median": 0.5})
