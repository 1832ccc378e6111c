"""Group statistics, correlations, outliers and distributions."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievewright.functions import columns as X
from sievewright.operators import quantiles

QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def group_stats(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Count, mean, sample deviation and quartiles of a value per group."""
    aggregates = [F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")]
    return quantiles.group_statistics(df.filter(F.col(value).isNotNull()), by, value, QUARTILES, aggregates)


def supported_group_stats(df: DataFrame, by: Sequence[str], value: str, min_support: int = 30) -> DataFrame:
    """Group statistics of groups with enough rows, with the interquartile range."""
    stats = group_stats(df, by, value).withColumn("iqr", F.col("p75") - F.col("p25"))
    return stats.filter(F.col("count") >= min_support)


def rate_by_group(df: DataFrame, by: str, condition: Column, top: int | None = None) -> DataFrame:
    """Rows, rows that meet a condition, and the rate in percent per group.

    ``top`` keeps the groups with the most rows.
    """
    rates = df.groupBy(by).agg(F.count("*").alias("rows"), F.count_if(condition).alias("hits"))
    rates = rates.withColumns(
        {"misses": F.col("rows") - F.col("hits"), "rate_percent": X.ratio(F.col("hits"), F.col("rows"))}
    )
    return rates.orderBy(F.desc("rows"), by).limit(top) if top else rates


def conditional_counts(df: DataFrame, by: str, conditions: Mapping[str, Column]) -> DataFrame:
    return df.groupBy(by).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def pivoted_medians(df: DataFrame, rows: str, columns: str, values: Sequence, value: str) -> DataFrame:
    """Median of a value per pair of keys, one column per known second key."""
    long = quantiles.group_statistics(df, [rows, columns], value, {"median": 0.5})
    cells = [F.max(F.when(F.col(columns) == v, F.col("median"))).alias(str(v)) for v in values]
    return long.groupBy(rows).agg(*cells)


def ranked_medians(df: DataFrame, by: str, value: str) -> DataFrame:
    """Groups by median, ties sharing their average rank.

    Ranks come from counts per distinct median, so the window only sees those.
    """
    stats = quantiles.group_statistics(df, [by], value, {"median": 0.5}).filter("median is not null")
    ranks = quantiles.average_ranks(stats, "median", "rank")
    return stats.join(ranks, "median").select(by, "median", "rank")


def group_first(df: DataFrame, by: str, values: Sequence[str], order_by: str) -> DataFrame:
    """Rows per group and the first non-null value of each column in row order."""
    first = [F.min_by(v, F.when(F.col(v).isNotNull(), F.col(order_by))).alias(v) for v in values]
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(F.count("*").alias("rows"), *first)


# ----------------------------------------------------------------- correlation


def _pairwise(x: Column, y: Column) -> Column:
    both = x.isNotNull() & y.isNotNull()
    return F.corr(F.when(both, x), F.when(both, y))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(a, b, r)`` for every pair of columns, all in one aggregate."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[_pairwise(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    entries = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("r")) for i, (a, b) in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*entries)))


def gram_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`correlation_matrix` for many columns: three matrix products per Arrow batch in place of an aggregate per pair.

    With missing values as 0 and masks of what is present, the products of values
    by values, values by masks, squares by masks and masks by masks hold all sums
    of every pairwise complete pair. A task adds them up and gives a row per pair.
    Values are taken from the column's mean, known by a first pass, so that the
    sums are well conditioned. NaN is missing; infinite values make r NaN.
    """
    names, p = list(columns), len(columns)
    numbers = df.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(f"_{i}") for i, c in enumerate(names)])
    means = numbers.agg(*[F.avg(c).alias(c) for c in numbers.columns]).first()  # one row
    centre = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in means])
    upper = np.triu_indices(p, 1)
    sums = ("n", "sx", "sy", "sxx", "syy", "sxy")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((4, p, p))
        for batch in batches:
            raw = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.float64)
            present = ~np.isnan(raw)
            x, mask = np.where(present, raw - centre, 0.0), present.astype(np.float64)
            total += np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
        n, s, q, c = total
        i, j = upper
        values = [n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], c[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *map(pa.array, values)], names=["i", "j", *sums])

    schema = "i int, j int, " + ", ".join(f"{c} double" for c in sums)
    totals = numbers.mapInArrow(products, schema).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])
    n, sx, sy, sxx, syy, sxy = map(F.col, sums)
    spread = F.sqrt(n * sxx - sx * sx) * F.sqrt(n * syy - sy * sy)
    labels = F.array(*map(F.lit, names))
    return totals.select(labels[F.col("i")].alias("a"), labels[F.col("j")].alias("b"), F.try_divide(n * sxy - sx * sy, spread).alias("r"))


def strong_pairs(df: DataFrame, columns: Sequence[str], threshold: float) -> DataFrame:
    return correlation_matrix(df, columns).filter(F.abs("r") > threshold)


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation of two columns. One row.

    Rows are counted per pair of values first; the ranks of both sides are joined
    to those counts, and the correlation is taken from weighted sums.
    """
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(
        F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")
    )
    pairs = both.groupBy("x", "y").agg(F.count("*").cast("double").alias("n"))
    ranked = pairs.join(quantiles.average_ranks(both, "x", "rx"), "x").join(quantiles.average_ranks(both, "y", "ry"), "y")
    # ranks are centred at their known mean, which keeps the sums well conditioned
    count = both.agg(F.count("*").cast("double")).scalar()
    middle = (F.col("_sw_count") + 1) / 2
    centred = ranked.withColumn("_sw_count", count).withColumns({"rx": F.col("rx") - middle, "ry": F.col("ry") - middle})
    n, x, y = F.col("n"), F.col("rx"), F.col("ry")
    covariance, var_x, var_y = F.sum(n * x * y), F.sum(n * x * x), F.sum(n * y * y)
    return centred.agg((F.try_divide(covariance, F.sqrt(var_x) * F.sqrt(var_y))).alias("r"))


def log_log_correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Correlation of ``log1p`` values, negatives clipped to 0. One row."""

    def log(name: str) -> Column:
        return F.log1p(F.when(F.col(name).isNotNull(), F.greatest(F.col(name).cast("double"), F.lit(0.0))))

    return df.agg(_pairwise(log(a), log(b)).alias("r"))


def anova(df: DataFrame, by: str, value: str) -> DataFrame:
    """One-way F statistic over groups with more than one row, and the spread of
    the group medians. One row."""
    aggregates = [
        F.count(value).cast("double").alias("n"),
        F.avg(value).alias("mean"),
        F.var_samp(value).alias("variance"),
    ]
    stats = quantiles.group_statistics(df.filter(F.col(value).isNotNull()), [by], value, {"median": 0.5}, aggregates)
    groups = stats.filter("n > 1")
    grand = groups.agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n"))).scalar()
    n, mean = F.col("n"), F.col("mean")
    k = F.count("*")
    placed = groups.withColumn("_sw_grand", grand)
    deviation = mean - F.col("_sw_grand")
    totals = placed.agg(
        k.alias("groups"),
        F.sum("n").cast("bigint").alias("rows"),
        F.sum(n * deviation * deviation).alias("ssb"),
        F.sum((n - 1) * F.col("variance")).alias("ssw"),
        (F.max("median") - F.min("median")).alias("median_spread"),
    )
    between = F.try_divide(F.col("ssb"), (F.col("groups") - 1).cast("double"))
    within = F.try_divide(F.col("ssw"), (F.col("rows") - F.col("groups")).cast("double"))
    return totals.select("groups", "rows", F.try_divide(between, within).alias("f_statistic"), "median_spread")


# ------------------------------------------------------- outliers, distribution


def iqr_outliers(df: DataFrame, value: str, factor: float = 1.5) -> DataFrame:
    """Fences ``factor`` interquartile ranges outside the quartiles, and the rows
    beyond them. One row."""
    data = df.filter(F.col(value).isNotNull())
    quartiles = quantiles.group_statistics(data, [], value, {"q1": 0.25, "q3": 0.75})
    spread = (F.col("q3") - F.col("q1")) * factor
    fences = quartiles.select(F.struct((F.col("q1") - spread).alias("low"), (F.col("q3") + spread).alias("high"))).scalar()
    flagged = data.select(F.col(value).alias("_sw_v")).withColumn("_sw_f", fences)
    outside = (F.col("_sw_v") < F.col("_sw_f.low")) | (F.col("_sw_v") > F.col("_sw_f.high"))
    return flagged.agg(
        F.max("_sw_f.low").alias("lower_fence"),
        F.max("_sw_f.high").alias("upper_fence"),
        F.count("*").alias("rows"),
        F.count_if(outside).alias("outliers"),
        F.avg(outside.cast("double") * 100).alias("outlier_percent"),
    )


def between_percentiles(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows whose value lies between two percentiles, bounds included."""
    bounds = quantiles.group_statistics(df.filter(F.col(value).isNotNull()), [], value, {"lo": low, "hi": high})
    row = bounds.select(F.struct("lo", "hi")).scalar()
    placed = df.withColumn("_sw_b", row)
    return placed.filter(F.col(value).between(F.col("_sw_b.lo"), F.col("_sw_b.hi"))).drop("_sw_b")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Rows per equal-width bin, empty bins included; the last bin is closed."""
    data = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    limits = data.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    row = limits.select(F.struct("lo", "hi")).scalar()
    placed = data.withColumn("b", row)
    share = F.try_divide(F.col("v") - F.col("b.lo"), F.col("b.hi") - F.col("b.lo"))
    bin_of = F.least(F.coalesce(F.floor(share * bins), F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = placed.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("rows"))
    spine = limits.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return spine.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("from_value"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("to_value"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def five_numbers(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Minimum, quartiles, maximum per group: the data of a box plot."""
    data = df.filter(F.col(value).isNotNull())
    return quantiles.group_statistics(data, by, value, QUARTILES, [F.min(value).alias("min"), F.max(value).alias("max")])


def ecdf(df: DataFrame, value: str) -> DataFrame:
    """``(value, share)``: share of rows at or below each distinct value."""
    run = quantiles.cumulative_counts(df, [], value)
    return run.select(value, ((F.col("below") + F.col("rows")) / F.col("total")).alias("share"))


def median_ratio(df: DataFrame, by: str, numerator: Column, denominator: Column) -> DataFrame:
    """Median of a ratio of two columns per category."""
    ratios = df.select(by, F.try_divide(numerator.cast("double"), denominator.cast("double")).alias("ratio"))
    present = ratios.filter("ratio is not null")
    return quantiles.group_statistics(present, [by], "ratio", {"median_ratio": 0.5}, [F.count("*").alias("rows")])


def share_within(df: DataFrame, a: Column, b: Column, tolerance: float) -> DataFrame:
    """Share of rows, in percent, where two values differ by less than a tolerance."""
    both = df.filter(a.isNotNull() & b.isNotNull())
    return both.agg(
        F.count("*").alias("rows"), F.avg((F.abs(a - b) < tolerance).cast("double") * 100).alias("close_percent")
    )


def waterfall(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """Rows lost at each exclusive stage, tested in order, and rows kept. One pass.

    Each stage names the rows it removes.
    """
    aggregates = [F.count("*").alias("rows_in")]
    alive = F.lit(True)
    for name, lost in stages.items():
        hit = F.coalesce(lost, F.lit(False))
        aggregates.append(F.count_if(alive & hit).alias(name))
        alive = alive & ~hit
    aggregates += [F.count_if(alive).alias("kept"), F.avg(alive.cast("double") * 100).alias("kept_percent")]
    return df.agg(*aggregates)
