"""Sketches that are stored once per version and merged later, without reading the versions again.

Theta sketches answer how many distinct values columns have, in a version, in
any union and in any intersection. KLL sketches answer quantiles of values, in a
group, a version or all of them. Both are built by partial aggregates and have a
bounded size, so a table of them stays small however large the versions are. The
exact ways stay in :mod:`profile` and :mod:`quantiles`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import columns as X

# 2**15 entries: a standard error of 0.55 %
LOG_ENTRIES = 15
# a rank error of about 0.4 % with a chance of 99 %
KLL_SIZE = 800


def _countable(c: Column, dtype: str) -> Column:
    """The value as a type theta sketches take; equal values stay equal, others apart."""
    if dtype in X.INTEGRAL:
        return c.cast("bigint")
    if dtype in X.FRACTIONAL:
        return c.cast("double") + F.lit(0.0)  # -0.0 is 0.0
    return c.cast("string")


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``(*by, column, values, sketch)``: a theta sketch of each column per group, in one pass. Nulls are no values."""
    types = dict(df.dtypes)
    made = df.groupBy(*by).agg(
        *[F.theta_sketch_agg(_countable(F.col(c), types[c]), LOG_ENTRIES).alias(f"_s{i}") for i, c in enumerate(columns)],
        *[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)],
    )
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("values"), F.col(f"_s{i}").alias("sketch"))
        for i, c in enumerate(columns)
    ]
    return made.select(*by, F.inline(F.array(*entries)))


def distinct_estimates(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, estimate)``: distinct values of the union of the sketches of each group."""
    return sketches.groupBy(*by).agg(F.theta_sketch_estimate(F.theta_union_agg("sketch", LOG_ENTRIES)).alias("estimate"))


def common_estimates(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, estimate)``: distinct values that all sketches of each group share."""
    return sketches.groupBy(*by).agg(F.theta_sketch_estimate(F.theta_intersection_agg("sketch")).alias("estimate"))


def value_sketches(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, values, sketch)``: a KLL sketch of a numeric column per group. Null and NaN are no values."""
    number = F.nanvl(F.col(value).cast("double"), F.lit(None))
    present = df.select(*by, number.alias("_sw_value")).filter(F.col("_sw_value").isNotNull())
    sketch = F.kll_sketch_agg_double("_sw_value", KLL_SIZE)
    return present.groupBy(*by).agg(F.count(F.lit(1)).alias("values"), sketch.alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """``(*by, values, *probs)``: quantiles of the merged sketches of each group, each a value that occurs."""
    merged = sketches.groupBy(*by).agg(F.sum("values").alias("values"), F.kll_merge_agg_double("sketch", KLL_SIZE).alias("sketch"))
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in probs.items()]
    return merged.select(*by, "values", *found)
