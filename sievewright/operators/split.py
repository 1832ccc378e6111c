"""Group-aware train / validation / test split.

Groups are put in a seeded random order by hash. The first ``ceil(test * groups)``
of them are test, the next ``ceil(share of the rest)`` validation, the others
train. Only the two hash values at the cuts are needed to label a row, so rows
are labelled in place: nothing is joined back and no row is shuffled.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievewright.operators import quantiles
from sievewright.specs import SplitConfig

SPLIT = "split"
PARTS = ("train", "validation", "test")
_HASH, _BUCKET = "_sw_hash", "_sw_bucket"
_FINE, _RANKS = "_sw_fine", ("test_rank", "validation_rank")


class SplitInvalid(ValueError):
    pass


def order_hash(group: Column, seed: int) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), group.cast("string")), 256)


def _ceil(x: Column) -> Column:
    # shares such as 0.2 are not exact in binary: 0.2 * 15 must stay 3
    return F.ceil(F.round(x, 9)).cast("bigint")


def _holding(sizes: DataFrame, by: Sequence[str], bucket: str) -> DataFrame:
    """The buckets that hold a cut, with the number of groups before them as ``start``.

    ``sizes`` has at most 4096 buckets per ``by``; ``start`` is that of ``by``.
    """
    running = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ended = sizes.withColumn("end", F.col("start") + F.sum("size").over(running))
    started = ended.withColumn("start", F.col("end") - F.col("size"))
    holds = [(F.col("start") < F.col(r)) & (F.col(r) <= F.col("end")) for r in _RANKS]
    return started.filter(holds[0] | holds[1]).drop("size", "end")


def cut_points(df: DataFrame, config: SplitConfig) -> DataFrame:
    """One row: group count and the hashes of the last test and validation group.

    Hashes are counted per 3-digit prefix (at most 4096 rows) to find the prefix
    of each cut, then per 6-digit prefix inside those two; only the groups that
    share 6 digits with a cut, a 16-millionth of all, are ordered.
    """
    hashes = (
        df.select(order_hash(F.col(config.group), config.seed).alias(_HASH))
        .distinct()
        .withColumns({_BUCKET: F.substring(_HASH, 1, 3), _FINE: F.substring(_HASH, 4, 3)})
    )
    sizes = hashes.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("size"))
    groups = sizes.withColumn("groups", F.sum("size").over(Window.partitionBy())).withColumn("start", F.lit(0))
    share = config.validation / (config.train + config.validation)
    test = _ceil(F.col("groups") * config.test)
    placed = groups.withColumn("test_rank", test).withColumn(
        "validation_rank", F.col("test_rank") + _ceil((F.col("groups") - F.col("test_rank")) * share)
    )
    coarse = _holding(placed, [], _BUCKET)
    inside = hashes.join(coarse, _BUCKET)
    sizes = inside.groupBy(*coarse.columns, _FINE).agg(F.count(F.lit(1)).alias("size"))
    fine = _holding(sizes, [_BUCKET], _FINE)
    order = Window.partitionBy(_BUCKET, _FINE).orderBy(_HASH)
    ranked = hashes.join(fine, [_BUCKET, _FINE]).withColumn("rank", F.col("start") + F.row_number().over(order))
    return ranked.agg(
        F.max("groups").alias("groups"),
        F.max(F.when(F.col("rank") == F.col("test_rank"), F.col(_HASH))).alias("test_cut"),
        F.max(F.when(F.col("rank") == F.col("validation_rank"), F.col(_HASH))).alias("validation_cut"),
    )


def group_split(df: DataFrame, config: SplitConfig, column: str = SPLIT) -> DataFrame:
    """``df`` with its part; all rows of a group share one part."""
    cuts = cut_points(df, config)
    here = order_hash(F.col(config.group), config.seed)
    label = (
        F.when(F.col(_HASH) <= F.col("_sw_cuts.test_cut"), "test")
        .when(F.col(_HASH) <= F.col("_sw_cuts.validation_cut"), "validation")
        .otherwise("train")
    )
    row = cuts.select(F.struct("test_cut", "validation_cut")).scalar()
    staged = df.withColumns({_HASH: here, "_sw_cuts": row})
    return staged.withColumn(column, label).drop(_HASH, "_sw_cuts")


def input_report(df: DataFrame, config: SplitConfig) -> DataFrame:
    """Long report ``(check, violations)`` of what makes a split unsafe."""
    annual = config.targets[0]
    unsound = F.lit(False)
    for c in config.targets:
        unsound = unsound | F.isnan(c) | (F.abs(c) == float("inf"))
    checks = {
        "null_group": F.count_if(F.col(config.group).isNull()),
        "null_target": F.count_if(F.greatest(*[F.col(c).isNull() for c in config.targets])),
        "not_finite": F.count_if(F.coalesce(unsound, F.lit(False))),
        "not_positive": F.count_if(F.col(annual) <= 0),
    }
    groups = df.select(config.group).distinct().agg(F.count(config.group).alias("n")).scalar()
    wide = df.agg(*[v.alias(k) for k, v in checks.items()])
    wide = wide.withColumn("too_few_groups", F.when(groups < config.min_groups, 1).otherwise(0).cast("bigint"))
    return wide.withColumn("_sw", F.lit(0)).unpivot(["_sw"], [*checks, "too_few_groups"], "check", "violations").drop("_sw")


def validate_input(df: DataFrame, config: SplitConfig) -> None:
    """Raise if the input cannot be split safely. Runs a job."""
    lost = [c for c in (config.group, *config.targets) if c not in df.columns]
    if lost:
        raise SplitInvalid(f"columns missing: {lost}")
    failed = [f"{r['check']}: {r['violations']}" for r in input_report(df, config).filter("violations > 0").collect()]
    if failed:
        raise SplitInvalid("; ".join(failed))


def part_sizes(split: DataFrame, config: SplitConfig, column: str = SPLIT) -> DataFrame:
    """Rows and groups per part, with actual and requested share.

    Rows are counted per group first, so the distinct count of groups needs no
    second look at the rows.
    """
    per_group = split.groupBy(column, config.group).agg(F.count(F.lit(1)).alias("n"))
    sizes = per_group.groupBy(column).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("groups"))
    requested = F.create_map(*[F.lit(x) for p in PARTS for x in (p, getattr(config, p))])
    everything = Window.partitionBy()
    actual = F.col("rows") / F.sum("rows").over(everything)
    return sizes.select(
        column,
        "rows",
        "groups",
        actual.alias("actual"),
        requested[F.col(column)].alias("requested"),
        F.abs(actual - requested[F.col(column)]).alias("deviation"),
    )


def group_overlap(split: DataFrame, config: SplitConfig, column: str = SPLIT) -> DataFrame:
    """Groups found in more than one part, per pair of parts. One row of counts."""
    flags = [F.max((F.col(column) == p).cast("int")).alias(p) for p in PARTS]
    per_group = split.groupBy(config.group).agg(*flags)
    return per_group.agg(
        F.count_if((F.col("train") + F.col("validation")) == 2).alias("train_validation"),
        F.count_if((F.col("train") + F.col("test")) == 2).alias("train_test"),
        F.count_if((F.col("validation") + F.col("test")) == 2).alias("validation_test"),
    )


def row_overlap(split: DataFrame, row_id: str, column: str = SPLIT) -> DataFrame:
    """Row ids given to more than one part."""
    per_row = split.groupBy(row_id).agg(F.min(column).alias("a"), F.max(column).alias("b"))
    return per_row.filter("a <> b").agg(F.count(F.lit(1)).alias("shared_rows"))


def check_split(df: DataFrame, split: DataFrame, config: SplitConfig, column: str = SPLIT) -> None:
    """Raise if rows are lost, a part is empty or a group is shared. Runs jobs.

    A share further than ``max_ratio_deviation`` from the request only warns:
    groups cannot be cut.
    """
    sizes = {r[column]: r for r in part_sizes(split, config, column).collect()}
    empty = [p for p in PARTS if p not in sizes]
    if empty:
        raise SplitInvalid(f"empty parts: {empty}")
    total = sum(r["rows"] for r in sizes.values())
    expected = df.count()
    if total != expected:
        raise SplitInvalid(f"{expected} rows went in, {total} came out")
    overlap = group_overlap(split, config, column).first().asDict()
    if any(overlap.values()):
        raise SplitInvalid(f"groups shared between parts: {overlap}")
    for part, row in sizes.items():
        if row["deviation"] > config.max_ratio_deviation:
            warnings.warn(f"{part}: share {row['actual']:.4f}, requested {row['requested']:.4f}", stacklevel=2)


def same_schema(parts: dict[str, DataFrame]) -> None:
    """Raise unless all parts have the same columns and types."""
    schemas = {name: df.dtypes for name, df in parts.items()}
    first = next(iter(schemas.values()))
    different = [name for name, dtypes in schemas.items() if dtypes != first]
    if different:
        raise SplitInvalid(f"parts with another schema: {different}")


def part_statistics(split: DataFrame, target: str, column: str = SPLIT) -> DataFrame:
    """Count, range, mean, median and deviation of the target per part."""
    aggregates = [
        F.count(target).alias("count"),
        F.count_if(F.col(target).isNull()).alias("null_targets"),
        F.min(target).alias("min"),
        F.max(target).alias("max"),
        F.avg(target).alias("mean"),
        F.stddev_samp(target).alias("std"),
    ]
    return quantiles.group_statistics(split, [column], target, {"median": 0.5}, aggregates)
