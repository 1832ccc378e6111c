"""Profiling and comparison of tables and versions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievewright.functions import columns as X
from sievewright.operators import quantiles



def _missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    return c.isNull() | F.isnan(c) if dict(df.dtypes)[name] in X.FRACTIONAL else c.isNull()


def _distinct_counts(df: DataFrame, names: Sequence[str]) -> Column:
    """Distinct non-null values per column, as one struct read as a scalar subquery."""
    types = dict(df.dtypes)

    def text(c: str) -> Column:
        # adding 0 makes the two zeros one value, as counting does
        value = F.col(f"`{c}`") + 0.0 if types[c] in X.FRACTIONAL else F.col(f"`{c}`")
        return value.cast("string")

    pairs = F.array(*[F.struct(F.lit(i).alias("i"), text(c).alias("v")) for i, c in enumerate(names)])
    values = df.select(F.inline(pairs)).filter("v is not null").distinct()
    counts = values.groupBy("i").agg(F.count(F.lit(1)).alias("n"))
    found = [F.coalesce(F.max(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).alias(f"_d{i}") for i in range(len(names))]
    return counts.agg(*found).select(F.struct(*[f"_d{i}" for i in range(len(names))])).scalar()


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Type, nulls and distinct values per column.

    Exact distinct counts shuffle two narrow columns, ``(column, value)``, of which
    every task sends each pair once; ``exact=False`` counts with sketches in one
    pass and shuffles one small row per task.
    """
    names = list(columns or df.columns)
    types = dict(df.dtypes)
    if exact:
        row = _distinct_counts(df, names)
        distinct = [F.coalesce(F.any_value(row[f"_d{i}"]), F.lit(0)) for i in range(len(names))]
    else:
        distinct = [F.approx_count_distinct(F.col(f"`{c}`")) for c in names]
    wide = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(~_missing(df, c)).alias(f"_p{i}") for i, c in enumerate(names)],
        *[d.alias(f"_d{i}") for i, d in enumerate(distinct)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(types[c]).alias("dtype"),
            F.col(f"_p{i}").alias("non_null"),
            F.col(f"_d{i}").alias("distinct_values"),
        )
        for i, c in enumerate(names)
    ]
    long = wide.select("rows", F.inline(F.array(*entries)))
    return long.select(
        "column",
        "dtype",
        "non_null",
        (F.col("rows") - F.col("non_null")).alias("nulls"),
        X.ratio(F.col("rows") - F.col("non_null"), F.col("rows")).alias("null_percent"),
        "distinct_values",
        X.ratio(F.col("distinct_values"), F.col("rows")).alias("distinct_percent"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """``(column, nulls, null_percent)`` of every column, one pass, no shuffle of rows."""
    wide = df.agg(F.count("*").alias("_sw_rows"), *[F.count_if(_missing(df, c)).alias(c) for c in df.columns])
    long = wide.unpivot(["_sw_rows"], df.columns, "column", "nulls")
    return long.select("column", "nulls", X.ratio(F.col("nulls"), F.col("_sw_rows")).alias("null_percent"))


def missing_summary(df: DataFrame) -> DataFrame:
    """Columns with nulls, worst first."""
    return null_profile(df).filter("nulls > 0").orderBy(F.desc("nulls"), "column")


def duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, rows beyond the first of their kind, and their share.

    Nulls count as equal. Also serves for the duplicates of one key.
    """
    per_kind = df.groupBy(*(subset or df.columns)).agg(F.count("*").alias("n"))
    totals = per_kind.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")
    )
    return totals.withColumn("duplicate_percent", X.ratio(F.col("duplicates"), F.col("rows")))


def duplicate_key_counts(tables: dict[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Duplicates of each table's key: ``(table, rows, duplicates, duplicate_percent)``."""
    parts = [duplicate_rows(df, key).select(F.lit(name).alias("table"), "*") for name, (df, key) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, null included, with their share in percent."""
    counts = df.groupBy(column).agg(F.count("*").alias("rows"))
    # counts are summed beforehand, so the total is one number per task
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("percent", X.ratio(F.col("rows"), total))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; ties to the smaller value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), column).limit(n)


def extreme_rows(df: DataFrame, column: str, n: int, tie: Sequence[str], largest: bool = True) -> DataFrame:
    order = F.col(column).desc() if largest else F.col(column).asc()
    return df.filter(F.col(column).isNotNull()).orderBy(order, *tie).limit(n)


def describe(df: DataFrame, column: str, probs: dict[str, float], by: Sequence[str] = ()) -> DataFrame:
    """Counts, range, moments, quantiles, zeros and negatives of a number."""
    number = X.to_double(F.col(column), dict(df.dtypes)[column])
    data = df.select(*by, number.alias(column))
    c = F.col(column)
    aggregates = [
        F.count(c).alias("count"),
        F.count_if(c.isNull()).alias("missing"),
        F.avg(c.isNull().cast("double") * 100).alias("missing_percent"),
        F.min(c).alias("min"),
        F.max(c).alias("max"),
        F.avg(c).alias("mean"),
        F.stddev_samp(c).alias("std"),
        F.count_if(c == 0).alias("zeros"),
        F.count_if(c < 0).alias("negatives"),
    ]
    return quantiles.group_statistics(data, by, column, probs, aggregates)


def shape(df: DataFrame, column: str) -> DataFrame:
    """Population skewness and excess kurtosis, raw and after ``log1p``."""
    return df.agg(
        F.skewness(column).alias("skewness"),
        F.kurtosis(column).alias("kurtosis"),
        F.skewness(X.log1p_or_null(F.col(column))).alias("log_skewness"),
        F.kurtosis(X.log1p_or_null(F.col(column))).alias("log_kurtosis"),
    )


def missing_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Distinct non-null child keys that the parent lacks."""
    used = child.select(column).filter(F.col(column).isNotNull()).distinct()
    return used.join(parent.select(F.col(parent_column).alias(column)).distinct(), column, "left_anti")


def cardinalities(df: DataFrame, key: str) -> DataFrame:
    """How many keys have 1, 2, 3, ... rows."""
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows_per_key"))
    return per_key.groupBy("rows_per_key").agg(F.count("*").alias("keys"))


def cardinality_summary(df: DataFrame, key: str) -> DataFrame:
    """Describe the rows per key."""
    per_key = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").cast("double").alias("rows_per_key"))
    aggregates = [
        F.count("*").alias("keys"),
        F.avg("rows_per_key").alias("mean"),
        F.stddev_samp("rows_per_key").alias("std"),
        F.min("rows_per_key").alias("min"),
        F.max("rows_per_key").alias("max"),
    ]
    return quantiles.group_statistics(
        per_key, [], "rows_per_key", {"p25": 0.25, "median": 0.5, "p75": 0.75}, aggregates
    )


# --------------------------------------------------------------------- versions


def schema_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(column, status, type_a, type_b, non_null_a, non_null_b)``.

    Status is added, removed, common or retyped. The counts come with one pass
    per version.
    """
    left, right = (_non_null(df).select("column", *rest) for df, rest in ((a, _named("a")), (b, _named("b"))))
    status = (
        F.when(F.col("type_a").isNull(), "added")
        .when(F.col("type_b").isNull(), "removed")
        .when(F.col("type_a") != F.col("type_b"), "retyped")
        .otherwise("common")
    )
    return left.join(right, "column", "full_outer").withColumn("status", status)


def _named(side: str) -> list[Column]:
    return [F.col("dtype").alias(f"type_{side}"), F.col("non_null").alias(f"non_null_{side}")]


def _non_null(df: DataFrame) -> DataFrame:
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(df.columns)])
    entries = [
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("dtype"), F.col(f"_{i}").alias("non_null"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return wide.select(F.inline(F.array(*entries)))


def null_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Nulls per column in both versions (null where a version lacks the column)."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return null_profile(df).withColumnsRenamed({"nulls": f"nulls_{name}", "null_percent": f"null_percent_{name}"})

    return side(a, "a").join(side(b, "b"), "column", "full_outer")


def key_overlap(a: DataFrame, b: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys in both, only in one, and containment in percent. One row."""
    tagged = a.select(*key, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(*key, F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    )
    flags = tagged.groupBy(*key).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    counts = flags.agg(
        F.sum("in_a").alias("keys_a"),
        F.sum("in_b").alias("keys_b"),
        F.count_if((F.col("in_a") + F.col("in_b")) == 2).alias("common"),
        F.count_if(F.col("in_b") == 0).alias("only_a"),
        F.count_if(F.col("in_a") == 0).alias("only_b"),
    )
    return counts.withColumns(
        {
            "a_in_b_percent": X.ratio(F.col("common"), F.col("keys_a")),
            "b_in_a_percent": X.ratio(F.col("common"), F.col("keys_b")),
        }
    )


_WORD_BITS = 62  # of a long, so that no mask is negative


def version_masks(df: DataFrame, key: Sequence[str], version: str) -> tuple[DataFrame, list]:
    """``(*key, mask_0, ...)`` with a bit per version that holds the key, and the versions in the order of their bits.

    One partial ``bit_or`` per key and task, whatever the number of versions;
    a mask has as many words as needed. Null keys and versions are left out.
    The versions are listed by a job.
    """
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*key, version)])
    rows = df.filter(present)
    versions = sorted(r[0] for r in rows.select(version).distinct().collect())
    place = F.array_position(F.array(*map(F.lit, versions)), F.col(version)) - 1 if versions else F.lit(0)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("_sw_place") % _WORD_BITS).cast("int"))
    words = range(max(1, -(-len(versions) // _WORD_BITS)))
    masks = [F.bit_or(F.when(F.floor(F.col("_sw_place") / _WORD_BITS) == w, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"mask_{w}") for w in words]
    return rows.select(*key, place.cast("bigint").alias("_sw_place")).groupBy(*key).agg(*masks), versions


def mask_histogram(masks: DataFrame) -> DataFrame:
    """``(mask_0, ..., keys)``: keys per set of versions. All overlaps follow from it."""
    words = [c for c in masks.columns if c.startswith("mask_")]
    return masks.groupBy(*words).agg(F.count(F.lit(1)).alias("keys"))


def versions_of_masks(histogram: DataFrame, versions: Sequence) -> DataFrame:
    """The histogram with the versions of each set as an array."""
    flags = []
    for i, v in enumerate(versions):
        bit = F.call_function("shiftright", F.col(f"mask_{i // _WORD_BITS}"), F.lit(i % _WORD_BITS)).bitwiseAND(F.lit(1))
        flags.append(F.when(bit == 1, F.lit(v)))
    return histogram.withColumn("versions", F.array_compact(F.array(*flags)))


def overlap_matrix(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """``(version_a, version_b, keys_a, keys_b, common, a_in_b_percent)`` for every ordered pair that shares a key.

    The keys are shuffled once for all versions; pairs are formed from the sets
    of versions that occur, not from keys.
    """
    masks, versions = version_masks(df, key, version)
    if not versions:
        kind = dict(df.dtypes)[version]
        return df.sparkSession.createDataFrame(
            [], f"version_a {kind}, version_b {kind}, keys_a bigint, keys_b bigint, common bigint, a_in_b_percent double"
        )
    sets = versions_of_masks(mask_histogram(masks), versions).select("versions", "keys")
    firsts = sets.select(F.explode("versions").alias("version_a"), "versions", "keys")
    pairs = firsts.select("version_a", F.explode("versions").alias("version_b"), "keys")
    common = pairs.groupBy("version_a", "version_b").agg(F.sum("keys").alias("common"))
    # a version's own keys are those it shares with itself: no second pass, one row per version
    own = [F.max(F.when(F.col("version_a") == F.col("version_b"), F.col("common"))).over(Window.partitionBy(c)) for c in ("version_a", "version_b")]
    sized = common.withColumns({"keys_a": own[0], "keys_b": own[1]}).filter("version_a <> version_b")
    contained = X.ratio(F.col("common"), F.col("keys_a"))
    return sized.select("version_a", "version_b", "keys_a", "keys_b", "common", contained.alias("a_in_b_percent"))


def date_ranges(df: DataFrame, version: str, column: str) -> DataFrame:
    return df.groupBy(version).agg(
        F.count("*").alias("rows"), F.min(column).alias("earliest"), F.max(column).alias("latest")
    )


def in_several_versions(df: DataFrame, key: Sequence[str], version: str) -> DataFrame:
    """Keys present in more than one version, with the number of versions."""
    pairs = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])).select(*key, version).distinct()
    return pairs.groupBy(*key).agg(F.count(version).alias("versions")).filter("versions > 1")


def version_statistics(df: DataFrame, version: str, value: str) -> DataFrame:
    """Rows, share of rows with a value, and its median per version."""
    present = F.avg(F.col(value).isNotNull().cast("double")).alias("available_rate")
    return quantiles.group_statistics(df, [version], value, {"median": 0.5}, [F.count("*").alias("rows"), present])


# ------------------------------------------------------------------- structure


def presence_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per combination of set and unset columns (at most 2^n rows)."""
    flags = [(~_missing(df, c)).alias(f"has_{c}") for c in columns]
    return df.select(*flags).groupBy(*[f"has_{c}" for c in columns]).agg(F.count("*").alias("rows"))


def presence_disagreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows where exactly one of two columns is set."""
    return df.agg(F.count_if(_missing(df, a) != _missing(df, b)).alias("disagreeing_rows"))


def cross_table(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long cross table ``(a, b, rows, row_share)``.

    Long form needs no list of the values of ``b`` before the plan is built; see
    :func:`pivot_counts` where the values are known.
    """
    counts = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("rows"))
    return counts.withColumn("row_share", F.col("rows") / F.sum("rows").over(Window.partitionBy(a)))


def pivot_counts(df: DataFrame, a: str, b: str, values: Sequence) -> DataFrame:
    cells = [F.count_if(F.col(b) == v).alias(str(v)) for v in values]
    return df.filter(F.col(a).isNotNull()).groupBy(a).agg(*cells)


def flag_consistency(df: DataFrame, flag: Column, derived: Column) -> DataFrame:
    """Share of rows, in percent, where a stored flag equals its definition."""
    agrees = flag.eqNullSafe(derived)
    return df.agg(
        F.avg(agrees.cast("double") * 100).alias("agreement_percent"), F.count_if(~agrees).alias("exceptions")
    )


def flag_exceptions(df: DataFrame, flag: Column, derived: Column) -> DataFrame:
    return df.filter(~flag.eqNullSafe(derived))


def seeded_sample(df: DataFrame, key: Sequence[str], n: int, seed: int) -> DataFrame:
    """``n`` rows in a seeded hash order of their key: the same rows every time."""
    order = F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key]), 256)
    return df.orderBy(order, *key).limit(n)
