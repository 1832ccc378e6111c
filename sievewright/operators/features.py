"""Feature store: typed, filled, normalised columns plus derived flags."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievewright.functions import columns as X
from sievewright.operators import quantiles
from sievewright.session import bound_batches
from sievewright.specs import FeatureConfig


# what the fields of a config declare their columns to be; of several fields the first one counts
_DECLARED = {
    "identifiers": "identifier",
    "lists": "list",
    "epoch_ms": "datetime",
    "datetimes": "datetime",
    "booleans": "boolean",
    "categories": "category",
    "texts": "text",
    "numbers": "number",
}


def column_kinds(df: DataFrame, config: FeatureConfig) -> dict[str, str]:
    """What each column of ``df`` is treated as: as declared, else by its type (``number`` or ``other``)."""
    declared: dict[str, str] = {}
    for field, kind in _DECLARED.items():
        for name in getattr(config, field):
            declared.setdefault(name, kind)
    return {name: declared.get(name, "number" if X.is_numeric(dtype) else "other") for name, dtype in df.dtypes}


def schema_fingerprint(df: DataFrame, form: str = "sorted_pairs") -> str:
    """SHA-256 of names and types.

    ``sorted_pairs``: sorted ``name:type`` joined by ``|``; ``ordered_json``: JSON
    in column order; ``sorted_json``: JSON with sorted keys.
    """
    types = dict(df.dtypes)
    if form == "sorted_pairs":
        text = "|".join(sorted(f"{c}:{t}" for c, t in types.items()))
    elif form in ("ordered_json", "sorted_json"):
        text = json.dumps(types, sort_keys=form == "sorted_json")
    else:
        raise ValueError(f"unknown fingerprint form {form!r}")
    return hashlib.sha256(text.encode()).hexdigest()


def schema_drift(df: DataFrame, expected: str, form: str = "sorted_pairs") -> bool:
    return schema_fingerprint(df, form) != expected


def to_numbers(df: DataFrame, names: Sequence[str]) -> DataFrame:
    types = dict(df.dtypes)
    changes = {c: X.to_double(F.col(c), types[c]) for c in names if c in types and types[c] == "string"}
    return df.withColumns(changes) if changes else df


def drop_identifiers(df: DataFrame, config: FeatureConfig) -> DataFrame:
    return df.drop(*[c for c, kind in column_kinds(df, config).items() if kind == "identifier"])


def to_datetimes(df: DataFrame, config: FeatureConfig) -> DataFrame:
    types = dict(df.dtypes)
    changes = {c: X.epoch_ms_to_timestamp(F.col(c), types[c]) for c in config.epoch_ms if c in types}
    changes |= {
        c: X.text_to_timestamp(F.col(c)) for c in config.datetimes if c in types and c not in config.epoch_ms
    }
    return df.withColumns(changes) if changes else df


def datetime_losses(df: DataFrame, config: FeatureConfig) -> DataFrame:
    """Per datetime column, the values that could not be read as a time."""
    names = [c for c in dict.fromkeys((*config.epoch_ms, *config.datetimes)) if c in df.columns]
    before_columns = df.select("*", *[F.col(c).alias(f"_sw_raw_{c}") for c in names])
    both = to_datetimes(before_columns, config)
    lost = [F.count_if(F.col(f"_sw_raw_{c}").isNotNull() & F.col(c).isNull()).alias(c) for c in names]
    return both.agg(F.lit(0).alias("_sw"), *lost).unpivot(["_sw"], names, "column", "lost").drop("_sw")


# ------------------------------------------------------------------ fill values


# a mode is found in the column's own type: the slot its type goes to
_SLOTS = {"whole": "bigint", "number": "double", "text": "string", "time": "timestamp"}


def _slot(dtype: str) -> str | None:
    if X.is_numeric(dtype):
        return "whole" if dtype in X.INTEGRAL else "number"
    if dtype in ("timestamp", "timestamp_ntz", "date"):
        return "time"
    return "text" if dtype == "string" else None


def fill_plan(df: DataFrame, config: FeatureConfig) -> dict[str, str]:
    """Strategy per column: ``median``, ``mode``, ``constant``; others stay.

    Times are filled like texts, unless their strategy is named.
    """
    chosen: dict[str, str] = {}
    kinds = column_kinds(df, config)
    for name, dtype in df.dtypes:
        if kinds[name] == "list" or _slot(dtype) is None:
            continue
        default = config.numeric_strategy if X.is_numeric(dtype) else config.text_strategy
        strategy = config.fill_strategies.get(name, default)
        if strategy == "median" and not X.is_numeric(dtype):
            continue
        if strategy in ("median", "mode", "constant"):
            chosen[name] = strategy
    return chosen


def _few_values(df: DataFrame, names: Sequence[str], most: int) -> DataFrame:
    """``names`` of ``df``, blank where a column surely has more than ``most`` values.

    Hashes are dealt to buckets: more full buckets than ``most`` prove more
    values. A task holds its full buckets only, and free texts are never moved.
    """
    buckets = 16 * (most + 1)
    full = [F.size(F.collect_set(F.pmod(F.xxhash64(c), F.lit(buckets)))).alias(c) for c in names]
    checked = df.withColumn("_sw_full", df.agg(*full).select(F.struct(*names)).scalar())
    return checked.withColumns({c: F.when(F.col(f"_sw_full.{c}") <= most, F.col(c)) for c in names}).drop("_sw_full")


def modes(df: DataFrame, names: Sequence[str], max_distinct: int | None) -> DataFrame:
    """``(column, whole, number, text, time)``: the most frequent value, in the slot of the column's type.

    Ties go to the smallest value of that type. Texts and times with more than
    ``max_distinct`` values are left out; numbers never are. The columns are
    stacked and counted together, so one shuffle serves them all.
    """
    slots = {c: _slot(t) for c, t in df.dtypes if c in set(names)}
    limited = [c for c in names if slots[c] in ("text", "time")]
    data = df.select(*names)
    if max_distinct is not None and limited:
        data = _few_values(data, limited, max_distinct)
    stacked = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                *[(F.col(c) if slots[c] == s else F.lit(None)).cast(t).alias(s) for s, t in _SLOTS.items()],
            )
            for c in names
        ]
    )
    long = data.select(F.inline(stacked)).filter(F.coalesce(*[F.col(s).cast("string") for s in _SLOTS]).isNotNull())
    counts = long.groupBy("column", *_SLOTS).agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("column").orderBy(F.desc("n"), *_SLOTS)
    best = counts.withColumn("_sw_place", F.row_number().over(order)).filter("_sw_place = 1")
    if max_distinct is not None and limited:
        distinct = counts.groupBy("column").agg(F.count(F.lit(1)).alias("_sw_distinct"))
        best = best.join(distinct, "column")
        best = best.filter(~F.col("column").isin(limited) | (F.col("_sw_distinct") <= max_distinct))
    return best.select("column", *_SLOTS)


def _as_row(long: DataFrame, values: dict[str, str]) -> Column:
    """``(column, ...)`` rows as one struct, each column's value from the named one, read as a scalar subquery."""
    picked = [F.max(F.when(F.col("column") == c, F.col(value))).alias(c) for c, value in values.items()]
    return long.agg(*picked).select(F.struct(*values)).scalar()


def fill_missing(df: DataFrame, config: FeatureConfig) -> DataFrame:
    """Fill nulls by strategy. Medians and modes are scalar subqueries, so the
    fill itself is a projection and the whole stays one lazy plan."""
    plan = fill_plan(df, config)
    types = dict(df.dtypes)
    by_median = [c for c, s in plan.items() if s == "median"]
    by_mode = [c for c, s in plan.items() if s == "mode"]
    fills: dict[str, Column] = {}
    if by_median:
        row = _as_row(quantiles.medians(df, by_median), dict.fromkeys(by_median, "median"))
        df = df.withColumn("_sw_medians", row)
        for c in by_median:
            # a median may have a fraction, so filled columns are doubles
            fills[c] = F.coalesce(F.col(c).cast("double"), F.col(f"_sw_medians.{c}"))
    if by_mode:
        slots = {c: _slot(types[c]) for c in by_mode}
        df = df.withColumn("_sw_modes", _as_row(modes(df, by_mode, config.mode_max_distinct), slots))
        fills |= {c: F.coalesce(F.col(c), F.col(f"_sw_modes.{c}").try_cast(types[c])) for c in by_mode}
    for c, strategy in plan.items():
        if strategy == "constant":
            default = config.numeric_constant if X.is_numeric(types[c]) else config.text_constant
            value = config.fill_constants.get(c, default)
            if isinstance(value, str) and types[c] != "string":
                fills[c] = F.coalesce(F.col(c).cast("string"), F.lit(value))
            else:
                fills[c] = F.coalesce(F.col(c), F.lit(value))
    return (df.withColumns(fills) if fills else df).drop("_sw_medians", "_sw_modes")


# -------------------------------------------------------------- normalisations


def to_booleans(df: DataFrame, config: FeatureConfig) -> DataFrame:
    types = dict(df.dtypes)
    changes = {c: X.truthy(F.col(c), types[c]) for c in config.booleans if c in types}
    return df.withColumns(changes) if changes else df


def clean_categories(df: DataFrame, config: FeatureConfig) -> DataFrame:
    bound_batches(df.sparkSession)
    types = dict(df.dtypes)
    changes = {
        c: X.category(F.col(c)) if types[c] == "string" else X.category_token(F.col(c).cast("string"))
        for c in config.categories
        if c in types
    }
    return df.withColumns(changes) if changes else df


def clean_texts(df: DataFrame, config: FeatureConfig) -> DataFrame:
    bound_batches(df.sparkSession)
    types = dict(df.dtypes)

    def source(c: str) -> Column:
        # parity mode turns missing text into the word for it
        return F.coalesce(F.col(c), F.lit("<NA>")) if config.parity else F.col(c)

    changes = {c: X.normal_text(source(c)) for c in config.texts if types.get(c) == "string"}
    return df.withColumns(changes) if changes else df


def standardise_lists(df: DataFrame, config: FeatureConfig) -> DataFrame:
    bound_batches(df.sparkSession)
    types = dict(df.dtypes)
    changes = {
        c: X.join_list(X.list_tokens(F.col(c), types[c]), config.list_delimiter) for c in config.lists if c in types
    }
    return df.withColumns(changes) if changes else df


# -------------------------------------------------------------- derived columns


def presence_flags(df: DataFrame, config: FeatureConfig) -> dict[str, Column]:
    flags = {
        name: reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in parts])
        for name, parts in config.presence_flags.items()
        if all(c in df.columns for c in parts)
    }
    salaries = [F.col(c).cast("double") for c in config.salary_columns if c in df.columns]
    if salaries:
        flags["salary_available"] = F.coalesce(*salaries).isNotNull()
    return flags


def list_counts(df: DataFrame, config: FeatureConfig) -> dict[str, Column]:
    """Lengths of the standardised lists.

    A count the bridge join made is over all values; the list is cut short. The
    count is kept and the length goes to ``<name>_listed``, except in parity mode.
    """
    lengths = {}
    for name, source in config.list_counts.items():
        if source in df.columns:
            target = name if config.parity or name not in df.columns else f"{name}_listed"
            lengths[target] = X.list_length(F.col(source), config.list_delimiter)
    return lengths


def drop_duplicates(df: DataFrame, config: FeatureConfig) -> DataFrame:
    if not config.drop_duplicates:
        return df
    return df.dropDuplicates(list(config.duplicate_subset) if config.duplicate_subset else None)


class FeatureStoreInvalid(ValueError):
    pass


def missing_expected(df: DataFrame, config: FeatureConfig) -> list[str]:
    expected = (*config.epoch_ms, *config.datetimes, *config.booleans, *config.categories, *config.texts, *config.lists)
    return [c for c in dict.fromkeys(expected) if c not in df.columns]


def validate_features(df: DataFrame, config: FeatureConfig) -> list[str]:
    """Raise on an unusable store; return expected columns that are absent.

    Reads at most one row, to see that there is one.
    """
    repeated = {c for c in df.columns if df.columns.count(c) > 1}
    if repeated:
        raise FeatureStoreInvalid(f"repeated column names: {sorted(repeated)}")
    derived = [*config.presence_flags, *config.list_counts] + (["salary_available"] if config.salary_columns else [])
    lost = [c for c in derived if c not in df.columns]
    if lost:
        raise FeatureStoreInvalid(f"derived columns not created: {lost}")
    if not df.columns or df.isEmpty():
        raise FeatureStoreInvalid("the feature store is empty")
    return missing_expected(df, config)


@dataclass(frozen=True)
class FeatureBuild:
    source: DataFrame
    filled_from: DataFrame
    filled: DataFrame
    before_dedupe: DataFrame
    result: DataFrame


def build_features(df: DataFrame, config: FeatureConfig) -> FeatureBuild:
    """All steps in order. Booleans are converted and presence flags taken before
    anything is filled or rewritten; ``config.parity`` restores the late order."""
    typed = to_datetimes(drop_identifiers(to_numbers(df, config.numbers), config), config)
    early: dict[str, Column] = {}
    if not config.parity:
        typed = to_booleans(typed, config)
        early = presence_flags(typed, config)
        typed = typed.withColumns(early) if early else typed
    filled = fill_missing(typed, config)
    out = to_booleans(filled, config) if config.parity else filled
    out = standardise_lists(clean_texts(clean_categories(out, config), config), config)
    late = presence_flags(out, config) if config.parity else {}
    late |= list_counts(out, config)
    out = out.withColumns(late) if late else out
    return FeatureBuild(df, typed, filled, out, drop_duplicates(out, config))


def null_total(df: DataFrame) -> Column:
    """Number of null cells of a row."""
    return reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNull().cast("int") for c in df.columns])


def feature_summary(build: FeatureBuild, after: DataFrame | None = None) -> DataFrame:
    """One row: rows and nulls before and after, cells filled, copies removed.

    ``after`` is one row ``(rows, nulls)`` of the result, if it is known already.
    """
    before = build.source.agg(F.count(F.lit(1)).alias("rows"), F.sum(null_total(build.source)).alias("nulls"))
    unfilled = build.filled_from.agg(F.sum(null_total(build.filled_from)).alias("nulls"))
    filled = build.filled.agg(F.sum(null_total(build.filled)).alias("nulls"))
    if after is None:
        after = build.result.agg(F.count(F.lit(1)).alias("rows"), F.sum(null_total(build.result)).alias("nulls"))
    source = before.select(F.struct("rows", "nulls")).scalar()
    return (
        after.withColumns({"_b": source, "_u": unfilled.scalar(), "_f": filled.scalar()})
        .select(
            F.col("_b.rows").alias("rows_before"),
            F.col("rows").alias("rows_after"),
            F.col("_b.nulls").alias("nulls_before"),
            F.col("nulls").alias("nulls_after"),
            (F.col("_u") - F.col("_f")).alias("cells_filled"),
            (F.col("_b.rows") - F.col("rows")).alias("rows_removed"),
            F.lit(len(build.source.columns)).alias("columns_before"),
            F.lit(len(build.result.columns)).alias("columns_after"),
            F.lit(schema_fingerprint(build.result, "ordered_json")).alias("schema_hash"),
        )
    )
