"""Table cleaning under explicit policies.

Steps per table, in this order: strings, nulls, types, bounds, duplicates,
orphans. Parents are cleaned before their children. The first four steps are one
projection and filter; duplicates and orphans shuffle on their keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from sievewright.functions import columns as X
from sievewright.operators import dedupe
from sievewright.specs import (
    CanonicalSchema,
    CleaningRule,
    DuplicatePolicy,
    InvalidValuePolicy,
    NullPolicy,
    OrphanPolicy,
    StringOptions,
)

_FOUND = "_sw_found"


def string_columns(df: DataFrame) -> list[str]:
    return [name for name, dtype in df.dtypes if dtype == "string"]


def _cleaned(c: Column, name: str, rule: CleaningRule, options: StringOptions) -> Column:
    return X.clean_string(
        c,
        trim=options.trim,
        collapse=options.collapse,
        lower=name in rule.lowercase,
        empty_to_null=options.empty_to_null,
    )


def clean_strings(
    df: DataFrame, rule: CleaningRule, options: StringOptions = StringOptions(), keep: Sequence[str] = ()
) -> DataFrame:
    """Trim, collapse blanks, lower-case where asked, empty texts to null."""
    names = [c for c in string_columns(df) if c not in keep]
    return df.withColumns({c: _cleaned(F.col(c), c, rule, options) for c in names})


def strings_changed(
    df: DataFrame, rule: CleaningRule, options: StringOptions = StringOptions(), keep: Sequence[str] = ()
) -> Column:
    """Number of cells of a row that :func:`clean_strings` changes."""
    flags = [
        F.when(F.col(c).eqNullSafe(_cleaned(F.col(c), c, rule, options)), 0).otherwise(1)
        for c in string_columns(df)
        if c not in keep
    ]
    return reduce(lambda a, b: a + b, flags, F.lit(0))


def handle_nulls(df: DataFrame, rule: CleaningRule) -> DataFrame:
    for name, policy in rule.null_policies.items():
        if name not in df.columns:
            continue
        if policy == NullPolicy.DROP_ROW:
            df = df.filter(F.col(name).isNotNull())
        elif policy == NullPolicy.FILL_DEFAULT and rule.fill_values.get(name) is not None:
            df = df.withColumn(name, F.coalesce(F.col(name), F.lit(rule.fill_values[name])))
    return df


def convert_types(df: DataFrame, schema: CanonicalSchema | None) -> DataFrame:
    """Canonical types; single values that do not fit become null."""
    if schema is None:
        return df
    types = dict(df.dtypes)
    changes = {
        c: X.cast_to(F.col(c), types[c], target)
        for c, target in schema.dtypes.items()
        if c in types and (types[c] != target or target == "double")
    }
    return df.withColumns(changes) if changes else df


def conversion_losses(df: DataFrame, schema: CanonicalSchema | None) -> DataFrame:
    """Per converted column, the number of values the conversion turns to null."""
    types = dict(df.dtypes)
    names = [c for c, t in (schema.dtypes if schema else {}).items() if types.get(c, t) != t]
    lost = [
        F.count_if(F.col(c).isNotNull() & X.cast_to(F.col(c), types[c], schema.dtypes[c]).isNull()).alias(c)
        for c in names
    ]
    if not names:
        return df.sparkSession.createDataFrame([], "column string, lost bigint")
    return df.agg(F.lit(0).alias("_sw"), *lost).unpivot(["_sw"], names, "column", "lost").drop("_sw")


def below_minimum(df: DataFrame, name: str, bound: float) -> Column:
    number = X.to_double(F.col(name), dict(df.dtypes)[name])
    return F.coalesce(number < bound, F.lit(False))


def handle_invalid(df: DataFrame, rule: CleaningRule) -> DataFrame:
    if rule.invalid_values == InvalidValuePolicy.LEAVE:
        return df
    for name, bound in rule.minimums.items():
        if name not in df.columns:
            continue
        bad = below_minimum(df, name, bound)
        if rule.invalid_values == InvalidValuePolicy.DROP_ROW:
            df = df.filter(~bad)
        else:
            df = df.withColumn(name, F.when(~bad, F.col(name)))
    return df


def remove_duplicates(
    df: DataFrame, rule: CleaningRule, order_by: Sequence[str], scope: Sequence[str] = ()
) -> DataFrame:
    """One row per key, or per whole row where the rule names no key."""
    key = [*scope, *rule.key] if rule.key else [c for c in df.columns if c not in order_by]
    if rule.duplicates == DuplicatePolicy.DROP_ALL:
        return dedupe.only_unique(df, key)
    if not rule.key and not set(order_by) & set(df.columns):
        return df.dropDuplicates()
    pick = dedupe.first_per_key if rule.duplicates == DuplicatePolicy.KEEP_FIRST else dedupe.last_per_key
    return pick(df, key, order_by)


def remove_orphans(
    df: DataFrame, rule: CleaningRule, parents: Mapping[str, DataFrame], scope: Sequence[str] = ()
) -> DataFrame:
    """Drop rows whose non-null foreign key has no parent.

    A parent table that is not there skips its check. Keys are joined with a
    marker, so rows with a null key pass the same join untouched.
    """
    if rule.orphans != OrphanPolicy.DROP_CHILD:
        return df
    for ref in rule.references:
        parent = parents.get(ref.parent)
        if ref.column not in df.columns or parent is None or ref.parent_column not in parent.columns:
            continue
        keys = (
            parent.filter(F.col(ref.parent_column).isNotNull())
            .select(*scope, F.col(ref.parent_column).alias(ref.column))
            .distinct()
            .withColumn(_FOUND, F.lit(True))
        )
        joined = df.join(keys, [*scope, ref.column], "left")
        df = joined.filter(F.col(_FOUND) | F.col(ref.column).isNull()).select(*df.columns)
    return df


@dataclass(frozen=True)
class CleanedTable:
    """The result, and the stages its report is counted from."""

    table: str
    source: DataFrame
    rule: CleaningRule
    options: StringOptions
    strings: DataFrame
    filled: DataFrame
    typed: DataFrame
    bounded: DataFrame
    unique: DataFrame
    result: DataFrame
    scope: tuple[str, ...]
    keep: tuple[str, ...]
    schema: CanonicalSchema | None = None


def clean_table(
    df: DataFrame,
    table: str,
    rule: CleaningRule,
    parents: Mapping[str, DataFrame],
    schema: CanonicalSchema | None = None,
    order_by: Sequence[str] = (),
    scope: Sequence[str] = (),
    options: StringOptions = StringOptions(),
) -> CleanedTable:
    """Run all steps on one table; ``parents`` holds the cleaned parents."""
    if rule.key and not order_by:
        raise ValueError(f"{table}: keep-first needs order_by, rows have no order of their own")
    keep = (*scope, *order_by)
    strings = clean_strings(df, rule, options, keep)
    filled = handle_nulls(strings, rule)
    typed = convert_types(filled, schema)
    bounded = handle_invalid(typed, rule)
    unique = remove_duplicates(bounded, rule, order_by, scope)
    result = remove_orphans(unique, rule, parents, scope)
    return CleanedTable(
        table, df, rule, options, strings, filled, typed, bounded, unique, result, tuple(scope), keep, schema
    )


def cleaning_report(cleaned: CleanedTable, rows_after: DataFrame | None = None) -> DataFrame:
    """Long report ``(*scope, table, metric, value)`` of one table.

    Row-local metrics and duplicates come from one pass over the source, counted
    per key; orphans from the size of the result. ``rows_after``, ``(*scope,
    rows_after)``, is that size if it is known already.
    """
    scope, rule = cleaned.scope, cleaned.rule
    typed_keys = [*scope, *(rule.key or [c for c in cleaned.bounded.columns if c not in cleaned.keep])]

    def metrics(df: DataFrame, **values: Column) -> DataFrame:
        wide = df.groupBy(*scope).agg(*[v.cast("bigint").alias(k) for k, v in values.items()])
        return wide.unpivot(list(scope), list(values), "metric", "value")

    ones = F.count(F.lit(1))
    changed = strings_changed(cleaned.source, rule, cleaned.options, cleaned.keep)
    staged = cleaned.source.withColumn("_sw_changed", changed)
    staged = clean_strings(staged, rule, cleaned.options, cleaned.keep)
    drops = [c for c, p in rule.null_policies.items() if p == NullPolicy.DROP_ROW and c in cleaned.strings.columns]
    fills = [
        c
        for c, p in rule.null_policies.items()
        if p == NullPolicy.FILL_DEFAULT and rule.fill_values.get(c) is not None and c in cleaned.strings.columns
    ]
    kept = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in drops], F.lit(True))
    filled = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in fills], F.lit(0))
    staged = staged.withColumns({"_sw_kept": kept, "_sw_filled": filled})
    # rows are flagged here, not dropped, so that one pass over the source counts every step
    fill_only = {c: p for c, p in rule.null_policies.items() if p != NullPolicy.DROP_ROW}
    staged = convert_types(handle_nulls(staged, replace(rule, null_policies=fill_only)), cleaned.schema)
    staged = staged.withColumn("_sw_invalid", _invalid_values(staged, rule).cast("bigint"))
    dropped = F.lit(False)
    if rule.invalid_values == InvalidValuePolicy.DROP_ROW:
        dropped = F.col("_sw_invalid") > 0
    staged = staged.withColumn("_sw_stays", F.col("_sw_kept") & ~dropped)
    if rule.invalid_values != InvalidValuePolicy.DROP_ROW:
        staged = handle_invalid(staged, rule)

    def of_kept(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("_sw_kept"), F.col(name))), F.lit(0))

    # one scan: the row-local counts of a key travel with the number of its rows
    per_key = staged.groupBy(*typed_keys).agg(
        ones.alias("rows_before"),
        F.sum("_sw_changed").alias("strings_modified"),
        F.count_if(~F.col("_sw_kept")).alias("null_rows_dropped"),
        of_kept("_sw_filled").alias("nulls_filled"),
        of_kept("_sw_invalid").alias("invalid_values_handled"),
        F.count_if("_sw_stays").alias("_sw_bounded"),
    )
    # copies beyond the first (or all copies) of each key
    n = F.col("_sw_bounded")
    surplus = F.when(n > 1, n if rule.duplicates == DuplicatePolicy.DROP_ALL else n - 1).otherwise(0)
    summed = [c for c in per_key.columns if c not in typed_keys]
    parts = [metrics(per_key, **{c: F.sum(c) for c in summed}, duplicates_removed=F.sum(surplus))]
    known = rows_after is not None
    after = F.sum("rows_after") if known else ones
    parts.append(metrics(rows_after if known else cleaned.result, rows_after=after))

    long = reduce(DataFrame.unionByName, parts)
    by_metric = {m: F.sum(F.when(F.col("metric") == m, F.col("value")).otherwise(0)) for m in _METRICS}
    wide = long.groupBy(*scope).agg(*[v.alias(m) for m, v in by_metric.items()])
    wide = wide.withColumns(
        {
            "rows_removed": F.col("rows_before") - F.col("rows_after"),
            "orphan_rows_removed": F.col("_sw_bounded") - F.col("duplicates_removed") - F.col("rows_after"),
        }
    ).drop("_sw_bounded")
    return wide.select(*scope, F.lit(cleaned.table).alias("table"), *[c for c in wide.columns if c not in scope])


_METRICS = (
    "rows_before",
    "rows_after",
    "strings_modified",
    "null_rows_dropped",
    "nulls_filled",
    "invalid_values_handled",
    "duplicates_removed",
    "_sw_bounded",
)


def _invalid_values(df: DataFrame, rule: CleaningRule) -> Column:
    """Values of a row that break their bound, as the rule counts them."""
    names = [c for c in rule.minimums if c in df.columns]
    if rule.invalid_values == InvalidValuePolicy.LEAVE or not names:
        return F.lit(0)
    flags = [below_minimum(df, c, rule.minimums[c]) for c in names]
    if rule.invalid_values == InvalidValuePolicy.NULLIFY:
        return reduce(lambda a, b: a + b, [f.cast("int") for f in flags])
    # a dropped row counts once, for the first bound it breaks
    return reduce(lambda a, b: a | b, flags).cast("int")


def cleaning_summary(reports: DataFrame) -> DataFrame:
    """Totals over table reports, with the share of rows removed."""
    names = [c for c in reports.columns if c.startswith(("rows_", "nulls_", "strings_", "invalid_")) or "removed" in c]
    total = reports.agg(F.count(F.lit(1)).alias("tables"), *[F.sum(c).alias(c) for c in names])
    return total.withColumn(
        "percent_removed", F.coalesce(X.ratio(F.col("rows_removed"), F.col("rows_before")), F.lit(0.0))
    )


def parents_first(tables: Sequence[str], rules: Mapping[str, CleaningRule]) -> list[str]:
    """Tables ordered so that every referenced table precedes its children."""
    ordered: list[str] = []

    def visit(name: str, path: tuple[str, ...]) -> None:
        if name in path:
            raise ValueError(f"references form a cycle: {' -> '.join((*path, name))}")
        if name in ordered or name not in tables:
            return
        for ref in rules.get(name, CleaningRule()).references:
            if ref.parent != name:
                visit(ref.parent, (*path, name))
        ordered.append(name)

    for name in tables:
        visit(name, ())
    return ordered


def clean_all(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, CleaningRule],
    schemas: Mapping[str, CanonicalSchema] | None = None,
    order_by: Sequence[str] = (),
    scope: Sequence[str] = (),
    options: StringOptions = StringOptions(),
    continue_on_error: bool = True,
) -> tuple[dict[str, CleanedTable], dict[str, str]]:
    """Clean all tables, parents first.

    A table whose plan cannot be built is left out and named in the second
    result, so its siblings still run.
    """
    cleaned: dict[str, CleanedTable] = {}
    failed: dict[str, str] = {}
    for name in parents_first(list(tables), rules):
        parents = {n: c.result for n, c in cleaned.items()}
        try:
            rule = rules.get(name, CleaningRule())
            schema = (schemas or {}).get(name)
            cleaned[name] = clean_table(tables[name], name, rule, parents, schema, order_by, scope, options)
        except (AnalysisException, ValueError) as error:
            if not continue_on_error:
                raise
            failed[name] = str(error)
    return cleaned, failed
