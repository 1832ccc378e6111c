"""Rule validation. It only counts; the input is never changed.

Row rules (nulls, values, types) of a table share one aggregation, so the table
is scanned once for them however many rules there are. Key rules, unique keys
and references of all tables alike, share another: every table gives its keys,
tagged with the rule, in a second scan, the union is counted per key in one
shuffle, and a hot key costs one partial sum per task.

``scope`` names columns, such as the dataset version, that split the table:
every rule then holds within each scope value and is reported per value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.functions import columns as X
from sievewright.specs import CanonicalSchema, QualityGate, Reference, TableRules, ValueRule

REPORT_COLUMNS = ("table", "check", "column", "violations")


def structural_issues(columns: Sequence[str], rules: TableRules, schema: CanonicalSchema | None) -> list[tuple[str, str]]:
    """``(rule kind, column)`` for each configured column the table lacks."""
    wanted = {
        "not_null": rules.not_null,
        "unique_key": rules.unique_key,
        "values": tuple(rules.values),
        "references": tuple(r.column for r in rules.references),
        "dtypes": tuple(schema.dtypes) if schema else (),
    }
    return [(kind, c) for kind, names in wanted.items() for c in names if c not in columns]


def breaks_rule(c: Column, dtype: str, rule: ValueRule) -> Column:
    """True where a non-null value breaks any part of ``rule``."""
    parts = []
    if rule.allowed is not None:
        parts.append(~_is_member(c, dtype, rule.allowed))
    number = X.to_double(c, dtype)
    if rule.minimum is not None:
        parts.append(number < rule.minimum)
    if rule.maximum is not None:
        parts.append(number > rule.maximum)
    if rule.pattern is not None:
        # the pattern is tied to the start of the value only
        parts.append(~c.cast("string").rlike(f"^(?:{rule.pattern})"))
    # text that is no number breaks no bound: such comparisons are null, i.e. not true
    broken = [F.coalesce(p, F.lit(False)) for p in parts]
    present = ~F.isnan(c) & c.isNotNull() if dtype in X.FRACTIONAL else c.isNotNull()
    return present & reduce(lambda a, b: a | b, broken, F.lit(False))


def _is_member(c: Column, dtype: str, allowed: Sequence[object]) -> Column:
    # text columns may hold untyped numbers, so numbers are compared by value
    texts = [v for v in allowed if isinstance(v, str)]
    numbers = [float(v) for v in allowed if not isinstance(v, str)]
    member = F.lit(False)
    if numbers:
        member = member | F.coalesce(X.to_double(c, dtype).isin(*numbers), F.lit(False))
    if texts and not X.is_numeric(dtype):
        member = member | c.isin(*texts)
    return member


def _is_null(c: Column, dtype: str) -> Column:
    return c.isNull() | F.isnan(c) if dtype in X.FRACTIONAL else c.isNull()


def does_not_conform(c: Column, dtype: str, target: str) -> Column:
    """True where a non-null value cannot become the declared number."""
    if target not in X.INTEGRAL and target not in X.FRACTIONAL:
        return F.lit(False)
    return ~_is_null(c, dtype) & X.to_double(c, dtype).isNull()


def row_checks(
    df: DataFrame,
    table: str,
    rules: TableRules,
    schema: CanonicalSchema | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Row count, missing columns, null, value and type violations in one pass (zeros included)."""
    types = dict(df.dtypes)
    flags: list[tuple[str, str | None, Column]] = []
    flags += [("null", c, _is_null(df[c], types[c])) for c in rules.not_null if c in types]
    flags += [("value", c, breaks_rule(df[c], types[c], r)) for c, r in rules.values.items() if c in types]
    if schema:
        for c, target in schema.dtypes.items():
            if c in types and (target in X.INTEGRAL or target in X.FRACTIONAL):
                flags.append(("dtype", c, does_not_conform(df[c], types[c], target)))
    counts = df.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(flag).alias(f"_{i}") for i, (_, _, flag) in enumerate(flags)]
    )
    entries = [_entry("rows", None, F.col("_rows"))]
    entries += [_entry(check, c, F.col(f"_{i}")) for i, (check, c, _) in enumerate(flags)]
    # findings of the plan are literals of the same rows
    entries += [_entry("structure", f"{kind}.{c}", F.lit(1)) for kind, c in structural_issues(df.columns, rules, schema)]
    return counts.select(*scope, F.lit(table).alias("table"), F.inline(F.array(*entries)))


def _entry(check: str, column: str | None, count: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(column).cast("string").alias("column"),
        count.cast("bigint").alias("violations"),
    )


def duplicate_keys(df: DataFrame, key: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    """Keys that occur more than once, with the number of their rows."""
    by = [*scope, *key]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def duplicate_key_sample(df: DataFrame, key: Sequence[str], size: int = 5) -> DataFrame:
    """The ``size`` smallest duplicated keys (rows have no order to go by)."""
    return duplicate_keys(df, key).select(*key).orderBy(*key).limit(size)


def broken_references(
    child: DataFrame, parent: DataFrame, reference: Reference, scope: Sequence[str] = ()
) -> DataFrame:
    """Foreign-key values without a parent, with the number of child rows.

    The child is counted per key before the join, so the join sees each key once.
    """
    used = child.filter(child[reference.column].isNotNull()).groupBy(*scope, reference.column)
    keys = used.agg(F.count(F.lit(1)).alias("rows"))
    parents = parent.select(*scope, F.col(reference.parent_column).alias(reference.column)).distinct()
    return keys.join(parents, [*scope, reference.column], "left_anti")


@dataclass(frozen=True)
class _KeyRule:
    """A unique key, or a reference of ``table`` to ``parent``; ``types`` are those its columns are compared in."""

    check: str
    table: str
    columns: tuple[str, ...]
    types: tuple[str, ...]
    parent: str | None = None
    parent_column: str | None = None


def _family(dtype: str) -> str:
    return "bigint" if dtype in X.INTEGRAL else "double" if dtype in X.FRACTIONAL else "string"


def _common(child: str, parent: str) -> str:
    """The type both sides of a reference are compared in."""
    pair = {_family(child), _family(parent)}
    if len(pair) == 1:
        return pair.pop()
    return "double" if pair == {"bigint", "double"} else _family(parent)


def _key_rules(names: Sequence[str], rules: Mapping[str, TableRules], tables: Mapping[str, DataFrame]) -> list[_KeyRule]:
    found = []
    for name in names:
        held, types = rules.get(name), dict(tables[name].dtypes)
        if held is None:
            continue
        if held.unique_key and all(c in types for c in held.unique_key):
            found.append(_KeyRule("duplicate_key", name, tuple(held.unique_key), tuple(_family(types[c]) for c in held.unique_key)))
        for r in held.references:
            parent = tables.get(r.parent)
            if r.column in types and parent is not None and r.parent_column in parent.columns:
                common = _common(types[r.column], dict(parent.dtypes)[r.parent_column])
                found.append(_KeyRule("reference", name, (r.column,), (common,), r.parent, r.parent_column))
    return found


def _slots(rules: Sequence[_KeyRule]) -> list[tuple[str, str]]:
    """(name, type) of the columns that hold any rule's key: as many of a type as the widest key has."""
    widest = {t: max((r.types.count(t) for r in rules), default=0) for t in ("bigint", "double", "string")}
    return [(f"_{t}_{i}", t) for t, n in widest.items() for i in range(n)]


def _tagged(slots: list[tuple[str, str]], rule: int, own: bool, values: list[Column], types: Sequence[str], present: Column) -> Column:
    """One key of one rule as a struct; ``own`` rows are the parents of a reference."""
    filled, taken = {}, {}
    for value, dtype in zip(values, types, strict=True):
        n = taken[dtype] = taken.get(dtype, -1) + 1
        filled[f"_{dtype}_{n}"] = value.try_cast(dtype)
    columns = [filled.get(name, F.lit(None).cast(dtype)).alias(name) for name, dtype in slots]
    return F.struct(F.lit(rule).alias("_rule"), F.lit(own).alias("_own"), present.alias("_present"), *columns)


def key_checks(
    names: Sequence[str], rules: Mapping[str, TableRules], tables: Mapping[str, DataFrame], scope: Sequence[str] = ()
) -> DataFrame | None:
    """Violations of the unique keys and references of the tables ``names``; None if there are no such rules.

    Each table is scanned once for all rules it takes part in, as child or as
    parent, and all their keys are counted in one group-by. A null reference is
    no violation. Texts and numbers are compared as what the parent holds; a text
    that is no number has no parent. Equal rows count on either side of a key.
    """
    found = _key_rules(names, rules, tables)
    if not found:
        return None
    slots, parts = _slots(found), []
    for name, df in tables.items():
        keys = []
        for i, rule in enumerate(found):
            if rule.table == name:
                present = F.lit(True) if rule.check == "duplicate_key" else df[rule.columns[0]].isNotNull()
                keys.append(_tagged(slots, i, False, [df[c] for c in rule.columns], rule.types, present))
            if rule.parent == name:
                keys.append(_tagged(slots, i, True, [df[rule.parent_column]], rule.types, df[rule.parent_column].isNotNull()))
        if keys:
            parts.append(df.select(*scope, F.inline(F.array(*keys))).filter("_present"))
    keys = reduce(DataFrame.unionByName, parts).groupBy(*scope, "_rule", *[name for name, _ in slots])
    counted = keys.agg(F.count_if(~F.col("_own")).alias("_rows"), F.count_if("_own").alias("_parents"))
    unique = F.array(*[F.lit(r.check == "duplicate_key") for r in found])[F.col("_rule")]
    broken = (unique & (F.col("_rows") > 1)) | (~unique & (F.col("_rows") > 0) & (F.col("_parents") == 0))
    totals = counted.filter(broken).groupBy(*scope, "_rule").agg(F.sum("_rows").cast("bigint").alias("violations"))
    texts = {"table": [r.table for r in found], "check": [r.check for r in found], "column": [",".join(r.columns) for r in found]}
    named = [F.array(*map(F.lit, values))[F.col("_rule")].alias(c) for c, values in texts.items()]
    return totals.select(*scope, *named, "violations")


def _report(
    names: Sequence[str],
    rules: Mapping[str, TableRules],
    tables: Mapping[str, DataFrame],
    schemas: Mapping[str, CanonicalSchema],
    scope: Sequence[str],
) -> DataFrame:
    parts = []
    for name in names:
        df = tables[name]
        if name in rules:
            parts.append(row_checks(df, name, rules[name], schemas.get(name), scope))
            continue
        counts = df.groupBy(*scope).agg(F.count(F.lit(1)).alias("_rows"))
        entries = F.array(_entry("rows", None, F.col("_rows")), _entry("no_rules", None, F.lit(0)))
        parts.append(counts.select(*scope, F.lit(name).alias("table"), F.inline(entries)))
    keys = key_checks(names, rules, tables, scope)
    # zero rows are dropped after the union, so each part stays a plain aggregate
    report = reduce(DataFrame.unionByName, parts if keys is None else [*parts, keys])
    return report.filter((F.col("violations") > 0) | F.col("check").isin("rows", "no_rules"))


def table_report(
    df: DataFrame,
    table: str,
    rules: TableRules | None,
    tables: Mapping[str, DataFrame],
    schema: CanonicalSchema | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Long report ``(*scope, table, check, column, violations)``; zeros omitted.

    Every table has a ``rows`` entry; a table without rules has ``no_rules``.
    """
    schemas = {table: schema} if schema else {}
    return _report([table], {table: rules} if rules else {}, {**tables, table: df}, schemas, scope)


def skipped_references(tables: Mapping[str, DataFrame], rules: Mapping[str, TableRules]) -> list[tuple[str, str]]:
    """References that cannot be checked because the parent is not there."""
    return [
        (name, r.column)
        for name in tables
        if name in rules
        for r in rules[name].references
        if r.parent not in tables or r.parent_column not in tables[r.parent].columns
    ]


def validate(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    schemas: Mapping[str, CanonicalSchema] | None = None,
    scope: Sequence[str] = (),
) -> DataFrame:
    """Report over all tables; see :func:`table_report`."""
    return _report(list(tables), rules, tables, schemas or {}, scope)


def table_verdicts(report: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Per table: row count, whether rules exist, whether all of them hold."""
    finding = ~F.col("check").isin("rows", "no_rules")
    return report.groupBy(*scope, "table").agg(
        F.sum(F.when(F.col("check") == "rows", F.col("violations"))).alias("rows"),
        (F.count_if(F.col("check") == "no_rules") == 0).alias("rules_defined"),
        (F.count_if(finding) == 0).alias("passed"),
    )


def summary(report: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """One row of totals over a report."""

    def total(check: str) -> Column:
        picked = F.sum(F.when(F.col("check") == check, F.col("violations")))
        return F.coalesce(picked, F.lit(0)).cast("bigint")

    per_table = report.groupBy(*scope, "table").agg(
        (F.count_if(F.col("check") == "no_rules") > 0).alias("skipped"),
        (F.count_if(~F.col("check").isin("rows", "no_rules")) > 0).alias("failed"),
        *[total(c).alias(c) for c in ("structure", "null", "duplicate_key", "value", "dtype", "reference")],
    )
    return per_table.agg(
        F.count(F.lit(1)).alias("tables"),
        F.count_if(~F.col("failed") & ~F.col("skipped")).alias("tables_passed"),
        F.count_if("failed").alias("tables_failed"),
        F.count_if("skipped").alias("tables_skipped"),
        F.sum("structure").alias("structural_issues"),
        F.sum("null").alias("null_violations"),
        F.sum("duplicate_key").alias("duplicate_key_rows"),
        F.sum("value").alias("invalid_values"),
        F.sum("dtype").alias("dtype_issues"),
        F.sum("reference").alias("broken_references"),
    )


class QualityGateFailed(ValueError):
    """One or more gated kinds of finding occurred."""


def gate_findings(summary_row: DataFrame, gate: QualityGate) -> DataFrame:
    """``(finding, violations, gated, stops)`` per kind of finding."""
    gated = {
        "structural_issues": gate.structure,
        "null_violations": gate.nulls,
        "duplicate_key_rows": gate.duplicate_keys,
        "invalid_values": gate.invalid_values,
        "dtype_issues": gate.dtype_conformance,
        "broken_references": gate.broken_references,
    }
    count = {name: F.coalesce(F.col(name), F.lit(0)).cast("bigint") for name in gated}
    rows = [
        F.struct(
            F.lit(name).alias("finding"),
            count[name].alias("violations"),
            F.lit(on).alias("gated"),
            (F.lit(on) & (count[name] > 0)).alias("stops"),
        )
        for name, on in gated.items()
    ]
    return summary_row.select(F.inline(F.array(*rows)))


def enforce(summary_row: DataFrame, gate: QualityGate) -> None:
    """Raise one error that names every gated finding. Runs the summary if anything is gated."""
    if gate == QualityGate():
        return
    found = [
        f"{r.violations} {r.finding.replace('_', ' ')}" for r in gate_findings(summary_row, gate).filter("stops").collect()
    ]
    if found:
        raise QualityGateFailed("validation failed: " + "; ".join(found))
