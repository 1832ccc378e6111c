"""Master table: one row per fact row, whatever is joined to it.

All joins are left equi-joins of the fact with a right side reduced to one row
per key. Joins on the same key of the fact follow each other, and each key gets
one salt: rows of its heavy keys (and null keys) are dealt to :data:`SALTS`
tasks, and only the right rows of heavy keys are copied for them. So the fact is
shuffled once per key, however many tables are joined on it, and a hot key is
split in every one of these joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sievewright.operators import dedupe
from sievewright.specs import BridgeJoin, DimensionJoin, SnapshotJoin


# tasks among which the rows of one heavy key are dealt
SALTS = 32
# a key is heavy if it holds more than this share of the rows, so there are fewer than its inverse
HEAVY_SHARE = 0.002


@dataclass(frozen=True)
class Joined:
    """A fact with its joins so far. ``matches`` maps a join to its flag column."""

    df: DataFrame
    matches: dict[str, str] = field(default_factory=dict)
    kinds: dict[str, str] = field(default_factory=dict)
    created: tuple[str, ...] = ()
    dropped: tuple[str, ...] = ()
    skipped: tuple[str, ...] = ()

    @property
    def result(self) -> DataFrame:
        return self.df.drop(*self.matches.values())


@dataclass(frozen=True)
class _Right:
    """One table to join, reduced to a row per key; ``new`` are the columns it adds."""

    name: str
    kind: str
    left_key: str
    right_key: str
    rows: DataFrame
    new: tuple[str, ...]
    dropped: tuple[str, ...]
    flag: str


def _heavy_keys(fact: DataFrame, by: Sequence[str]) -> DataFrame | None:
    """Values of ``by`` that hold more than :data:`HEAVY_SHARE` of the rows, null keys aside; None if there are none.

    Runs a job: partial counts over the key columns alone. The values, fewer than
    the inverse of the share, become a literal table, so the plans of the fact and
    of every table joined on the key do not each find them again.
    """
    counts = fact.groupBy(*by).agg(F.count(F.lit(1)).alias("_sw_n"))
    rows = counts.agg(F.sum("_sw_n")).scalar()
    found = counts.filter((F.col("_sw_n") > rows * HEAVY_SHARE) & F.col(by[-1]).isNotNull()).select(*by)
    keys = found.collect()
    return fact.sparkSession.createDataFrame(keys, found.schema) if keys else None


def _marked(df: DataFrame, heavy: DataFrame | None, by: Sequence[str]) -> DataFrame:
    """``df`` with ``_sw_wide``, true where the key is heavy or null."""
    bare = F.col(by[-1]).isNull()
    if heavy is None:
        return df.withColumn("_sw_wide", bare)
    mark = heavy.select(*[F.col(c).alias(f"_sw_heavy_{i}") for i, c in enumerate(by)], F.lit(True).alias("_sw_is_heavy"))
    on = reduce(lambda a, b: a & b, [df[c].eqNullSafe(mark[f"_sw_heavy_{i}"]) for i, c in enumerate(by)])
    marked = df.join(F.broadcast(mark), on, "left")
    return marked.withColumn("_sw_wide", F.coalesce("_sw_is_heavy", F.lit(False)) | bare).drop(*mark.columns)


def _with_salt(df: DataFrame, heavy: DataFrame | None, by: Sequence[str], salt: str) -> DataFrame:
    """``df`` with a salt: spread for heavy keys and for null ones, 0 for all others."""
    # any value of the row will do, as long as a repeated task finds the same
    spread = F.pmod(F.xxhash64(*[c for c, t in df.dtypes if "map" not in t]), F.lit(SALTS)).cast("int")
    return _marked(df, heavy, by).withColumn(salt, F.when(F.col("_sw_wide"), spread).otherwise(0)).drop("_sw_wide")


def _copies(rows: DataFrame, heavy: DataFrame | None, by: Sequence[str], salt: str) -> DataFrame:
    """``rows`` with the salt 0, and with every salt where the key is heavy or null."""
    salts = F.when(F.col("_sw_wide"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return _marked(rows, heavy, by).withColumn(salt, F.explode(salts)).drop("_sw_wide")


def _join_on_key(
    df: DataFrame, fact: DataFrame, key: str, rights: Sequence[_Right], scope: Sequence[str], null_safe: bool
) -> DataFrame:
    """All ``rights`` that join on ``key`` of the fact, over one salted partitioning of it."""
    by = [*scope, key]
    source = fact if all(c in fact.columns for c in by) else df
    heavy = _heavy_keys(source.select(*by), by)
    salt = "_sw_salt"
    joined = _with_salt(df, heavy, by, salt)
    for i, right in enumerate(rights):
        keyed = right.rows.select(
            *[F.col(c) for c in scope],
            F.col(right.right_key).alias(key),
            *[F.col(c).alias(f"_sw_new_{j}") for j, c in enumerate(right.new)],
            F.lit(True).alias(right.flag),
        )
        side = _copies(keyed, heavy, by, salt)
        side = side.select(*[F.col(c).alias(f"_sw_on_{j}") for j, c in enumerate([*by, salt])], *keyed.columns[len(by) :])
        on = [joined[c] == side[f"_sw_on_{j}"] for j, c in enumerate([*by, salt])]
        if null_safe:
            on[len(scope)] = joined[key].eqNullSafe(side[f"_sw_on_{len(scope)}"])
        met = joined.join(side, reduce(lambda a, b: a & b, on), "left").drop(*[f"_sw_on_{j}" for j in range(len(on))])
        joined = met.withColumnsRenamed({f"_sw_new_{j}": c for j, c in enumerate(right.new)})
    return joined.drop(salt)


def _order(df: DataFrame, order_by: Sequence[str], key: Sequence[str]) -> list[Column]:
    """Given order, else all other columns, so that ties never fall at random."""
    names = [c for c in order_by if c in df.columns] or [c for c in df.columns if c not in key]
    return [F.col(c) for c in names] or [F.lit(0)]


def _bookkeeping(order_by: Sequence[str]) -> list[str]:
    """Order columns of ours, such as the ingest id, that no join should add."""
    return [c for c in order_by if c.startswith("_")]


def dimension_rows(
    df: DataFrame, spec: DimensionJoin, order_by: Sequence[str] = (), scope: Sequence[str] = ()
) -> DataFrame:
    key = [*scope, spec.right_key]
    order = _order(df, order_by, key)
    if spec.keep == "last":
        order = [c.desc_nulls_first() for c in order]
    kept = dedupe.first_per_key(df, key, order).drop(*_bookkeeping(order_by))
    return kept.withColumnsRenamed(dict(spec.rename))


def snapshot_rows(
    df: DataFrame, spec: SnapshotJoin, order_by: Sequence[str] = (), scope: Sequence[str] = ()
) -> DataFrame:
    """Newest row per key (unknown times last); ties follow ``order_by``."""
    key = [*scope, spec.right_key]
    order = _order(df, order_by, key)
    if spec.latest_by and spec.latest_by in df.columns:
        order = [F.col(spec.latest_by).desc_nulls_last(), *order]
    kept = dedupe.first_per_key(df, key, order).drop(*_bookkeeping(order_by))
    return kept.withColumnsRenamed(dict(spec.rename))


def resolve_bridge(
    bridge: DataFrame, spec: BridgeJoin, tables: Mapping[str, DataFrame], scope: Sequence[str] = ()
) -> DataFrame:
    """``(*scope, key, value)`` rows, ids replaced by names where a lookup exists.

    Pairs are counted before the lookup, so it joins each pair once, and the
    lookup is reduced to one row per id so that it cannot multiply pairs.
    """
    by = [*scope, spec.key, spec.value]
    pairs = bridge.filter(F.col(spec.key).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("_sw_n"))
    lookup = tables.get(spec.lookup) if spec.lookup else None
    if lookup is None:
        return pairs.select(*scope, spec.key, F.col(spec.value).alias("_sw_value"), "_sw_n")
    names = lookup.groupBy(*scope, F.col(spec.lookup_key).alias(spec.value)).agg(
        F.min(spec.lookup_name).alias("_sw_value")
    )
    return pairs.join(names, [*scope, spec.value], "left").select(*scope, spec.key, "_sw_value", "_sw_n")


def bridge_rows(
    bridge: DataFrame, spec: BridgeJoin, tables: Mapping[str, DataFrame], scope: Sequence[str] = ()
) -> DataFrame:
    """One row per key: distinct count, most frequent value, first values.

    Ties for the most frequent go to the smallest value. The list is cut to its
    ``list_size`` smallest values by a ranked filter before it is collected, so no
    key gathers more than that, while the count stays whole.
    """
    by = [*scope, spec.key]
    resolved = resolve_bridge(bridge, spec, tables, scope).filter(F.col("_sw_value").isNotNull())
    counts = resolved.groupBy(*by, "_sw_value").agg(F.sum("_sw_n").alias("_sw_n"))
    summaries = []
    if spec.with_count:
        summaries.append(F.count(F.lit(1)).alias(f"{spec.prefix}_count"))
    if spec.with_top:
        best = F.min(F.struct((-F.col("_sw_n")).alias("n"), F.col("_sw_value").alias("v")))
        summaries.append(best["v"].alias(f"top_{spec.prefix}"))
    result = counts.groupBy(*by).agg(*summaries) if summaries else counts.select(*by).distinct()
    if spec.with_list:
        window = Window.partitionBy(*by).orderBy("_sw_value")
        ranked = counts.withColumn("_sw_rank", F.row_number().over(window)).filter(F.col("_sw_rank") <= spec.list_size)
        # the count of a pair is read here too, so that both branches are one exchange to Spark
        ranked = ranked.filter(F.col("_sw_n") > 0)
        lists = ranked.groupBy(*by).agg(F.array_sort(F.collect_list("_sw_value")).alias(f"{spec.prefix}_list"))
        result = result.join(lists, by, "left")
    return result


def _rights(
    fact: DataFrame,
    tables: Mapping[str, DataFrame],
    dimensions: Sequence[DimensionJoin],
    snapshots: Sequence[SnapshotJoin],
    bridges: Sequence[BridgeJoin],
    order_by: Sequence[str],
    scope: Sequence[str],
) -> tuple[list[_Right], list[str]]:
    """The tables to join in the order of the specs, and the names of those left out.

    No column of the fact, or of an earlier table, is renamed or overwritten: an
    incoming column of that name is left out and reported.
    """
    rights: list[_Right] = []
    skipped: list[str] = []
    taken = list(fact.columns)
    for kind, specs in (("dimension", dimensions), ("snapshot", snapshots), ("bridge", bridges)):
        for spec in specs:
            if not spec.enabled or spec.table not in tables:
                skipped.append(spec.table)
                continue
            output = None
            if kind == "bridge":
                rows = bridge_rows(tables[spec.table], spec, tables, scope)
                left_key = right_key = spec.key
            else:
                reduced = dimension_rows if kind == "dimension" else snapshot_rows
                rows = reduced(tables[spec.table], spec, order_by, scope)
                left_key, right_key, output = spec.left_key, spec.rename.get(spec.right_key, spec.right_key), spec.output
            if left_key not in taken:
                raise ValueError(f"cannot join {spec.table}: the fact has no column {left_key}")
            incoming = [c for c in rows.columns if c not in (right_key, *scope) and (output is None or c in output)]
            new = tuple(c for c in incoming if c not in taken)
            dropped = tuple(f"{spec.table}.{c}" for c in incoming if c not in new)
            rights.append(_Right(spec.table, kind, left_key, right_key, rows, new, dropped, f"_sw_match_{len(rights)}"))
            taken += new
    return rights, skipped


def build_master(
    fact: DataFrame,
    tables: Mapping[str, DataFrame],
    dimensions: Sequence[DimensionJoin] = (),
    snapshots: Sequence[SnapshotJoin] = (),
    bridges: Sequence[BridgeJoin] = (),
    *,
    order_by: Sequence[str] = (),
    scope: Sequence[str] = (),
    null_safe: bool = False,
) -> Joined:
    """Join dimensions, snapshots and bridges to the fact.

    Disabled specs and absent tables are recorded as skipped. Null keys match
    nothing unless ``null_safe``. With ``scope`` (the version column) all versions
    are joined in one plan. Runs one small job per key joined on, for its heavy
    values; the joins themselves are lazy.
    """
    rights, skipped = _rights(fact, tables, dimensions, snapshots, bridges, order_by, scope)
    df = fact
    for key in dict.fromkeys(r.left_key for r in rights):
        df = _join_on_key(df, fact, key, [r for r in rights if r.left_key == key], scope, null_safe)
    counts = {f"{spec.prefix}_count" for spec in bridges if spec.with_count}
    filled = {c for r in rights if r.kind == "bridge" for c in r.new if c in counts}
    columns = [*fact.columns, *(c for r in rights for c in (*r.new, r.flag))]
    df = df.select(
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) if c in filled else F.col(c) for c in columns]
    )
    return Joined(
        df,
        {r.name: r.flag for r in rights},
        {r.name: r.kind for r in rights},
        tuple(c for r in rights for c in r.new),
        tuple(c for r in rights for c in r.dropped),
        tuple(skipped),
    )


def match_statistics(state: Joined, scope: Sequence[str] = ()) -> DataFrame:
    """Matched and unmatched fact rows per join, from one pass over the flags."""
    flags = state.matches
    counts = state.df.groupBy(*scope).agg(
        F.count(F.lit(1)).alias("rows_total"), *[F.count(flag).alias(name) for name, flag in flags.items()]
    )
    return match_report(counts, state, scope)


def match_report(counts: DataFrame, state: Joined, scope: Sequence[str] = ()) -> DataFrame:
    """The statistics from ``counts``, ``(*scope, rows_total, a column of matched rows per join)``."""
    kinds = F.create_map(*[F.lit(x) for pair in state.kinds.items() for x in pair])
    long = counts.unpivot([*scope, "rows_total"], list(state.matches), "table", "rows_matched")
    return long.select(
        *scope,
        "table",
        kinds[F.col("table")].alias("join_type"),
        "rows_total",
        "rows_matched",
        (F.col("rows_total") - F.col("rows_matched")).alias("rows_unmatched"),
        F.coalesce(F.try_divide("rows_matched", "rows_total"), F.lit(0.0)).alias("match_rate"),
    )


def column_coverage(state: Joined, scope: Sequence[str] = ()) -> DataFrame:
    """Share of non-null values per created column, in percent."""
    wide = state.df.groupBy(*scope).agg(*[F.avg(F.col(c).isNotNull().cast("double") * 100).alias(c) for c in state.created])
    return wide.unpivot(list(scope), list(state.created), "column", "coverage")


class IntegrityError(ValueError):
    """The master table lost, gained or duplicated fact rows."""


def integrity_counts(before: DataFrame, after: DataFrame, key: str, scope: Sequence[str] = ()) -> DataFrame:
    """One row: fact rows, master rows, distinct keys, null keys."""
    per_key = after.groupBy(*scope, key).agg(F.count(F.lit(1)).alias("_sw_n"))
    totals = per_key.agg(
        F.coalesce(F.sum("_sw_n"), F.lit(0)).alias("rows_after"),
        F.count_if(F.col(key).isNotNull()).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("_sw_n"))), F.lit(0)).alias("null_keys"),
    )
    fact_rows = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    return totals.select(fact_rows.alias("rows_before"), "rows_after", "distinct_keys", "null_keys")


def enforce_integrity(counts: DataFrame) -> None:
    """Raise unless rows are kept and the key is unique and set. Runs a job."""
    row = counts.first()
    problems = []
    if row["rows_before"] != row["rows_after"]:
        problems.append(f"row count went from {row['rows_before']} to {row['rows_after']}")
    if row["null_keys"]:
        problems.append(f"{row['null_keys']} rows have no key")
    if row["distinct_keys"] != row["rows_after"] - row["null_keys"]:
        problems.append("the key is not unique")
    if problems:
        raise IntegrityError("; ".join(problems))


def union_versions(versions: Mapping[str, DataFrame], column: str = "dataset_version") -> DataFrame:
    """Union by column name with a version tag; absent columns become null."""
    tagged = [df.withColumn(column, F.lit(name)) for name, df in versions.items()]
    result = tagged[0]
    for df in tagged[1:]:
        result = result.unionByName(df, allowMissingColumns=True)
    return result


def master_summary(master: DataFrame, state: Joined, version: str = "dataset_version") -> DataFrame:
    """One row about the build: versions, rows, joins done, columns created."""
    return master.agg(
        F.count_distinct(version).alias("versions"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(state.matches)).alias("joins"),
        F.lit(len(state.created)).alias("columns_created"),
        F.lit(len(state.skipped)).alias("tables_skipped"),
    )


def keep_matching(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``keys`` (semi join)."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def keep_missing(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``keys`` (anti join)."""
    return df.join(keys.select(*on).distinct(), list(on), "left_anti")
