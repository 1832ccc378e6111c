"""Schema alignment: one projection per table, plus reports.

Names are resolved when the plan is built; aligning a table adds one ``select``
and no job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.specs import CanonicalSchema

UNMAPPED_PREFIX = "unmapped__"


class MissingColumns(ValueError):
    """A required column has no source column."""


@dataclass(frozen=True)
class Alignment:
    """How the columns of one table map to its canonical schema."""

    renamed: dict[str, str]
    missing: tuple[str, ...]
    unmapped: tuple[str, ...]
    known: bool = True


def resolve(columns: Iterable[str], candidates: Iterable[str]) -> str | None:
    """First candidate present in ``columns``, ignoring case."""
    by_lower = {c.lower(): c for c in columns}
    return next((by_lower[c.lower()] for c in candidates if c.lower() in by_lower), None)


def plan_alignment(columns: Iterable[str], schema: CanonicalSchema | None) -> tuple[dict[str, str], Alignment]:
    columns = list(columns)
    if schema is None:
        return {}, Alignment({}, (), tuple(columns), known=False)
    sources = {c.name: resolve(columns, c.candidates) for c in schema.columns}
    lost = [c.name for c in schema.columns if c.required and sources[c.name] is None]
    if lost:
        raise MissingColumns(f"required columns not found: {', '.join(lost)}")
    found = {name: source for name, source in sources.items() if source is not None}
    return found, Alignment(
        renamed={name: source for name, source in found.items() if name != source},
        missing=tuple(name for name in sources if name not in found),
        unmapped=tuple(c for c in columns if c not in set(found.values())),
    )


def align(
    df: DataFrame,
    schema: CanonicalSchema | None,
    *,
    keep_unmapped: bool = True,
    prefix: str = UNMAPPED_PREFIX,
    passthrough: tuple[str, ...] = (),
) -> tuple[DataFrame, Alignment]:
    """Project ``df`` to its canonical columns, in canonical order.

    Columns the schema does not know are kept behind ``prefix`` or dropped, and
    reported either way. ``passthrough`` names columns of ours, such as the
    version tag, which stay as they are. A table without a schema passes.
    """
    own = [c for c in passthrough if c in df.columns]
    sources, report = plan_alignment([c for c in df.columns if c not in own], schema)
    if schema is None:
        return df, report
    selected = [
        df[sources[c.name]].alias(c.name)
        if c.name in sources
        else F.lit(None).cast(c.dtype or "string").alias(c.name)
        for c in schema.columns
    ]
    if keep_unmapped:
        selected += [df[c].alias(prefix + c) for c in report.unmapped]
    return df.select(*selected, *own), report


def empty_required(df: DataFrame, schema: CanonicalSchema) -> DataFrame:
    """Required columns that hold no value at all: one row each, one pass."""
    required = [c.name for c in schema.columns if c.required and c.name in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in required])
    long = counts.unpivot(["_rows"], required, "column", "present")
    return long.filter((F.col("present") == 0) & (F.col("_rows") > 0)).select("column")


def alignment_report(df: DataFrame, table: str, report: Alignment) -> DataFrame:
    """Long report ``(table, finding, column, source, rows)`` of one alignment."""
    findings = [("renamed", name, source) for name, source in report.renamed.items()]
    findings += [("missing", name, None) for name in report.missing]
    findings += [("unmapped", name, name) for name in report.unmapped]
    if not report.known:
        findings.append(("no_schema", None, None))
    # the findings become literals of the one-row count, so the report costs one count
    rows = [
        F.struct(
            F.lit(finding).alias("finding"),
            F.lit(column).cast("string").alias("column"),
            F.lit(source).cast("string").alias("source"),
        )
        for finding, column, source in findings
    ]
    counted = df.agg(F.count(F.lit(1)).alias("rows"))
    exploded = F.array(*rows) if rows else F.array().cast("array<struct<finding:string,column:string,source:string>>")
    return counted.select(F.lit(table).alias("table"), "rows", F.inline(exploded))


def alignment_summary(reports: DataFrame) -> DataFrame:
    """Totals of :func:`alignment_report` rows over all tables."""
    return reports.agg(
        F.count_distinct("table").alias("tables"),
        F.count_if(F.col("finding") == "renamed").alias("renamed"),
        F.count_if(F.col("finding") == "missing").alias("missing"),
        F.count_if(F.col("finding") == "unmapped").alias("unmapped"),
    )


def align_all(
    tables: Mapping[str, DataFrame],
    schemas: Mapping[str, CanonicalSchema],
    **options,
) -> tuple[dict[str, DataFrame], dict[str, Alignment]]:
    aligned, reports = {}, {}
    for name, df in tables.items():
        aligned[name], reports[name] = align(df, schemas.get(name), **options)
    return aligned, reports
