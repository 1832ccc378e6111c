"""Reading versioned dumps: ``<root>/Version_<n>/<table>.csv`` and Parquet."""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from sievewright.functions import columns as X
from sievewright.sources import snapshots
from sievewright.specs import CanonicalSchema

VERSION = "dataset_version"
INGEST_ID = "_ingest_id"

# Texts a CSV cell may hold for "no value".
CSV_NULLS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


class SourceError(ValueError):
    """A dump is incomplete or empty."""


def list_files(spark: SparkSession, root: str, pattern: str = "{Version_*/*,Version_*/*.csv/*}") -> list[str]:
    """Paths of the tables below ``root``, by Spark's own listing.

    Only names are read, so this works on any file system Spark can read. A table
    may be one file or a directory of part files with the table's file name; its
    parts are one path, so the driver gets a row per table and version.
    """
    try:
        files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{pattern}")
        table = F.regexp_extract("path", r"^(.*/Version_\d+/[^/]+)", 1)
        files = files.select(F.coalesce(F.nullif(table, F.lit("")), "path").alias("path")).distinct()
        return sorted(r["path"] for r in files.collect())
    except AnalysisException as error:
        raise SourceError(f"no files found in {root}: {error}") from error


def source_files(spark: SparkSession, root: str) -> DataFrame:
    """``(dataset_version, path, bytes, changed_at)`` of every file of every version; no file is opened."""
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{{Version_*/*,Version_*/*.csv/*}}")
    version = F.regexp_extract("path", r"/(Version_\d+)/", 1)
    inside = F.regexp_extract("path", r"/Version_\d+/(.*)$", 1)
    return files.select(version.alias(VERSION), inside.alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("changed_at"))


def discover_versions(paths: Sequence[str]) -> list[str]:
    """``Version_<n>`` directories in the order of their number."""
    found = {m.group(1) for p in paths if (m := re.search(r"/(Version_\d+)/", p))}
    if not found:
        raise SourceError("no Version_<n> directory found")
    return sorted(found, key=lambda v: int(v.rsplit("_", 1)[1]))


def read_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """A CSV with header, all columns as text; types are given later.

    Missing-value spellings become null. Quoted cells may span lines, which ties
    each file to one task: deliver big tables as many part files, or switch
    ``multi_line`` off where no cell holds a line break.
    """
    df = (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*CSV_NULLS), F.col(f"`{c}`")) for c in df.columns})


def with_ingest_id(df: DataFrame) -> DataFrame:
    """Add an id that follows file and row order, for keep-first and keep-last.

    The id is only stable for a given set of input splits; write the ingested
    table once if it has to survive a re-read.
    """
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    position = F.format_string("%s#%020d#%020d", file, start, F.monotonically_increasing_id())
    return df.withColumn(INGEST_ID, position)


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """Raise on an empty table; reads at most one row."""
    if df.isEmpty():
        raise SourceError(f"{name} is empty")
    return df


def resolve_files(
    paths: Sequence[str], version: str, mandatory: Mapping[str, Sequence[str]], optional: Mapping[str, Sequence[str]]
) -> tuple[dict[str, str], list[str]]:
    """Path per table (first accepted name wins) and the optional tables missing."""
    here: dict[str, str] = {}
    for path in paths:
        before, found, inside = path.partition(f"/{version}/")
        if found:
            name = inside.split("/")[0]
            here[name] = f"{before}/{version}/{name}"
    chosen: dict[str, str] = {}
    absent: list[str] = []
    for name, accepted in {**mandatory, **optional}.items():
        hit = next((here[f] for f in accepted if f in here), None)
        if hit is not None:
            chosen[name] = hit
        elif name in mandatory:
            raise SourceError(f"{version}: mandatory table {name} not found, accepted: {', '.join(accepted)}")
        else:
            absent.append(name)
    return chosen, absent


def load_version(
    spark: SparkSession,
    paths: Sequence[str],
    version: str,
    mandatory: Mapping[str, Sequence[str]],
    optional: Mapping[str, Sequence[str]],
    check_empty: bool = True,
) -> dict[str, DataFrame]:
    chosen, absent = resolve_files(paths, version, mandatory, optional)
    for name in absent:
        warnings.warn(f"{version}: optional table {name} not found", stacklevel=2)
    tables = {name: with_ingest_id(read_csv(spark, path)) for name, path in chosen.items()}
    if check_empty:
        for name, df in tables.items():
            require_rows(df, f"{version}/{name}")
    return tables


def load_all(
    spark: SparkSession,
    root: str,
    mandatory: Mapping[str, Sequence[str]],
    optional: Mapping[str, Sequence[str]],
    check_empty: bool = True,
) -> dict[str, dict[str, DataFrame]]:
    """``{version: {table: DataFrame}}`` of a dump directory; plans only."""
    paths = list_files(spark, root)
    return {v: load_version(spark, paths, v, mandatory, optional, check_empty) for v in discover_versions(paths)}


def combine_versions(versions: Mapping[str, Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """One DataFrame per table over all versions, tagged with its version.

    Downstream each rule then runs once, however many versions there are.
    """
    combined: dict[str, DataFrame] = {}
    for version, tables in versions.items():
        for name, df in tables.items():
            tagged = df.withColumn(VERSION, F.lit(version))
            combined[name] = (
                combined[name].unionByName(tagged, allowMissingColumns=True) if name in combined else tagged
            )
    return combined


def read_table(spark: SparkSession, root: str) -> DataFrame:
    """A published table; NaN in double columns becomes null."""
    return _without_nan(snapshots.read(spark, root))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder; NaN in double columns becomes null."""
    return _without_nan(spark.read.parquet(path))


def _without_nan(df: DataFrame) -> DataFrame:
    doubles = {c: X.nan_to_null(F.col(f"`{c}`")) for c, t in df.dtypes if t == "double"}
    return df.withColumns(doubles) if doubles else df


def typed(df: DataFrame, schema: CanonicalSchema) -> DataFrame:
    """Cast the columns of a text table to their canonical types."""
    types = dict(df.dtypes)
    changes = {c: X.cast_to(F.col(c), types[c], t) for c, t in schema.dtypes.items() if c in types}
    return df.withColumns(changes)
