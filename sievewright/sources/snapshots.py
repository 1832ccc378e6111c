"""Published tables: a folder per write, and numbered pointer files that name the folders a table consists of.

A write goes into a folder of its own and touches nothing that is published.
Publishing adds one small file under ``_published``; readers follow the complete
one with the largest number. So they see the table before a write or after it,
never between, and a write that fails leaves the table as it was. Nothing is
renamed or deleted on the way, which object stores do file by file.

The parts of a partitioned table may lie in different snapshots. Some can be
replaced or dropped alone, and the others are neither read nor copied.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

POINTERS = "_published"


class NothingPublished(ValueError):
    """No table was published under this path."""


class PublishConflict(RuntimeError):
    """Another run published the table meanwhile."""


@dataclass(frozen=True)
class Part:
    """``snapshot`` and, of a partitioned table, the ``folder`` of one partition in it; relative to the table."""

    snapshot: str
    folder: str = ""


@dataclass(frozen=True)
class Pointer:
    number: int
    schema: StructType
    parts: tuple[Part, ...]
    #: what the writer keeps with the table, such as the fingerprints of its source
    state: object = None


def file_system(spark: SparkSession, path: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def _numbers(spark: SparkSession, root: str) -> list[int]:
    files, folder = file_system(spark, f"{root}/{POINTERS}")
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit())


def _pointer_path(root: str, number: int) -> str:
    return f"{root}/{POINTERS}/{number:012d}.json"


def _load(spark: SparkSession, root: str, number: int) -> Pointer | None:
    files, path = file_system(spark, _pointer_path(root, number))
    stream = files.open(path)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        held = json.loads(text)
    except ValueError:
        return None  # a writer was lost while it wrote this pointer
    return Pointer(number, StructType.fromJson(held["schema"]), tuple(Part(*p) for p in held["parts"]), held["state"])


def current(spark: SparkSession, root: str) -> Pointer | None:
    """The newest complete pointer of a table; None if nothing was published."""
    for number in reversed(_numbers(spark, root)):
        found = _load(spark, root, number)
        if found is not None:
            return found
    return None


def publish(spark: SparkSession, root: str, schema: StructType, parts: Sequence[Part], state: object = None, seen: int | None = None) -> Pointer:
    """Make ``parts`` the table. ``seen`` is the number the writer started from; a later one is a conflict."""
    last = max(_numbers(spark, root), default=0)
    newest = current(spark, root)
    if seen is not None and (newest.number if newest else 0) != seen:
        raise PublishConflict(f"{root}: number {last} was published after {seen}")
    held = {"schema": json.loads(schema.json()), "parts": [[p.snapshot, p.folder] for p in parts], "state": state}
    files, path = file_system(spark, _pointer_path(root, last + 1))
    try:
        out = files.create(path, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        raise PublishConflict(f"{root}: number {last + 1} was published meanwhile") from error
    out.write(bytearray(json.dumps(held).encode()))
    out.close()
    return Pointer(last + 1, schema, tuple(parts), state)


def stage(df: DataFrame, root: str, partition_by: Sequence[str] = (), dataset_id: str | None = None) -> list[Part]:
    """Write ``df`` into a new snapshot, unpublished: ``archive/<id>``, which must be new, or a folder of no name."""
    spark = df.sparkSession
    snapshot = f"archive/{dataset_id}" if dataset_id is not None else f"snapshots/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(f"{root}/{snapshot}")
    if not partition_by:
        return [Part(snapshot)]
    files, pattern = file_system(spark, f"{root}/{snapshot}" + "/*=*" * len(partition_by))
    found = [status.getPath().toString().rstrip("/").split("/") for status in files.globStatus(pattern)]
    return [Part(snapshot, "/".join(names[-len(partition_by) :])) for names in sorted(found)]


def part_folder(spark: SparkSession, column: str, value: object) -> str:
    """The folder Spark gives a partition value."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return names.getPartitionPathString(column, None if value is None else str(value))


def read_parts(spark: SparkSession, root: str, schema: StructType, parts: Sequence[Part]) -> DataFrame:
    """The rows of ``parts``; columns a snapshot was written without are null."""
    by_snapshot: dict[str, list[str]] = {}
    for part in parts:
        by_snapshot.setdefault(part.snapshot, []).append(f"{root}/{part.snapshot}/{part.folder}".rstrip("/"))
    read = spark.read.schema(schema)
    tables = [read.option("basePath", f"{root}/{s}").parquet(*folders).select(*[f"`{c}`" for c in schema.names]) for s, folders in by_snapshot.items()]
    return reduce(DataFrame.union, tables) if tables else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str) -> DataFrame:
    """The published table."""
    found = current(spark, root)
    if found is None:
        raise NothingPublished(f"nothing published under {root}")
    return read_parts(spark, root, found.schema, found.parts)


def write(
    df: DataFrame, root: str, partition_by: Sequence[str] = (), dataset_id: str | None = None, state: object = None
) -> DataFrame:
    """Write ``df`` and make it the table; returns the written copy."""
    parts = stage(df, root, partition_by, dataset_id)
    publish(df.sparkSession, root, df.schema, parts, state)
    return read_parts(df.sparkSession, root, df.schema, parts)


def replace(
    df: DataFrame | None,
    root: str,
    partition_by: str,
    values: Collection[object],
    dataset_id: str | None = None,
    state: object = None,
) -> DataFrame | None:
    """Replace the partitions of ``values`` by the rows of ``df`` (None: drop them); returns the rows written.

    Other partitions stay as they are. Columns that only one side has are null
    on the other.
    """
    spark = df.sparkSession if df is not None else SparkSession.active()
    return replace_folders(df, root, partition_by, {part_folder(spark, partition_by, v) for v in values}, dataset_id, state)


def replace_folders(
    df: DataFrame | None,
    root: str,
    partition_by: str,
    folders: Collection[str],
    dataset_id: str | None = None,
    state: object = None,
) -> DataFrame | None:
    """:func:`replace` for partitions told by their folders."""
    spark = df.sparkSession if df is not None else SparkSession.active()
    before = current(spark, root)
    new = stage(df, root, [partition_by], dataset_id) if df is not None else []
    gone = {*folders, *(p.folder for p in new)}
    kept = [p for p in before.parts if p.folder not in gone] if before else []
    fields = list(before.schema.fields) if before else []
    known = {f.name for f in fields}
    if df is not None:
        fields += [f for f in df.schema.fields if f.name not in known]
    publish(spark, root, StructType(fields), [*kept, *new], state, before.number if before else 0)
    return read_parts(spark, root, df.schema, new) if df is not None else None


def drop_unused(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete the unnamed snapshots that none of the last ``keep`` pointers names, and older pointers; archives stay.

    To be called when no reader follows an older pointer and no writer is at work.
    """
    numbers = _numbers(spark, root)
    used = {p.snapshot for n in numbers[-keep:] for p in (_load(spark, root, n) or Pointer(n, StructType(), ())).parts}
    files, folder = file_system(spark, f"{root}/snapshots")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    unused = sorted(n for n in names if f"snapshots/{n}" not in used)
    for path in [f"{root}/snapshots/{n}" for n in unused] + [_pointer_path(root, n) for n in numbers[:-keep]]:
        files, made = file_system(spark, path)
        files.delete(made, True)
    return unused
