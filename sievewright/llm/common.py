"""What the operators share: folds, per-text passes, tables in the shared folder."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievewright.session import bound_batches

#: Tables of up to this many narrow rows may be sent to all tasks.
BROADCAST_ROWS = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    A local session that names none, as in tests, gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="sievewright-")


def ship(spark: SparkSession) -> None:
    """Hand this package to the Python workers, once, if nothing tells them where it is."""
    root = Path(__file__).resolve().parents[2]
    told = {Path(p).resolve() for p in [*os.environ.get("PYTHONPATH", "").split(":"), os.getcwd()] if p}
    context = spark.sparkContext
    if root in told or getattr(context, "_sievewright_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="sievewright-")
    context.addPyFile(shutil.make_archive(f"{folder}/sievewright", "zip", root, "sievewright"))
    context._sievewright_shipped = True


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` into the shared folder and read it back (runs a job).

    Cuts the lineage: a lost executor costs the tasks that read the table, not
    the work behind it, and later plans know its true size.
    """
    path = f"{shared_folder(df.sparkSession)}/sievewright/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` as a side of a join: sent to all tasks if it is counted to be small, else joined by sorting.

    Spark's own estimate ignores how many rows an explode makes, so it would
    also send out the other, exploded side. ``df`` should be a written table.
    """
    return F.broadcast(df) if df.count() <= rows else df.hint("merge")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(key: str, folds: int) -> Column:
    """CRC-32 of the key's text modulo ``folds``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


def is_fold(key: str, folds: int, number: int) -> Column:
    """False for a null key."""
    return F.coalesce(fold(key, folds) == number, F.lit(False))


def texts_of(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only id and text, so that no other column can clash with a result."""
    bound_batches(docs.sparkSession)
    return docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))


def as_bytes(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def map_texts(
    texts: DataFrame, compute: Callable[[list[bytes | None]], list], schema: str
) -> DataFrame:
    """One row per row of ``texts`` (doc_id, text, ...): its other columns, then ``compute`` of the texts.

    ``compute`` takes the UTF-8 texts of an Arrow batch and returns one column of
    values per column of ``schema``.
    """
    kept = [c for c in texts.columns if c != "text"]
    types = dict(texts.dtypes)
    full = ", ".join([f"`{c}` {types[c]}" for c in kept] + [schema])
    names = kept + [part.split()[0] for part in schema.split(", ")]
    target = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "int": pa.int32()}
    new = [target[part.split()[1]] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            computed = compute(as_bytes(batch.column("text")))
            arrays = [batch.column(c) for c in kept] + [pa.array(v, t) for v, t in zip(computed, new, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return texts.mapInArrow(run, full)
