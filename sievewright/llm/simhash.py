"""Near duplicates by SimHash, found in an index of positional bytes.

Fingerprints that differ in at most 4 of 64 bits differ in at most 4 of 8
bytes, so they share at least 4 bytes at the same positions. The index counts
that minimum in its keys: one key per choice of 4 positions (70) with the
bytes there. Two fingerprints meet under a key exactly if their tally of
shared positional bytes reaches 4; their bits are then verified. Postings of
single bytes would hold a 256th of all fingerprints each, and the pairs inside
them grow with the square of the input.

Sizes per key come from partial aggregates. A key with two members yields its
pair from them; members of keys with up to ``most_pairwise`` are compared
pairwise. Larger keys hold dense groups: their members are linked through
midpoints instead, exactly and without pairs. Two fingerprints are at most 4
bits apart if and only if some word is at most 2 bits from both, so joining
each to the 2081 words around it gives the same components, in rows linear in
the members.

Null and empty texts have the fingerprint zero and are linked like any other.
Repeated rows share a fingerprint. Null doc_ids belong to the component of
their fingerprint but never name it, unless it has no other ids (then null).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from sievewright.llm.common import as_bytes, bound_batches, fresh, map_texts, materialize, sized, texts_of
from sievewright.llm.components import components

MOST_BITS = 4
_PART = 1 << 15


def fingerprint(data: bytes | None, shingle: int = 4) -> int:
    """Majority of the bits of all shingles' XXH64, as a signed 64-bit number."""
    words = (data or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    text = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = np.array([digest(text, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[: n - shingle] + 1)).tolist()
        stops = ends[shingle - 1 :].tolist()
        hashes = np.fromiter((digest(text[i:j], 42) for i, j in zip(starts, stops, strict=True)), np.uint64, len(stops))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _PART):
        part = hashes[at : at + _PART].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fp) for every row."""
    return map_texts(texts_of(docs, id_column, text_column), lambda texts: [[fingerprint(t) for t in texts]], "fp long")


def _signed(word: int) -> int:
    return word - (1 << 64) if word >> 63 else word


def _masks() -> list[int]:
    """A mask per choice of 4 of the 8 byte positions."""
    return [_signed(sum(0xFF << 8 * i for i in four)) for four in combinations(range(8), 4)]


def _ball() -> list[int]:
    """All words with at most 2 bits set."""
    return [0, *(_signed(1 << i) for i in range(64)), *(_signed(1 << i | 1 << j) for i, j in combinations(range(64), 2))]


def _words(values: list[int]):
    """An array literal; parsed as one SQL text, as thousands of literals would be slow to build."""
    return F.expr("array(" + ", ".join(f"cast('{v}' as bigint)" for v in values) + ")")


def _postings(fps: DataFrame) -> DataFrame:
    """(choice, bytes, fp): the 70 index entries of every fingerprint.

    Fingerprints are few bytes, so a task would read millions; they are dealt
    out first, to as many tasks as shuffles have.
    """
    tasks = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in _masks()])
    return fps.repartition(tasks, "fp").select("fp", F.posexplode(keys).alias("choice", "bytes"))


def _near(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= MOST_BITS


def links(fps: DataFrame, most_pairwise: int = 16) -> DataFrame:
    """Edges (a, b) between different fingerprints at most 4 bits apart, enough to connect all that are linked."""
    key = ["choice", "bytes"]
    postings = _postings(fps)
    sizes = postings.groupBy(*key).agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    sizes = materialize(sizes.filter("n > 1"))
    twos = sizes.filter("n = 2").filter(_near("a", "b")).select("a", "b")
    larger = materialize(sizes.filter("n > 2").select(*key, (F.col("n") > most_pairwise).alias("dense")))
    members = materialize(postings.join(sized(larger), key).select(*key, "fp", "dense"))
    few = members.filter("not dense").drop("dense")
    pairs = (
        few.withColumnRenamed("fp", "a")
        .join(few.withColumnRenamed("fp", "b").hint("merge"), key)
        .filter((F.col("a") < F.col("b")) & _near("a", "b"))
        .select("a", "b")
    )
    dense = members.filter("dense").select("fp").distinct()
    around = F.transform(_words(_ball()), lambda m: m.bitwiseXOR(F.col("fp")))
    middles = dense.select("fp", F.explode(around).alias("middle"))
    met = middles.groupBy("middle").agg(F.min("fp").alias("least"), F.count("*").alias("n")).filter("n > 1")
    met = materialize(met.select("middle", "least"))
    stars = middles.join(sized(met), "middle").filter("fp > least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return materialize(twos.union(pairs).union(stars).distinct())


def _linked(docs: DataFrame, id_column: str, text_column: str, most_pairwise: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, fp) of every row; (fp, first, bare) of every fingerprint, ``bare`` if a null id has it; (node, root) of linked ones."""
    own = materialize(fingerprints(docs, id_column, text_column))
    fps = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("bare")))
    roots = components(links(fps.select("fp"), most_pairwise))
    # a root is in no row of its own; only linked fingerprints pass through here
    linked = materialize(roots.union(roots.select("root", "root")).distinct())
    return own, fps, linked


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", most_pairwise: int = 16) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest doc_id reachable over links."""
    own, fps, linked = _linked(docs, id_column, text_column, most_pairwise)
    firsts = linked.join(fps, linked["node"] == fps["fp"]).select("fp", "root", "first")
    named = materialize(firsts.groupBy("root").agg(F.min("first").alias("component")))
    moved = linked.join(named, "root").select(F.col("node").alias("fp"), "component")
    component = F.coalesce("component", "first").alias("component_id")
    names = materialize(fps.join(moved, "fp", "left").select("fp", component))
    return own.join(names, "fp").select("doc_id", "fp", "component_id")


def as_hex(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def _with_fingerprint(docs: DataFrame, column: str, text_column: str) -> DataFrame:
    """``docs`` with the fingerprint of every row's text as its last column."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([fingerprint(t) for t in as_bytes(batch.column(text_column))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, column])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(column, LongType())]))


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", most_pairwise: int = 16) -> DataFrame:
    """One row of every group of near duplicates: that with the smallest doc_id, all columns as they are.

    A row is told by its doc_id and fingerprint, so different texts under one
    doc_id are judged each in its own group. Of a group's rows with a null
    doc_id one stays as well, that with the least fingerprint.
    """
    _, fps, linked = _linked(docs, id_column, text_column, most_pairwise)
    grouped = fps.join(linked, fps["fp"] == linked["node"], "left").withColumn("group", F.coalesce("root", "fp"))
    group = materialize(grouped.select("group", "fp", "first", "bare"))
    key, mark, own, turn = (fresh(docs, f"_sw_{c}") for c in ("first", "mark", "own", "turn"))
    named = group.filter(F.col("first").isNotNull()).groupBy("group").agg(F.min(F.struct("first", "fp")).alias("x"))
    named = materialize(named.select(F.col("x.first").alias(key), F.col("x.fp").alias(mark)))
    bare = materialize(group.filter("bare").groupBy("group").agg(F.min("fp").alias(mark)).select(mark))

    def once(rows: DataFrame, *columns: str) -> DataFrame:
        order = Window.partitionBy(*columns).orderBy(F.xxhash64(f"`{text_column}`"))
        return rows.withColumn(turn, F.row_number().over(order)).filter(F.col(turn) == 1).drop(turn)

    known = F.col(f"`{id_column}`").isNotNull()
    told = _with_fingerprint(docs.filter(known), own, text_column)
    told = told.join(named, (F.col(f"`{id_column}`") == F.col(key)) & (F.col(own) == F.col(mark)), "left_semi")
    # copies without an id can be many: all but one go before they are shuffled
    untold = once(_with_fingerprint(docs.filter(~known), own, text_column), own)
    untold = untold.join(bare, F.col(own) == F.col(mark), "left_semi")
    return once(told, f"`{id_column}`", own).union(untold).drop(own)
