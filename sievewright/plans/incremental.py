"""Rebuilding only what changed: the partitions of a published table whose source differs from the last time.

What a partition was built from is told by a fingerprint stored in the table's
pointer, so rows and fingerprints are published together. A source that is a
published table itself needs no fingerprint of its rows: snapshots never change,
so a partition is unchanged as long as it lies in the same snapshot.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from sievewright.operators import fingerprint
from sievewright.sources import snapshots

_MEASURES = "rows bigint, hash_xor bigint, hash_sum decimal(38,0), config_hash string"


@dataclass(frozen=True)
class Changes:
    """The values of a partition column by what became of their source, and the fingerprints to store."""

    status: Mapping[object, str]
    state: tuple

    @property
    def to_build(self) -> list:
        return sorted((v for v, s in self.status.items() if s in ("new", "changed")), key=str)

    @property
    def to_drop(self) -> list:
        return sorted((v for v, s in self.status.items() if s in ("changed", "gone")), key=str)


def find_changes(current: DataFrame, root: str, by: str) -> Changes:
    """What differs between ``current``, a fingerprint per value of ``by``, and that stored with the table ``root``.

    Runs a job over the fingerprints, one row per value.
    """
    spark, kind = current.sparkSession, dict(current.dtypes)[by]
    rows = current.select(by, "rows", "hash_xor", "hash_sum", "config_hash").collect()
    schema = f"`{by}` {kind}, {_MEASURES}"
    pointer = snapshots.current(spark, root)
    then = pointer.state if pointer and pointer.state else []
    stored = spark.createDataFrame([tuple(r) for r in then], f"`{by}` {kind}, rows bigint, hash_xor bigint, hash_sum string, config_hash string")
    stored = stored.withColumn("hash_sum", stored["hash_sum"].cast("decimal(38,0)"))
    now = spark.createDataFrame([tuple(r) for r in rows], schema)
    status = {r[0]: r[1] for r in fingerprint.changes(now, stored, [by]).collect()}
    return Changes(status, tuple((r[0], r[1], r[2], str(r[3]), r[4]) for r in rows))


def rebuild_changed(
    current: DataFrame,
    root: str,
    by: str,
    build: Callable[[Sequence], DataFrame],
    dataset_id: str | None = None,
) -> tuple[DataFrame, Changes]:
    """Bring the table ``root`` up to date and read it.

    ``build`` makes the rows of the values it is given and reads only their
    source. New and changed values are built, gone ones are dropped, and the
    others keep their files. Rows and fingerprints are published by one pointer,
    so a run that fails is simply repeated.
    """
    spark: SparkSession = current.sparkSession
    found = find_changes(current, root, by)
    if found.to_build or found.to_drop:
        made = build(found.to_build) if found.to_build else None
        values = {*found.to_build, *found.to_drop}
        snapshots.replace(made, root, by, values, dataset_id, [list(r) for r in found.state])
    return snapshots.read(spark, root), found


def rebuild_from(
    source: str,
    spark: SparkSession,
    root: str,
    by: str,
    build: Callable[[DataFrame], DataFrame],
    config_hash: str = "",
) -> tuple[DataFrame, dict[str, str]]:
    """Bring ``root`` up to date with the published table ``source``, both partitioned by the column ``by``.

    ``build`` makes the rows of a partition from that partition of the source
    alone, so it is given the new and changed ones only and reads no others.
    Returns the table and what became of every partition folder.
    """
    pointer = snapshots.current(spark, source)
    if pointer is None:
        raise snapshots.NothingPublished(f"nothing published under {source}")
    parts = spark.createDataFrame([(p.folder, p.snapshot) for p in pointer.parts], "part string, snapshot string")
    found = find_changes(fingerprint.content_fingerprint(parts, ["part"], config_hash), root, "part")
    if found.to_build or found.to_drop:
        chosen = [p for p in pointer.parts if p.folder in found.to_build]
        made = build(snapshots.read_parts(spark, source, pointer.schema, chosen)) if chosen else None
        state = [list(r) for r in found.state]
        snapshots.replace_folders(made, root, by, {*found.to_build, *found.to_drop}, state=state)
    return snapshots.read(spark, root), dict(found.status)
