"""Published tables: pointers, failures between write and publish, parts of several snapshots."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sievewright.operators import fingerprint
from sievewright.plans import incremental
from sievewright.sources import snapshots, writers


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_failed_write_leaves_the_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    with pytest.raises(snapshots.NothingPublished):
        snapshots.read(spark, root)
    writers.write_parquet(spark.range(5), root)

    def lost(*_args, **_kwargs):
        raise OSError("the driver is gone")

    with monkeypatch.context() as patched:
        patched.setattr(snapshots, "publish", lost)
        with pytest.raises(OSError, match="gone"):
            writers.write_parquet(spark.range(7), root)
    assert snapshots.read(spark, root).count() == 5
    # a failure in the middle of the data
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("bad row"))).alias("id"))
    with pytest.raises(Exception, match="bad row"):
        writers.write_parquet(broken, root)
    assert snapshots.read(spark, root).count() == 5
    assert writers.write_parquet(spark.range(9), root).count() == snapshots.read(spark, root).count() == 9


def test_a_reader_keeps_what_it_opened(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.write_parquet(spark.range(5), root)
    opened = snapshots.read(spark, root)
    writers.write_parquet(spark.range(50), root)
    assert opened.count() == 5 and snapshots.read(spark, root).count() == 50


def test_torn_pointers_are_passed_over(spark, tmp_path):
    root = tmp_path / "t"
    writers.write_parquet(spark.range(5), str(root))
    torn = root / snapshots.POINTERS / "000000000002.json"
    torn.write_text('{"schema": ')
    assert snapshots.read(spark, str(root)).count() == 5
    assert snapshots.current(spark, str(root)).number == 1
    writers.write_parquet(spark.range(6), str(root))
    assert snapshots.current(spark, str(root)).number == 3


def test_conflicts_are_told(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.write_parquet(spark.range(5), root)
    seen = snapshots.current(spark, root)
    writers.write_parquet(spark.range(6), root)
    with pytest.raises(snapshots.PublishConflict):
        snapshots.publish(spark, root, seen.schema, seen.parts, seen=seen.number)


def test_archives_have_one_name_each(spark, tmp_path):
    root = str(tmp_path / "t")
    writers.write_parquet(spark.range(5), root, "one")
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_parquet(spark.range(6), root, "one")
    assert snapshots.read(spark, root).count() == 5


def test_partitions_are_replaced_alone(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.createDataFrame([(v, i) for v in ("a b", "c/d=e", "ü", None) for i in range(3)], "v string, x long")
    assert rows_of(snapshots.write(df, root, ["v"])) == rows_of(df)
    new = spark.createDataFrame([("c/d=e", 9, "more"), ("new", 1, None)], "v string, x long, y string")
    assert rows_of(snapshots.replace(new, root, "v", ["c/d=e", "ü"])) == rows_of(new)
    expected = [(v, i, None) for v in ("a b", None) for i in range(3)] + [("c/d=e", 9, "more"), ("new", 1, None)]
    found = snapshots.read(spark, root)
    assert found.columns == ["v", "x", "y"] and rows_of(found) == sorted(expected, key=str)
    assert len({p.snapshot for p in snapshots.current(spark, root).parts}) == 2
    snapshots.replace(None, root, "v", [None, "new"])
    assert {r.v for r in snapshots.read(spark, root).collect()} == {"a b", "c/d=e"}
    snapshots.replace(None, root, "v", ["a b", "c/d=e"])
    assert snapshots.read(spark, root).count() == 0


def test_unused_snapshots_can_be_deleted(spark, tmp_path):
    root = str(tmp_path / "t")
    df = spark.range(6).select((F.col("id") % 2).alias("p"), "id")
    snapshots.write(df, root, ["p"])
    for i in range(3):
        snapshots.replace(df.filter("p = 1"), root, "p", [1])
    assert len(snapshots.drop_unused(spark, root, keep=1)) == 2
    assert rows_of(snapshots.read(spark, root)) == rows_of(df)


def test_only_changed_values_are_built(spark, tmp_path):
    root, source = str(tmp_path / "t"), spark.range(40).select((F.col("id") % 4).cast("int").alias("p"), "id")
    built = []

    def refresh(df, config=""):
        def build(values):
            built.append(list(values))
            return df.filter(F.col("p").isin(*values)).groupBy("p").agg(F.sum("id").alias("total"))

        return incremental.rebuild_changed(fingerprint.content_fingerprint(df, ["p"], config), root, "p", build)

    for df, values in (
        (source, [0, 1, 2, 3]),
        (source, None),
        (source.withColumn("id", F.when(F.expr("p = 2 and id > 30"), 0).otherwise(F.col("id"))), [2]),
        (source.filter("p <> 1"), [2]),
    ):
        built.clear()
        table, found = refresh(df)
        assert built == ([values] if values else [])
        assert rows_of(table) == rows_of(df.groupBy("p").agg(F.sum("id").alias("total")))
    assert found.status == {0: "unchanged", 1: "gone", 2: "changed", 3: "unchanged"}
    refresh(source.filter("p <> 1"), "other config")
    assert built[-1] == [0, 2, 3]


def test_a_build_reads_only_what_changed(spark, tmp_path):
    source, root, read = str(tmp_path / "s"), str(tmp_path / "t"), []
    df = spark.range(60).select(F.concat(F.lit("v"), F.col("id") % 3).alias("v"), "id")
    snapshots.write(df, source, ["v"])

    def build(changed):
        read.append(sorted(f.split("/s/")[1] for f in changed.inputFiles()))
        return changed.groupBy("v").agg(F.sum("id").alias("total"))

    def refresh():
        read.clear()
        return incremental.rebuild_from(source, spark, root, "v", build)

    assert rows_of(refresh()[0]) == rows_of(df.groupBy("v").agg(F.sum("id")))
    refresh()
    assert read == []
    new = df.filter("v = 'v1'").withColumn("id", F.col("id") + 100)
    snapshots.replace(new, source, "v", ["v0"])
    table, status = refresh()
    assert status == {"v=v0": "gone", "v=v1": "changed", "v=v2": "unchanged"}
    assert len(read) == 1 and read[0] and all("/v=v1/" in f for f in read[0])
    full = snapshots.read(spark, source).groupBy("v").agg(F.sum("id"))
    assert rows_of(table) == rows_of(full)
    snapshots.replace(None, source, "v", ["v1", "v2"])
    assert rows_of(refresh()[0]) == []
