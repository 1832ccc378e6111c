"""Physical plans: what the operators must not do at scale."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sievewright.operators import master, split, target
from sievewright.queries import catalog, masters, modelling
from sievewright.queries.registry import table
from sievewright.specs import BridgeJoin, DimensionJoin, SnapshotJoin

FOLDER = os.environ.get("SIEVEWRIGHT_TABLES", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the driver tables")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main_part(df) -> str:
    """The plan without its scalar subqueries."""
    return physical(df).split("Subquery subquery")[0]


@needs_tables
@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_no_query_pairs_all_rows(spark, name):
    plan = physical(catalog.QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "FileScan parquet" in plan


def test_every_query_is_accounted_for():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_tables
def test_rows_are_labelled_in_place(spark):
    orders = table(spark, FOLDER, "orders")
    labelled = split.group_split(orders, modelling.BY_CUSTOMER)
    assert "Exchange" not in main_part(labelled)


@needs_tables
def test_salary_table_is_narrow(spark):
    built = target.build_salary_table(modelling.postings(spark, FOLDER), modelling.CONFIG)
    assert "Exchange" not in physical(built.result)


@needs_tables
def test_bridge_lists_are_cut_before_they_are_collected(spark):
    tables = {"part": table(spark, FOLDER, "part")}
    lines = masters._lines_of_orders(spark, FOLDER)
    plan = physical(master.bridge_rows(lines, masters.PART_NAMES, tables))
    assert plan.count("WindowGroupLimit") >= 2
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan
    # pairs are counted in the scanning tasks, before the lookup and any shuffle
    assert "partial_count(1)" in plan


@needs_tables
def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(catalog.QUERIES["join_keep_matching"](spark, FOLDER))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)" in plan
    assert "o_totalprice" not in plan


def test_hot_and_null_keys_are_dealt_to_many_tasks(spark):
    """Nine rows in ten on one key or on none: three joins on that key, one shuffle of the fact, even partitions."""
    key = F.when(F.col("id") % 10 < 6, 7).when(F.col("id") % 10 < 9, None).otherwise(F.col("id") % 500)
    fact = spark.range(20_000).select("id", key.cast("long").alias("k"), F.concat(F.lit("text "), "id").alias("text"))
    ids = spark.range(500).withColumnRenamed("id", "k")
    tables = {
        "names": ids.withColumn("name", F.concat(F.lit("n"), "k")),
        "sizes": ids.select(F.col("k").alias("s_k"), F.lit(1).alias("at"), (F.col("k") * 2).alias("size")),
        "tags": ids.select("k", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("tag")),
    }
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = master.build_master(
            fact,
            tables,
            [DimensionJoin("names", "k", "k")],
            [SnapshotJoin("sizes", "k", "s_k", latest_by="at")],
            [BridgeJoin("tags", "k", "tag", "tag")],
        ).result
        plan = physical(joined)
        assert sum("_sw_salt" in line and "hashpartitioning(k#" in line for line in plan.splitlines()) == 1
        sizes = [r["n"] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 20_000 and max(sizes) < 3 * 20_000 / 16
        hot = joined.filter("k = 7").select("name", "size", "tag_count", "top_tag").distinct().collect()
        assert [tuple(r) for r in hot] == [("n7", 14, 2, "a")]
        assert joined.filter("k is null and (name is not null or tag_count <> 0)").isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def scans(df) -> int:
    """Table scans of the plan that ran."""
    df.collect()
    return physical(df).split("== Initial Plan ==")[0].count("FileScan parquet")


@needs_tables
def test_heavy_keys_are_found_once_per_key(spark):
    """Three tables on two keys of a fact: one scan of the fact, and no scan per table to find its heavy keys."""
    assert scans(catalog.QUERIES["master_full"](spark, FOLDER)) <= 10


@needs_tables
def test_validation_scans_each_table_twice_at_most(spark):
    """Four tables: row rules in one pass, all unique keys and references in another."""
    plan = catalog.QUERIES["validate_summary"](spark, FOLDER)
    assert scans(plan) <= 8
    assert physical(plan).split("== Initial Plan ==")[0].count("Join") == 0
