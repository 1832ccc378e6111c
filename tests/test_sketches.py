"""Stored sketches against exact counts and ranks."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from sievewright.operators import sketches


@pytest.fixture(scope="module")
def data(spark):
    n = F.col("id")
    df = spark.range(200_000).select(
        F.concat(F.lit("v"), n % 4).alias("v"),
        F.when(n % 10 != 0, (n / 4).cast("long") % 45_000).alias("k"),
        F.concat(F.lit("t"), (n / 4).cast("int")).alias("t"),
        F.when(n % 7 != 0, F.sqrt(n.cast("double"))).otherwise(F.lit(math.nan)).alias("x"),
    )
    return spark.createDataFrame(df.toArrow())


def test_distinct_values_of_versions_unions_and_intersections(spark, data, tmp_path):
    sketches.distinct_sketches(data, ["k", "t"], ["v"]).write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 8 and stored.agg(F.max(F.length("sketch"))).first()[0] < 600_000
    for by in (["column"], ["v", "column"]):
        exact = {}
        for c in ("k", "t"):
            for r in data.groupBy(*[b for b in by if b == "v"]).agg(F.count_distinct(c).alias("n")).collect():
                exact[(r["v"], c) if "v" in by else (c,)] = r["n"]
        found = {tuple(r[b] for b in by): r["estimate"] for r in sketches.distinct_estimates(stored, by).collect()}
        assert set(found) == set(exact) and all(abs(found[k] - exact[k]) <= 0.03 * exact[k] for k in exact)
    common = {r["column"]: r["estimate"] for r in sketches.common_estimates(stored, ["column"]).collect()}
    shared = data.groupBy("t").agg(F.count_distinct("v").alias("n")).filter("n = 4").count()
    assert abs(common["t"] - shared) <= 0.03 * 50_000


def test_equal_values_are_equal_whatever_their_zero(spark):
    df = spark.createDataFrame([(0.0,), (-0.0,), (1.0,), (None,)], "x double")
    made = sketches.distinct_sketches(df, ["x"])
    assert sketches.distinct_estimates(made, ["column"]).first()["estimate"] == 2
    assert made.first()["values"] == 3


def test_merged_quantiles_keep_their_rank(data):
    probs = {f"p{i}": i / 20 for i in range(21)}
    made = sketches.value_sketches(data, "x", ["v"])
    present = data.filter(~F.isnan("x"))
    for by in ([], ["v"]):
        for r in sketches.merged_quantiles(made, by, probs).collect():
            rows = present.filter(F.col("v") == r["v"]) if by else present
            n = rows.count()
            assert r["values"] == n
            ranks = rows.agg(*[F.count_if(F.col("x") <= r[p]).alias(p) for p in probs]).first()
            assert all(abs(ranks[p] / n - share) <= 0.01 for p, share in probs.items())


def test_no_rows(spark, data):
    assert sketches.merged_quantiles(sketches.value_sketches(data.limit(0), "x", ["v"]), ["v"], {"m": 0.5}).collect() == []
    assert sketches.distinct_estimates(sketches.distinct_sketches(data.limit(0), ["k"]), ["column"]).first()["estimate"] == 0
