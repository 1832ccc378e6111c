"""Mechanisms for large inputs against the plain ways: top terms by bounds, version masks, Gram matrices, halo blocks."""

from __future__ import annotations

import math
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from sievewright.operators import profile, quantiles, series, stats, textops

from conftest import rows


# ------------------------------------------------------------------- top terms


@pytest.mark.parametrize("buckets", [1, 7, 1 << 12])
@pytest.mark.parametrize("first", [1, 16])
def test_top_terms_whatever_meets_in_a_bucket(spark, buckets, first):
    rng = random.Random(buckets)
    # many terms of equal counts around the cut, and a long tail that fills every bucket
    words = [f"t{i}" for i in range(40) for _ in range(30 - i // 2)] + [f"tail{rng.randrange(900)}" for _ in range(3000)]
    words += [None] * 50
    rng.shuffle(words)
    df = spark.createDataFrame([(w,) for w in words], "term string").repartition(3)
    expected = sorted(((w, n) for w, n in Counter(w for w in words if w).items()), key=lambda x: (-x[1], x[0]))
    for n in (1, 8, 15, 5000):
        found = textops.top_by_bounds(df, "term", n, buckets, first)
        assert [tuple(r) for r in found.collect()] == expected[:n]
    assert textops.top_by_bounds(df.limit(0), "term", 3).collect() == []


def test_few_terms_are_shuffled(spark):
    df = spark.range(60_000).select(F.concat(F.lit("t"), F.when(F.col("id") % 2 == 0, F.col("id") % 30).otherwise(F.col("id"))).alias("term"))
    bounds = textops.top_by_bounds(df, "term", 10, buckets=256, first=2)
    assert [r["rows"] for r in bounds.collect()] == [2000] * 10
    bucket = F.pmod(F.xxhash64("term"), F.lit(256))
    full = {r[0] for r in df.groupBy(bucket).agg(F.count("*").alias("n")).filter("n >= 2000").collect()}
    assert len(full) < 32  # of 256: the terms of all others stay where they are


# -------------------------------------------------------------- sets of versions


@pytest.mark.parametrize("versions", [1, 5, 130])
def test_overlaps_of_any_number_of_versions(spark, versions):
    rng = random.Random(versions)
    held = {f"v{i:03}": {rng.randrange(40) for _ in range(rng.randint(1, 25))} for i in range(versions)}
    data = [(v, k) for v, keys in held.items() for k in keys for _ in range(rng.randint(1, 2))] + [("v000", None), (None, 3)]
    df = spark.createDataFrame(data, "v string, k int").repartition(3)
    masks, names = profile.version_masks(df, ["k"], "v")
    assert names == sorted(held)
    sets = profile.versions_of_masks(profile.mask_histogram(masks), names)
    expected = Counter(tuple(v for v in names if k in held[v]) for k in set().union(*held.values()))
    assert {tuple(r["versions"]): r["keys"] for r in sets.collect()} == expected
    found = {(r.version_a, r.version_b): tuple(r)[2:] for r in profile.overlap_matrix(df, ["k"], "v").collect()}
    pairs = {}
    for a, b in combinations(names, 2):
        if n := len(held[a] & held[b]):
            pairs[a, b] = (len(held[a]), len(held[b]), n, pytest.approx(100 * n / len(held[a])))
            pairs[b, a] = (len(held[b]), len(held[a]), n, pytest.approx(100 * n / len(held[b])))
    assert found == pairs
    assert profile.overlap_matrix(df.limit(0), ["k"], "v").collect() == []


def test_two_versions_agree_with_the_plain_overlap(spark):
    a, b = spark.range(0, 60).withColumnRenamed("id", "k"), spark.range(40, 130).withColumnRenamed("id", "k")
    both = a.withColumn("v", F.lit("a")).unionByName(b.withColumn("v", F.lit("b")))
    plain = profile.key_overlap(a, b, ["k"]).first()
    row = profile.overlap_matrix(both, ["k"], "v").filter("version_a = 'a'").first()
    assert (row.keys_a, row.keys_b, row.common, row.a_in_b_percent) == (plain.keys_a, plain.keys_b, plain.common, plain.a_in_b_percent)


# ------------------------------------------------------------------ correlations


def test_sixty_four_columns_by_matrix_products(spark):
    made = {f"c{i}": (F.rand(i) * (i + 1) + F.col("id") / (97 + i) + (1e6 if i % 7 == 0 else 0)) for i in range(64)}
    df = spark.range(0, 900, 1, 3).select(*[F.when(F.rand(1000 + i) > 0.1 * (i % 4), c).alias(n) for i, (n, c) in enumerate(made.items())])
    df = spark.createDataFrame(df.collect(), df.schema).repartition(4)
    expected = {(r.a, r.b): r.r for r in stats.correlation_matrix(df, df.columns).collect()}
    found = {(r.a, r.b): r.r for r in stats.gram_correlations(df, df.columns).collect()}
    assert set(found) == set(expected) and len(found) == 2016
    assert max(abs(found[k] - expected[k]) for k in found) < 1e-9


def test_odd_columns(spark):
    data = [(1.0, 5, None, math.nan), (2.0, 5, 1.0, 3.0), (4.0, 5, None, 1.0), (None, 5, 2.0, 2.0)]
    df = spark.createDataFrame(data, "a double, b int, `c d` double, e double")
    found = {(r.a, r.b): r.r for r in stats.gram_correlations(df, df.columns).collect()}
    assert found["a", "b"] is None and found["a", "c d"] is None
    assert found["a", "e"] == pytest.approx(-1.0)
    assert all(r.r is None for r in stats.gram_correlations(df.limit(0), ["a", "e"]).collect())


# ------------------------------------------------------------------- long series


@pytest.fixture(scope="module")
def events(spark):
    rng = random.Random(3)
    data = [(1_700_000_000 + rng.randrange(40 * 86_400),) for _ in range(400)] + [(None,)]
    return spark.createDataFrame(data, "s long").select(F.timestamp_seconds("s").alias("ts"))


@pytest.fixture(scope="module")
def days(events):
    """The same days by both ways."""
    daily, steps = series.counts_per_period(events, "ts"), series.counts_per_step(events, "ts", 86_400)
    assert rows(daily) == rows(steps.select(F.to_date("at").alias("date"), "rows"))
    return daily, steps


def matches(found, expected, names):
    left = found.orderBy("place").select(*names).collect()
    right = expected.orderBy("date").select(*names).collect()
    assert len(left) == len(right) > 30
    for a, b in zip(left, right, strict=True):
        assert all((x is None and y is None) or x == pytest.approx(y, abs=1e-12) for x, y in zip(a, b, strict=True))


@pytest.mark.parametrize("block", [1, 2, 5, 64])
def test_blocks_with_halo_equal_one_window(days, block):
    daily, steps = days
    matches(series.rolling_mean_of_steps(steps, 7, block), series.rolling_mean(daily, 7), ["rows", "rolling_mean"])
    matches(series.decompose_steps(steps, 7, block), series.decompose(daily, 7), ["rows", "trend", "seasonal", "residual"])
    found = {r.lag: r.acf for r in series.autocorrelation_of_steps(steps, 9, block).collect()}
    expected = {r.lag: r.acf for r in series.autocorrelation(daily, 9).collect()}
    assert set(found) == set(expected) == set(range(10))
    assert all(found[k] == pytest.approx(expected[k]) for k in found)


def test_no_window_is_one_task(days):
    _, steps = days
    for made in (series.rolling_mean_of_steps(steps, 7), series.decompose_steps(steps, 7), series.autocorrelation_of_steps(steps, 9)):
        plan = made._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
        windows = [line for line in plan.splitlines() if "Window " in line]
        assert windows and all("_sw_block" in line for line in windows)


def test_series_without_times(events):
    none = events.filter("ts is null")
    assert series.counts_per_step(none, "ts").collect() == []
    assert series.rolling_mean_of_steps(series.counts_per_step(none, "ts"), 3).collect() == []


# ------------------------------------------------------------------ heavy groups


def test_only_heavy_groups_are_dealt_out(spark):
    """One group with half of the values among many small ones: exact, and small groups have one copy of their bounds."""
    g = F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 4000)
    df = spark.range(12_000).select(g.alias("g"), F.hash("id").cast("double").alias("x"))
    counts = quantiles.value_counts(df, ["g"], "x")
    assert [r.g for r in quantiles._heavy_groups(counts, ["g"]).collect()] == [0]
    found = {r.g: r.m for r in quantiles.group_statistics(df, ["g"], "x", {"m": 0.5}).collect()}
    assert found == {r.g: r.m for r in df.groupBy("g").agg(F.percentile("x", F.lit(0.5)).alias("m")).collect()}
