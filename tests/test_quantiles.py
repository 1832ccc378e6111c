"""Exact quantiles and ranks: the range path against numpy and pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sievewright.operators import quantiles, split, stats
from sievewright.specs import SplitConfig

PROBS = {"p0": 0.0, "p1": 0.01, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    groups = np.where(rng.random(6000) < 0.4, "hot", rng.integers(0, 40, 6000).astype(str))
    values = np.where(rng.random(6000) < 0.3, 5.0, rng.lognormal(3, 2, 6000).round(2))
    pdf = pd.DataFrame({"g": groups, "v": values})
    pdf.loc[pdf.index % 17 == 0, "v"] = None
    pdf.loc[pdf.index % 23 == 0, "g"] = None
    data = [(g, None if pd.isna(v) else float(v)) for g, v in zip(pdf.g, pdf.v)]
    return pdf, spark.createDataFrame(data, "g string, v double")


@pytest.mark.parametrize("ranges", [4, 128])
def test_group_quantiles(skewed, ranges):
    pdf, df = skewed
    got = quantiles.group_statistics(df, ["g"], "v", PROBS, ranges=ranges).toPandas().set_index("g")
    want = pdf.groupby("g")["v"].quantile(list(PROBS.values())).unstack()
    assert set(got.index) == set(want.index)
    for name, p in PROBS.items():
        np.testing.assert_allclose(got[name], want[p].reindex(got.index), rtol=1e-12)


def test_overall_quantiles(skewed):
    pdf, df = skewed
    row = quantiles.group_statistics(df, [], "v", PROBS).first()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(pdf["v"].quantile(p), rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=30))
def test_any_values(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = quantiles.group_statistics(df, [], "v", PROBS, ranges=16).first()
    for name, p in PROBS.items():
        assert row[name] == pytest.approx(np.quantile(values, p))


def test_group_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "g string, v double")
    from pyspark.sql import functions as F

    got = quantiles.group_statistics(df, ["g"], "v", {"m": 0.5}, [F.count("*").alias("n")])
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, 1.0), ("b", 1, None)]


def test_cumulative_counts(skewed):
    pdf, df = skewed
    got = quantiles.cumulative_counts(df, ["g"], "v").toPandas()
    present = pdf.dropna()
    want = present.groupby(["g", "v"]).size().rename("rows").reset_index().sort_values(["g", "v"])
    want["below"] = want.groupby("g")["rows"].cumsum() - want["rows"]
    merged = got.merge(want, on=["g", "v"], suffixes=("", "_w"))
    assert len(merged) == len(want) == len(got)
    assert (merged["rows"] == merged["rows_w"]).all() and (merged["below"] == merged["below_w"]).all()
    assert (merged["total"] == merged["g"].map(present.groupby("g").size())).all()


def test_ranks_and_spearman(spark, skewed):
    pdf, df = skewed
    got = quantiles.average_ranks(df, "v", "r").toPandas().set_index("v")["r"]
    want = pd.Series(pdf["v"].dropna().rank().values, index=pdf["v"].dropna().values)
    assert (got == want[~want.index.duplicated()].reindex(got.index)).all()
    two = pdf.dropna().assign(w=lambda x: (x["v"] * 7) % 11)
    sdf = spark.createDataFrame([(float(a), float(b)) for a, b in zip(two.v, two.w)], "v double, w double")
    want = np.corrcoef(two["v"].rank(), two["w"].rank())[0, 1]
    assert stats.spearman(sdf, "v", "w").first()["r"] == pytest.approx(want, abs=1e-9)


def test_medians_of_columns(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (4, 8.0)], "a long, b double")
    assert sorted(tuple(r) for r in quantiles.medians(df, ["a", "b"]).collect()) == [("a", 2.0), ("b", 5.0)]


# ------------------------------------------------------------------ group split


def test_split_counts_follow_the_groups(spark):
    import hashlib
    import math

    df = spark.range(5000).selectExpr("case when id % 3 = 0 then 'hot' else concat('g', id % 457) end as g", "1.0D as y")
    config = SplitConfig(group="g", targets=("y", "y"))
    out = split.group_split(df, config)
    labels = {r["g"]: r["split"] for r in out.select("g", "split").distinct().collect()}
    groups = sorted(labels, key=lambda g: hashlib.sha256(f"42|{g}".encode()).hexdigest())
    test = math.ceil(round(0.2 * len(groups), 9))
    validation = math.ceil(round(0.125 * (len(groups) - test), 9))
    want = ["test"] * test + ["validation"] * validation + ["train"] * (len(groups) - test - validation)
    assert [labels[g] for g in groups] == want
    assert out.count() == 5000
    assert set(split.group_overlap(out, config).first()) == {0}


def test_split_is_seeded(spark):
    df = spark.range(200).selectExpr("id as g", "1.0D as y")
    sets = [
        {r["g"] for r in split.group_split(df, SplitConfig(group="g", seed=s)).filter("split = 'test'").collect()}
        for s in (1, 1, 2)
    ]
    assert sets[0] == sets[1] != sets[2]


def test_split_checks(spark):
    df = spark.range(100).selectExpr("id as g", "id as row", "double(id + 1) as y")
    config = SplitConfig(group="g", targets=("y", "y"))
    split.validate_input(df, config)
    out = split.group_split(df, config)
    split.check_split(df, out, config)
    with pytest.raises(split.SplitInvalid, match="rows went in"):
        split.check_split(df, out.unionByName(out), config)
    shared = out.unionByName(out.filter("split = 'test'").limit(1).selectExpr("g", "row", "y", "'train' as split"))
    with pytest.raises(split.SplitInvalid, match="shared"):
        split.check_split(shared.select("g"), shared, config)
    with pytest.raises(split.SplitInvalid, match="empty"):
        split.check_split(df, out.filter("split <> 'validation'"), config)
    assert split.row_overlap(shared, "row").first()["shared_rows"] == 1
    with pytest.raises(split.SplitInvalid, match="too_few_groups"):
        split.validate_input(df.limit(5), config)
    with pytest.raises(split.SplitInvalid, match="missing"):
        split.validate_input(df.drop("y"), config)
    with pytest.warns(UserWarning, match="share"):
        hot = spark.range(1000).selectExpr("case when id < 900 then 0 else id end as g", "1.0D as y")
        uneven = SplitConfig(group="g", targets=("y", "y"))
        split.check_split(hot, split.group_split(hot, uneven), uneven)


@pytest.mark.parametrize("shares", [(0.7, 0.2, 0.2), (0.0, 0.5, 0.5), (1.2, -0.1, -0.1)])
def test_split_shares(shares):
    with pytest.raises(ValueError):
        SplitConfig(train=shares[0], validation=shares[1], test=shares[2])


def test_parts_must_share_a_schema(spark):
    a = spark.createDataFrame([(1,)], "x long")
    split.same_schema({"train": a, "test": a})
    with pytest.raises(split.SplitInvalid, match="test"):
        split.same_schema({"train": a, "test": a.withColumnRenamed("x", "y")})
