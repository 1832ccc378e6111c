"""Profiles, statistics, series and text against pandas and plain Python."""

from __future__ import annotations

import collections
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievewright import defaults
from sievewright.operators import profile, series, stats, textops


def test_profile_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, "a")], "x double, s string")
    rows = {r["column"]: r for r in profile.column_profile(df.withColumn("x", F.nanvl("x", F.lit(None)))).collect()}
    assert (rows["x"]["nulls"], rows["x"]["distinct_values"]) == (2, 1)
    assert {r["column"]: r["nulls"] for r in profile.missing_summary(df).collect()} == {"x": 2, "s": 1}
    approx = {r["column"]: r["distinct_values"] for r in profile.column_profile(df.select("s"), exact=False).collect()}
    assert approx == {"s": 1}


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a long, b long")
    assert tuple(profile.duplicate_rows(df).first())[:2] == (3, 1)
    assert tuple(profile.duplicate_rows(df.filter("false")).first())[:2] == (0, 0)


def test_value_counts_keep_null(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert {r["v"]: r["rows"] for r in profile.value_counts(df, "v").collect()} == {"a": 2, None: 1}


def test_anova_matches_definition(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 5, 300).astype(str), "v": rng.normal(size=300)})
    pdf.loc[len(pdf)] = ["single", 100.0]
    groups = [x["v"].values for _, x in pdf.groupby("g") if len(x) > 1]
    everything = np.concatenate(groups)
    ssb = sum(len(x) * (x.mean() - everything.mean()) ** 2 for x in groups)
    ssw = sum(((x - x.mean()) ** 2).sum() for x in groups)
    want = (ssb / (len(groups) - 1)) / (ssw / (len(everything) - len(groups)))
    df = spark.createDataFrame([(g, float(v)) for g, v in zip(pdf.g, pdf.v)], "g string, v double")
    row = stats.anova(df, "g", "v").first()
    assert row["f_statistic"] == pytest.approx(want) and row["groups"] == 5


def test_histogram_edges(spark):
    values = [0.0, 1.0, 2.5, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
    got = [r["rows"] for r in stats.histogram(df, "v", 4).orderBy("bin").collect()]
    assert got == list(np.histogram(values, 4)[0])
    same = stats.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 2)
    assert [r["rows"] for r in same.orderBy("bin").collect()] == [2, 0]


def test_ranked_medians_share_ties(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", 5.0)], "g string, v double")
    assert {r["g"]: r["rank"] for r in stats.ranked_medians(df, "g", "v").collect()} == {"a": 1, "b": 2.5, "c": 2.5, "d": 4}


def test_correlation_leaves_out_gaps(spark):
    data = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 9.0), (4.0, 1.0)]
    df = spark.createDataFrame(data, "x double, y double")
    want = pd.DataFrame(data, columns=["x", "y"]).corr().loc["x", "y"]
    assert stats.correlation_matrix(df, ["x", "y"]).first()["r"] == pytest.approx(want)


def daily(spark, days):
    data = [(d,) for d, n in days.items() for _ in range(n)]
    return spark.createDataFrame(data, "t string").withColumn("t", F.to_timestamp("t"))


def test_weeks_end_on_sunday_and_months_on_their_last_day(spark):
    df = daily(spark, {"2024-01-01 05:00:00": 2, "2024-01-07 23:00:00": 1, "2024-01-22 00:00:00": 1, "2024-03-03 00:00:00": 1})
    weeks = [(str(r[0]), r[1]) for r in series.counts_per_period(df, "t", "week").orderBy("date").limit(4).collect()]
    assert weeks == [("2024-01-07", 3), ("2024-01-14", 0), ("2024-01-21", 0), ("2024-01-28", 1)]
    months = [(str(r[0]), r[1]) for r in series.counts_per_period(df, "t", "month").orderBy("date").collect()]
    assert months == [("2024-01-31", 4), ("2024-02-29", 0), ("2024-03-31", 1)]


def test_decomposition_adds_up(spark):
    counts = [3, 5, 8, 2, 1, 7, 9] * 3 + [4, 4]
    df = spark.createDataFrame([(f"2024-01-{i + 1:02d}", n) for i, n in enumerate(counts)], "date string, rows long")
    rows = series.decompose(df).orderBy("date").collect()
    assert [r["trend"] is None for r in rows] == [i < 3 or i > len(counts) - 4 for i in range(len(counts))]
    assert sum(r["seasonal"] for r in rows[:7]) == pytest.approx(0)
    inner = [r for r in rows if r["trend"] is not None]
    assert all(r["trend"] + r["seasonal"] + r["residual"] == pytest.approx(r["rows"]) for r in inner)
    with pytest.raises(ValueError, match="odd"):
        series.decompose(df, 6)


def test_autocorrelation_matches_definition(spark):
    counts = np.array([3, 5, 8, 2, 1, 7, 9, 4, 4, 6], dtype=float)
    df = spark.createDataFrame([(f"2024-01-{i + 1:02d}", int(n)) for i, n in enumerate(counts)], "date string, rows long")
    x = counts - counts.mean()
    want = [float((x[k:] * x[: len(x) - k]).sum() / (x * x).sum()) for k in range(4)]
    got = [r["acf"] for r in series.autocorrelation(df, 3).orderBy("lag").collect()]
    assert got == pytest.approx(want)


def test_growth_of_nothing_is_null(spark):
    df = spark.createDataFrame([("2024-01-01", "a"), ("2024-01-09", "b"), ("2024-01-09", "a")], "t string, c string")
    rows = {r["c"]: r["growth_percent"] for r in series.growth(df.withColumn("t", F.to_timestamp("t")), "t", "c", 5).collect()}
    assert rows == {"a": 0.0, "b": None}


TITLES = ["Senior Data Engineer", "VP of Sales & the Team", "Jr. engineer, data engineer", "intern", "Éngineer lead", None, "international"]


def titles(spark):
    return spark.createDataFrame([(t, float(i)) for i, t in enumerate(TITLES)], "title string, v double")


def test_tokens(spark):
    tokens = [[w for w in re.findall("[a-z]+", t.lower()) if w not in defaults.TITLE_STOP_WORDS] for t in TITLES if t]
    unigrams = collections.Counter(w for t in tokens for w in t)
    bigrams = collections.Counter(" ".join(p) for t in tokens for p in zip(t, t[1:]))
    for function, want in ((textops.top_unigrams, unigrams), (textops.top_bigrams, bigrams)):
        got = [tuple(r) for r in function(titles(spark), "title", defaults.TITLE_STOP_WORDS, 5).collect()]
        assert got == sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:5]


def test_keywords_are_whole_words(spark):
    rows = {r["keyword"]: r for r in textops.keyword_statistics(titles(spark), "title", "v", defaults.SENIORITY_KEYWORDS).collect()}
    for keyword in defaults.SENIORITY_KEYWORDS:
        hits = [float(i) for i, t in enumerate(TITLES) if t and re.search(rf"\b{keyword}\b", t.lower())]
        assert rows[keyword]["occurrences"] == len(hits), keyword
        assert rows[keyword]["median"] == (np.median(hits) if hits else None)


def test_snippet_window(spark):
    text = "x" * 100 + "Salary" + "y" * 200
    df = spark.createDataFrame([(1, text), (2, "$5"), (3, "none")], "k long, t string")
    rows = {r["k"]: r["snippet"] for r in textops.snippets(df, ["k"], "t", defaults.SALARY_SNIPPET_TERMS).collect()}
    assert rows == {1: text[40:180], 2: "$5"}


def test_patterns(spark):
    df = spark.createDataFrame([("Pay: $5", 1), ("payment", 0), (None, 1), ("SALARY", 0)], "t string, s int")
    row = textops.pattern_rates(df, "t", defaults.SALARY_PATTERNS, F.col("s") == 1).first()
    assert tuple(row) == (4, 2, 50.0, 50.0)


def test_tiers_and_lists(spark):
    df = spark.createDataFrame([("a|b",), ("a",), (None,), (" a | ",)], "l string")
    counts = {r["element"]: r["rows"] for r in textops.element_counts(df, "l").collect()}
    assert counts == {"a": 3, "b": 1}
    exploded = textops.explode_list(df, "l")
    assert tuple(textops.frequency_tiers(exploded, "element", (2,)).first()) == (2, 1, 1)
