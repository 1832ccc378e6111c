"""Held-out accuracy of the classifiers, and odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import compression_quality, language_id, queries, toxicity
from sievewright.llm.sampling import pick

FOLDER = "/root/testdata/sf0.1"


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def test_pick_is_bounded_and_settles_repeats(spark):
    rows = [(i, "a" if i % 3 else "b") for i in range(300)] + [(1, "b"), (1, "b"), (None, "a"), (5, None)]
    picks = pick(spark.createDataFrame(rows, "doc_id long, label string"), 50).collect()
    n = {x: sum(r.label == x for r in picks) for x in "ab"}
    assert all(25 < n[x] < 80 for x in n)
    assert len({r.doc_id for r in picks}) == len(picks) and all(0 <= r.draw < 1 and r.doc_id is not None for r in picks)
    assert pick(spark.createDataFrame(rows, "doc_id long, label string"), 500).count() == 300


def rates(found, labels, column):
    """Share of right predictions for label 1 and for label 0, held-out rows only."""
    joined = found.filter("held_out").join(labels, "doc_id").groupBy(column, "predicted").count().collect()
    n = {(r[column], r.predicted): r["count"] for r in joined}
    return [n.get((x, x), 0) / (n.get((x, x), 0) + n.get((x, 1 - x), 0)) for x in (1, 0)]


def test_quality(spark):
    found = queries.op4_quality_classifier(spark, FOLDER).cache()
    assert found.count() == table(spark, "documents").count()
    good, bad = rates(found, table(spark, "labels"), "quality")
    assert good > 0.97 and bad > 0.7


def test_toxicity(spark):
    found = queries.op7_toxicity(spark, FOLDER).cache()
    assert found.count() == table(spark, "documents").count()
    toxic, clean = rates(found, table(spark, "labels"), "toxic")
    assert toxic > 0.8 and clean > 0.97


def test_language(spark):
    found = queries.op5_language_id(spark, FOLDER).join(table(spark, "documents").select("doc_id", "lang"), "doc_id").cache()
    held = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert found.count() == table(spark, "documents").count() and held > 0.99


def odd(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "some words"), (4, "long text here " * 30_000), (5, "same"), (5, "same"), (6, "123 456 !!"), (7, "é日本")]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"label": F.lit(3), "score": F.lit("x"), "draw": F.lit(1), "features": F.lit(0)})


def learnable(spark):
    rng = random.Random(8)
    rows = []
    for i in range(160):
        bad = i % 2
        words = [rng.choice(["Xq$$", "zz!!", "kk##", "WWW"] if bad else ["the", "house", "was", "green", "and", "old"]) for _ in range(120)]
        if bad:
            words[rng.randrange(100)] = "zorgon"
        rows.append((1000 + i, " ".join(words), bad))
    return spark.createDataFrame(rows, "doc_id long, text string, bad int")


@pytest.mark.parametrize("operator, label", [(compression_quality, "1 - bad"), (toxicity, "bad")])
def test_scores_of_odd_rows(spark, operator, label):
    docs = learnable(spark)
    labelled = docs.select("doc_id", F.expr(label).alias("label"))
    extra = spark.createDataFrame([(None, 1), (1000, None), (1001, 7), (999_999, 1)], "doc_id long, label int")
    model = operator.train(docs.select("doc_id", "text"), labelled.union(extra).union(labelled.limit(3)))
    found = operator.score(odd(spark), model).collect()
    assert len(found) == 9 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id == 5}) == 1
    own = operator.score(docs, model).join(labelled, "doc_id").groupBy("label").agg(F.avg("score").alias("s")).collect()
    means = {r.label: r.s for r in own}
    assert means[1] > 0.8 and means[0] < 0.2
    assert operator.score(odd(spark).limit(0), model).count() == 0
    for few in (labelled.limit(0), labelled.filter("label = 1"), labelled.limit(3)):
        scores = [r.score for r in operator.score(odd(spark), operator.train(docs.select("doc_id", "text"), few)).collect()]
        assert len(scores) == 9 and all(0 <= s <= 1 for s in scores)


def test_whole_texts_decide(spark):
    """A text whose end differs is scored differently, however long it is."""
    long = "the house was green and old " * 20_000
    model = compression_quality.train(learnable(spark).select("doc_id", "text"), learnable(spark).select("doc_id", (1 - F.col("bad")).alias("label")))
    texts = spark.createDataFrame([(1, long), (2, long + "Xq$$ zz!! kk## WWW " * 40_000)], "doc_id long, text string")
    scores = {r.doc_id: r.difference for r in compression_quality.score(texts, model).collect()}
    assert scores[2] < scores[1]
    assert toxicity.features((long + "idiot").encode(), {})[4] > 0


def test_language_of_odd_rows(spark):
    rng = random.Random(2)
    made = [(i, " ".join(rng.choices(words, k=40)), lang) for i, (lang, words) in enumerate([("aa", ["baba", "dada"]), ("bb", ["xexe", "zeze"])] * 60)]
    learn = spark.createDataFrame([*made, (None, "baba", "aa"), (900, "baba", None), (901, None, "cc")], "doc_id long, text string, lang string")
    model = language_id.train(learn)
    found = [(r.doc_id, r.lang_pred, r.score) for r in language_id.predict(odd(spark), model).collect()]
    assert sorted(x[0] for x in found if x[1] == "und" and x[2] == 0) == [1, 2, 3, 6]
    assert all(x[1] in model.languages and 0 < x[2] <= 1 for x in found if x[0] not in (1, 2, 3, 6))
    assert [(r.lang_pred) for r in language_id.predict(learn.filter("lang = 'bb'"), model).collect()] == ["bb"] * 60
    nothing = language_id.train(learn.limit(0))
    assert {r.lang_pred for r in language_id.predict(odd(spark), nothing).collect()} == {"und"}
    assert language_id.predict(odd(spark).limit(0), model).count() == 0


def test_ngrams_count_what_slices_do():
    text = "Ab, c!  dé" * 9
    found, counts = language_id.ngrams(text.encode(), 16)
    plain = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    while "  " in plain:
        plain = plain.replace("  ", " ")
    grams = [plain[i : i + n] for n in (1, 2, 3) for i in range(len(plain) - n + 1)]
    assert counts.sum() == len(grams) and len(found) <= len(set(grams))
    parts = language_id._PART
    try:
        language_id._PART = 7
        again = language_id.ngrams(text.encode(), 16)
    finally:
        language_id._PART = parts
    assert np.array_equal(found, again[0]) and np.array_equal(counts, again[1])


def test_temperature_finds_the_best_scale():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3)) * 2
    chances = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
    labels = np.array([rng.choice(3, p=p) for p in chances])
    assert language_id._temperature(logits * 5, labels) == pytest.approx(5, rel=0.15)


def test_obfuscated_words_and_persons_are_seen():
    names = dict(zip(toxicity.FEATURES, toxicity.features("You are an 1d1ot! such a LOSER".encode(), {}), strict=True))
    assert names["seed_density"] == pytest.approx(2 / 7) and names["obfuscated_hits"] == pytest.approx(1 / 7)
    assert names["near_second_person"] == pytest.approx(1 / 7) and names["capital_words"] == pytest.approx(1 / 7)
    assert toxicity.features(None, {}) == [0.0] * len(toxicity.FEATURES)
