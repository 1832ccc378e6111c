"""The pipeline against plain Python, stage by stage, on the driver's smallest tables."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_simhash import linked, plain_fingerprint
from test_text_filters import covered, deduped, filled, words_of

from sievewright.llm import decontamination, mixing, simhash

FOLDER = "/root/testdata/sf0.01"


def kept_by_rules(text):
    words = words_of(text or "")
    chars = sum(map(len, words))
    if len(words) < 50 or 2 * len(covered(words, 3)) > len(words):
        return False
    seen, lines = set(), 0
    for line in (text or "").split("\n"):
        if line in seen:
            lines += sum(map(len, words_of(line)))
        elif words_of(line):
            seen.add(line)
    inside = {n: sum(len(words[i]) for i in covered(words, n)) for n in (5, 7, 10)}
    within = all(100 * inside[n] <= most * chars for n, most in ((5, 15), (7, 13), (10, 10)))
    return within and 100 * lines <= 20 * chars


def leaked(text, items):
    words = decontamination.words_of(text.encode())
    for item in items:
        n, own = len(item), set(item)
        for i in range(0, len(words), max(n // 2, 1)):
            window = words[i : i + 2 * n]
            if sum(w in own for w in window) >= 0.8 * n:
                numbers = {w: k for k, w in enumerate(dict.fromkeys([*item, *window]))}
                if decontamination.common_length([numbers[w] for w in item], [numbers[w] for w in window]) >= 0.8 * n:
                    return True
    return False


@pytest.fixture(scope="module")
def stages(spark):
    """The documents and what each stage made of them."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    made = [docs]
    for _, stage in corpus_pipeline.STAGES:
        made.append(stage(spark, made[-1], FOLDER).cache())
    return made


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes
    assert stages[-1].columns == [*stages[0].columns, "copy"]


def test_quality_rules_and_lines(stages):
    assert rows(stages[1]) == [x for x in rows(stages[0]) if kept_by_rules(x[1])]
    assert 0 < stages[1].count() < stages[0].count()
    assert rows(stages[2]) == sorted((i, t) for i, _, _, t in deduped(rows(stages[1])))
    assert stages[2].filter(F.length("text") != F.col("n_chars")).isEmpty()


def test_one_document_of_each_group_stays(stages):
    before = rows(stages[2])
    prints = {i: simhash._signed(plain_fingerprint(t)) for i, t in before}
    root = linked(sorted(set(prints.values())))
    first = {}
    for i, _ in before:
        first.setdefault(root[prints[i]], i)
    assert [i for i, _ in rows(stages[3])] == sorted(first.values())
    assert stages[3].count() < stages[2].count()


def test_leaking_documents_go(spark, stages):
    items = [decontamination.words_of(r.text.encode()) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert rows(stages[4]) == [x for x in rows(stages[3]) if not leaked(x[1], items)]
    assert stages[4].count() < stages[3].count()


def test_mix(stages):
    before = {r.doc_id: r for r in stages[4].collect()}
    sizes = {}
    for r in before.values():
        sizes[r.source] = sizes.get(r.source, 0) + len(words_of(r.text))
    target = filled(sizes)
    copies = {r.doc_id: r.n for r in stages[5].groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for i, r in before.items():
        rate = target[r.source] / sizes[r.source]
        assert copies.get(i, 0) in (int(rate), int(rate) + 1)
    assert {r.doc_id: r.copy for r in stages[5].groupBy("doc_id").agg(F.max("copy").alias("copy")).collect()} == copies


def test_run_equals_the_stages(spark, stages):
    run = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, stages[-1].collect()))


def test_odd_documents_pass_through_all_stages(spark, tmp_path):
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(9999)}" for _ in range(90))
    data = [(1, text, None, None, None), (1, text, None, None, None), (None, text + " x", "en", "a", 3), (2, None, None, "a", None), (3, "", "en", "b", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    wide = spark.createDataFrame(data, schema).withColumns({"size": F.lit("x"), "first": F.lit(1)})
    for docs, ids in ((wide, {1, None}), (wide.limit(0), set())):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        found = docs.collect()
        assert {r.doc_id for r in found} <= ids
    assert mixing.WEIGHTS == (1, 2, 3)
