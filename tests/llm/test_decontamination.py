"""Benchmark decontamination: matches, paraphrases, recall against brute force, odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import decontamination as d


def table_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b):
            row[j + 1], before = (before + 1 if x == y else max(row[j + 1], row[j])), row[j + 1]
    return row[-1]


def test_common_length_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randint(1, 90))]
        b = [rng.randrange(6) for _ in range(rng.randint(0, 90))]
        assert d.common_length(a, b) == table_length(a, b)


@pytest.mark.parametrize(
    "text, answer",
    [("What is it? A small cat.", "a small cat"), ("One two. Three four.", "three four"), ("Only words", "only words"), ("Is it?", "is it")],
)
def test_answer(text, answer):
    assert d.answer_of(text) == [w.encode() for w in answer.split()]


def corpus():
    rng = random.Random(4)
    common = [f"c{i}" for i in range(40)]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 70))) + ".") for i in range(60)]
    items += [(60, " ".join(f"w{rng.randrange(3000)}" for _ in range(300))), (61, "tiny item"), (62, None), (63, " ..")]
    docs, planted = [], set()
    for doc in range(300):
        words = [word() for _ in range(rng.randint(20, 400))]
        if doc % 3 == 0:
            item, text = items[rng.randrange(61)]
            part = text.split()
            if doc % 2:  # a paraphrase: some words changed, the end as it was
                for _ in range(len(part) // 6):
                    part[rng.randrange(len(part) - 1)] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = part
            planted.add((doc, item))
        docs.append((doc, " ".join(words).upper() if doc % 5 == 0 else " ".join(words)))
    return docs, items, planted


def test_planted_items_are_found_and_others_left_alone(spark):
    docs, items, planted = corpus()
    odd = [(1000, None), (1001, ""), (None, items[3][1]), (1002, items[5][1]), (1002, items[5][1])]
    table = spark.createDataFrame(docs + odd, "doc_id long, text string").withColumns({"item_id": F.lit("x"), "answered": F.lit(1)})
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = d.leaks(table, benchmark)
    pairs = sorted(((r.doc_id, r.item_id) for r in found.collect()), key=str)
    assert pairs == sorted([*planted, (None, 3), (1002, 5), (1002, 5)], key=str)
    kept = d.clean(table, benchmark)
    leaked = {x for x, _ in planted} | {1002, None}
    assert kept.schema == table.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(x for x, _ in docs + odd if x not in leaked)
    # blocks of another size find the same
    blocks = d.LeakRules(block_items=20)
    assert sorted(((r.doc_id, r.item_id) for r in d.leaks(table, benchmark, blocks).collect()), key=str) == pairs


def test_candidates_hold_what_brute_force_finds():
    """The latent search loses at most a tenth of the windows that verification would accept."""
    docs, items, _ = corpus()
    block = d.Block([x for x in items if x[1]])
    coded = [block.encode(t.encode()) for _, t in docs]
    _, term, _, passages = d._passage_terms(coded, 64, len(block.words))
    frequency = np.bincount(term, minlength=len(block.words))
    idf = np.log1p((passages - frequency + 0.5) / (frequency + 0.5))
    test = np.random.default_rng(7).standard_normal((len(idf), 72))
    sketch = d._sketch_rows(coded, d.RULES, idf, test) + 20 * d._sketch_rows([np.array(x, np.int32) for _, x, _ in block.items], d.RULES, idf, test)
    vectors = np.linalg.svd(sketch, full_matrices=False)[0][:, :64]
    searcher = d.Searcher(block, idf, vectors, d.RULES)
    found = searcher.search([t.encode() for _, t in docs])
    good = lost = 0
    for ids, own in zip(coded, found, strict=True):
        for number, (_, item, _) in enumerate(block.items):
            span = max(8, 1 << (len(item) - 1).bit_length())
            windows = [ids[i : i + 3 * span // 2].tolist() for i in range(0, len(ids), span // 2)]
            if any(searcher.verify(w, number) for w in windows):
                good += 1
                lost += number not in own
    assert good > 90 and lost <= good // 10


def test_all_documents_shape_the_latent_space(spark):
    """Documents of one passage, or of four in a row, hold the same passages: no other number of documents counts."""
    rng = random.Random(6)
    block = d.Block([(i, " ".join(f"w{rng.randrange(200)}" for _ in range(20))) for i in range(30)])
    passages = [" ".join(f"w{min(rng.randrange(400), rng.randrange(400))}" for _ in range(64)) for _ in range(9000)]
    rules = d.LeakRules(latent=8)
    shapes = []
    for run in (1, 4):
        rows = [(i, " ".join(passages[i : i + run])) for i in range(0, len(passages), run)]
        texts = spark.createDataFrame(rows, "doc_id long, text string")
        frequency, total = d._frequencies(texts, block, rules)
        assert total == len(passages)
        idf = np.log1p((total - frequency + 0.5) / (frequency + 0.5))
        vectors = d._latent_space(texts, block, idf, rules)
        shapes.append(vectors @ vectors.T)
    assert np.allclose(*shapes, atol=1e-6)


def test_the_searcher_of_the_pipeline_comes_from_all_documents(spark):
    """What ``clean`` sends to its tasks is the same for 8,000 documents and for the same passages in 1,000."""
    rng = random.Random(8)
    passages = [" ".join(f"w{min(rng.randrange(300), rng.randrange(300))}" for _ in range(64)) for _ in range(8000)]
    benchmark = spark.createDataFrame([(i, " ".join(f"w{rng.randrange(300)}" for _ in range(20))) for i in range(30)], "item_id long, text string")
    made = []
    for run in (1, 8):
        rows = [(i, "\n".join(passages[i : i + run])) for i in range(0, len(passages), run)]
        (shared,) = d.searchers(spark.createDataFrame(rows, "doc_id long, text string"), benchmark, d.LeakRules(latent=8))
        made.append(shared.value.terms @ shared.value.terms.T)
    assert np.allclose(*made, rtol=1e-3, atol=1e-3)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    assert [tuple(r)[:2] for r in d.leaks(docs, items).collect()] == [(1, 1)]
    assert d.leaks(docs, items.limit(0)).count() == 0 and d.clean(docs, items.limit(0)).count() == 1
    assert d.leaks(docs.limit(0), items).count() == 0 and d.clean(docs.limit(0), items).count() == 0


def test_items_and_texts_longer_than_a_chunk(spark):
    rng = random.Random(2)
    item = " ".join(f"w{rng.randrange(9000)}" for _ in range(20_000))
    text = " ".join(f"x{i}" for i in range(30_000)) + " " + item + " end"
    docs = spark.createDataFrame([(1, text), (2, text.replace("w", "v"))], "doc_id long, text string")
    items = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert [(r.doc_id, r.item_id, r.common_words) for r in d.leaks(docs, items).collect()] == [(1, 9, 20_000)]


@pytest.mark.parametrize("kind", ["int", "smallint", "bigint", "string"])
def test_ids_of_any_type(spark, kind):
    text = " ".join(f"word{i}" for i in range(30))
    docs = spark.createDataFrame([(1, "before " + text), (2, "nothing of the kind"), (None, text)], "doc_id long, text string")
    items = spark.createDataFrame([(7, text), (7, text), (None, text)], "item_id long, text string")
    docs, items = docs.withColumn("doc_id", F.col("doc_id").cast(kind)), items.withColumn("item_id", F.col("item_id").cast(kind))
    found = d.leaks(docs, items)
    assert dict(found.dtypes)["doc_id"] == dict(found.dtypes)["item_id"] == kind
    # repeated items are one
    assert sorted(((str(r.doc_id), str(r.item_id)) for r in found.collect())) == [("1", "7"), ("1", "None"), ("None", "7"), ("None", "None")]
    assert [r.doc_id for r in d.clean(docs, items).collect()] == [docs.filter("text like 'nothing%'").first().doc_id]
