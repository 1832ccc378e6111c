"""Alignment of two tokenizers against a plain count over byte offsets."""

from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import token_alignment
from sievewright.llm.token_alignment import AlignmentRules

RULES = AlignmentRules()
pytestmark = pytest.mark.skipif(not os.path.isdir(RULES.folder), reason="needs the tokenizer files")


@pytest.fixture(scope="module")
def both():
    return token_alignment.vocabularies(RULES)


def plain(both, rows):
    """Groups and links by comparing running byte offsets, then counts over all rows."""
    docs = []
    for doc, text in rows:
        groups = []
        if text:
            a = both.a.encode(" " + text, add_special_tokens=False).ids
            b = both.b.encode(text)
            full = (" " + text).encode()
            if b"".join(both.a_bytes[i] for i in a) == full == b"".join(both.b_bytes[i] for i in b):
                a, b, at_a, at_b, group = list(a), list(b), 0, 0, ([], [])
                while a or b:
                    side, ids, sizes = (0, a, both.a_bytes) if at_a <= at_b else (1, b, both.b_bytes)
                    token = ids.pop(0)
                    group[side].append(token)
                    at_a, at_b = (at_a + len(sizes[token]), at_b) if side == 0 else (at_a, at_b + len(sizes[token]))
                    if at_a == at_b:
                        groups.append(group)
                        group = ([], [])
        docs.append((doc, groups))
    counts = Counter((a[-1], b[-1]) for _, groups in docs for a, b in groups)
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    found = []
    for doc, groups in docs:
        links = [(a[-1], b[-1]) for a, b in groups]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        best, total = sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links)
        sizes = [sum(len(g[i]) for g in groups) for i in (0, 1)]
        found.append((doc, *sizes, len(groups), len(links), best, total, hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return found, counts


ODD = [None, "", " ", "\n", "\x00", "a", "a▁b", "<|endoftext|>", "<s> </s> <unk> <0x41>", "é ß 日本語 🙂🙂 x", "​﻿ zero", "a\r\n\tb   c    ", "'s 're '"]


def corpus():
    rng = random.Random(6)
    words = "the of Wörter naïve unbelievable tokenization 12345 3.14 foo_bar ¿qué? straße l'été XyZzY http://a.b/c".split()
    rows = [(i, rng.choice(" \n").join(rng.choice(words) for _ in range(rng.randint(1, 60)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(ODD)]
    return [*rows, rows[3], (None, rows[4][1]), (rows[5][0], "same id, other text"), (200, "longer " * 30_000)]


def test_bytes_of_all_ids(both):
    assert len(token_alignment.byte_letters()) == 256 and sorted(token_alignment.byte_letters().values()) == list(range(256))
    assert {bytes([b]) for b in range(256)} <= set(both.a_bytes) and {bytes([b]) for b in range(256)} <= set(both.b_bytes)
    for a, b in enumerate(both.same):
        assert (b < 0 and both.a_bytes[a] not in set(both.b_bytes[:3])) or both.a_bytes[a] == both.b_bytes[b]


def test_both_implementations_of_a_agree(both):
    """Every code point in several places, random texts, and runs that only the slower one takes."""
    points = [c for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    texts = [f" a{c}b {c} {c}{c}1{c}\n{c}'{c}s {c}  {c}   x" for c in map(chr, points)]
    rng = random.Random(8)
    texts += ["".join(chr(rng.choice(points)) if rng.random() < 0.3 else rng.choice("aE 's\n19.é") for _ in range(300)) for _ in range(300)]
    plain = both.a.encode_batch_fast(texts, add_special_tokens=False)
    assert all(e.ids == both.fast.encode_ordinary(t) for t, e in zip(texts, plain, strict=True))
    for text in (" " + "ab" * 60_000, " x" + " " * 100_000 + "y", "\n" * 50_000):
        assert both.a_ids(text) == both.a.encode(text, add_special_tokens=False).ids


def test_parts_hold_all_texts_in_order():
    texts = [b"a" * n if n else None for n in (5, 0, 3, 9, 1, 1)] + [b"", b"\xff"]
    for most in (1, 4, 100):
        assert [i for part in token_alignment._parts(texts, most) for i, _ in part] == [0, 2, 3, 4, 5]


@pytest.mark.parametrize("frequent", [0, 7, 1 << 18])
def test_scores_equal_a_plain_count(spark, both, frequent):
    """However many pairs go to the tasks and however many are joined."""
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"ROW": F.lit("clash"), "same": F.lit(0)})
    scores, regular, irregular = token_alignment.align_tokenizers(docs.repartition(3), AlignmentRules(frequent=frequent, part=500))
    expected, counts = plain(both, rows)
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert scores.columns == columns
    assert sorted(map(tuple, scores.collect()), key=str) == sorted(expected, key=str)
    others = {(r.pair // len(both.b_bytes), r.b): r.n for r in irregular.collect()}
    same = {(int(a), int(both.same[a])): int(regular[a]) for a in np.flatnonzero(regular)}
    assert not set(others) & set(same) and others | same == counts
    assert len(others) > 7 and len(same) > 7


def test_other_types_and_no_rows(spark):
    docs = spark.createDataFrame([("x", "one two"), ("y", None)], "name string, body string")
    found = {r.doc_id: r for r in token_alignment.align_tokenizers(docs, RULES, "name", "body")[0].collect()}
    assert found["x"].n_groups == found["x"].n_best == 2 and tuple(found["y"])[1:] == (0,) * 6 + ("",)
    assert token_alignment.align_tokenizers(docs.limit(0), RULES, "name", "body")[0].collect() == []
    broken = docs.limit(1).select("name", F.expr("cast(X'61FF' as string)").alias("body"))
    assert [r.n_a for r in token_alignment.align_tokenizers(broken, RULES, "name", "body")[0].collect()] == [0]
