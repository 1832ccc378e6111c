"""The hidden Markov model against enumeration of all state sequences, its counts against plain ones."""

from __future__ import annotations

import itertools
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import hmm
from sievewright.llm.common import is_fold

RULES = hmm.HmmRules(states=2, symbols=6, frequent=9, segment=5, rounds=4, smoothing=1.0)


def model(k=3, symbols=5, seed=1):
    rng = np.random.default_rng(seed)
    part = lambda *shape: (x := rng.random(shape)) / x.sum(axis=-1, keepdims=True)
    return hmm.Hmm(part(k), part(k, k), part(k, symbols).T.copy())


def paths(m, sequence):
    """Every state sequence with its joint probability."""
    for states in itertools.product(range(len(m.start)), repeat=len(sequence)):
        p = m.start[states[0]] * m.emit[sequence[0], states[0]]
        for i in range(1, len(sequence)):
            p *= m.moves[states[i - 1], states[i]] * m.emit[sequence[i], states[i]]
        yield states, p


def test_likelihood_is_the_sum_over_all_paths():
    m, rng = model(), random.Random(2)
    sequences = [np.array([rng.randrange(5) for _ in range(n)], np.int32) for n in (1, 6, 3, 6, 2, 4)]
    expected = [math.log10(sum(p for _, p in paths(m, s))) for s in sequences]
    assert m.log10(sequences) == pytest.approx(expected, rel=1e-12)


def test_expected_counts_are_those_of_all_paths():
    m, rng = model(), random.Random(3)
    sequences = [np.array([rng.randrange(5) for _ in range(n)], np.int32) for n in (4, 1, 6, 5)]
    start, moves, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((5, 3))
    for s in sequences:
        whole = sum(p for _, p in paths(m, s))
        for states, p in paths(m, s):
            start[states[0]] += p / whole
            for i, state in enumerate(states):
                emit[s[i], state] += p / whole
                if i:
                    moves[states[i - 1], state] += p / whole
    found = hmm.Expected(m)
    found.add(sequences, 100)
    assert np.allclose(found.start, start) and np.allclose(found.moves, moves) and np.allclose(found.emit, emit)


def test_states_that_are_hard_to_leave_do_not_underflow():
    """Symbols alternate that only one of two states emits, beside a plain recursion scaled at every step."""
    m = hmm.Hmm(np.array([1 - 1e-10, 1e-10]), np.array([[1 - 1e-10, 1e-10], [1e-10, 1 - 1e-10]]), np.array([[1 - 1e-19, 1e-19], [1e-19, 1 - 1e-19]]))
    sequence = np.arange(101) % 2
    forwards, logs, f = [], 0.0, None
    for x in sequence:
        f = (m.start if f is None else f @ m.moves) * m.emit[x]
        logs += math.log10(f.sum())
        f = f / f.sum()
        forwards.append(f)
    emit, back = np.zeros((2, 2)), np.ones(2)
    for x, f, following in zip(sequence[::-1], forwards[::-1], [None, *sequence[:0:-1]], strict=True):
        if following is not None:
            back = m.moves @ (m.emit[following] * back)
            back /= back.sum()
        emit[x] += f * back / (f * back).sum()
    assert m.log10([sequence[:3], sequence])[1] == pytest.approx(logs, rel=1e-12)
    found = hmm.Expected(m)
    found.add([sequence], 1000)
    assert np.allclose(found.emit, emit, rtol=1e-9, atol=0) and found.moves.sum() == pytest.approx(100)


def test_a_round_holds_few_segments_at_a_time():
    """4,096 segments of 256 tokens; forward and backward values of all of them are 134 MB."""
    sequences = [np.random.default_rng(9).integers(0, 500, 1024).astype("<u2")] * 1024
    found = hmm.Expected(model(8, 500))
    tracemalloc.start()
    try:
        found.add(sequences, 256)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found.emit.sum() == pytest.approx(1 << 20) and found.start.sum() == pytest.approx(1024)
    assert most < 64 << 20


def test_training_raises_the_likelihood():
    rng, m = np.random.default_rng(4), model(2, 4, 8)
    sequences = [np.where(np.arange(30) // 6 % 2, rng.integers(0, 2, 30), rng.integers(2, 4, 30)).astype(np.int32) for _ in range(40)]
    before = m.log10(sequences).sum()
    for _ in range(4):
        counts = hmm.Expected(m)
        counts.add(sequences, 100)
        m = hmm._maximize(counts.start, counts.moves, counts.emit, np.full(4, 0.25), 0.01)
        after = m.log10(sequences).sum()
        assert after > before - 1e-6
        before = after


def rows():
    rng = random.Random(6)
    vocabulary = ["The", "the", "cat", "sat.", "on,", "mat", "é!", "x1", "unusually-long-word", *(f"rare{i}" for i in range(60))]
    made = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 40)))) for i in range(80)]
    return [*made, (None, "the cat"), (3, made[3][1]), (500, None), (501, ""), (502, " \t\x0b"), (503, "never seen before " * 2000)]


def test_scores_equal_plain_python(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumns({"n": F.lit("x"), "word": F.lit(1), "row": F.lit(2)})
    counts, words, trained = hmm.train(docs.filter(~is_fold("doc_id", 5, 1)), RULES)
    scored = hmm.score(docs, counts, words, trained).collect()
    tokens = {t: [*(t or "").encode().lower().split(), b""] for _, t in data}
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    c = Counter(w for i, t in data if not held(i) for w in tokens[t])
    total, distinct = sum(c.values()), len(c)
    assert (words.total, words.distinct) == (total, distinct)
    own = set(list(words.place)[: words.own])
    classes = {}
    for w, n in c.items():
        if w not in own:
            classes.setdefault(hmm.shape(w), []).append(n)
    expected = []
    for i, t in data:
        base = sum(math.log10((c[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in tokens[t])
        chain = trained.log10([words.encode(t.encode() if t else None)[0]])[0]
        for w in tokens[t]:
            if w not in own:
                inside = classes.get(hmm.shape(w), [])
                chain += math.log10((c[w] + 0.5) / (sum(inside) + 0.5 * (len(inside) + 1)))
        expected.append((i, len(tokens[t]), sum(c[w] > 0 for w in tokens[t]), base, chain))
    order = lambda r: (str(r[0]), r[1])
    for found, wanted in zip(sorted(map(tuple, scored), key=order), sorted(expected, key=order), strict=True):
        assert found[:3] == wanted[:3] and found[3:] == pytest.approx(wanted[3:], rel=1e-9)


def test_one_encoding_serves_training_and_scores(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    held = is_fold("doc_id", 5, 1)
    counts, words, trained = hmm.train(docs.filter(~held), RULES)
    found, _, model = hmm.train_and_score(docs, held, RULES)
    assert np.allclose(model.emit, trained.emit) and np.allclose(model.moves, trained.moves)
    order = lambda r: (str(r[0]), r[1], r[3])
    pairs = zip(sorted(map(tuple, found.collect()), key=order), sorted(map(tuple, hmm.score(docs, counts, words, trained).collect()), key=order), strict=True)
    assert all(a[:3] == b[:3] and a[3:] == pytest.approx(b[3:], rel=1e-9) for a, b in pairs)


def test_all_symbols_of_a_state_sum_to_one(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    _, words, trained = hmm.train(docs, RULES)
    assert words.own <= 6 and len(words.place) <= 10
    assert trained.emit.shape == (words.symbols, 2)
    assert np.allclose(trained.emit.sum(axis=0), 1) and np.allclose(trained.moves.sum(axis=1), 1) and trained.start.sum() == pytest.approx(1)


def test_every_round_covers_all_training_documents(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string")
    _, words, trained = hmm.train(docs, RULES)
    sequences = [words.encode(t.encode() if t else None)[0] for _, t in rows()]
    plain = (words.counts + 0.5) / (words.counts + 0.5).sum()
    emit = plain[:, None] * np.random.default_rng(RULES.seed).gamma(2.0, size=(len(plain), 2))
    m = hmm.Hmm(np.full(2, 0.5), np.array([[0.9, 0.1], [0.1, 0.9]]), emit / emit.sum(axis=0))
    for _ in range(RULES.rounds):
        counts = hmm.Expected(m)
        counts.add(sequences, RULES.segment)
        m = hmm._maximize(counts.start, counts.moves, counts.emit, plain, RULES.smoothing)
    assert np.allclose(trained.start, m.start) and np.allclose(trained.moves, m.moves) and np.allclose(trained.emit, m.emit)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    counts, words, trained = hmm.train(docs.limit(0), RULES)
    found = sorted(map(tuple, hmm.score(docs, counts, words, trained).collect()))
    assert [r[:4] for r in found] == [(1, 3, 0, 0.0), (2, 1, 0, 0.0)] and all(math.isfinite(r[4]) for r in found)
    assert hmm.score(docs.limit(0), counts, words, trained).count() == 0
