"""MinHash: signatures, the posterior test, links and components against brute force."""

from __future__ import annotations

import random
from fractions import Fraction
from math import factorial

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievewright.llm import minhash
from sievewright.llm.minhash import MinHashRules

PAIRS = MinHashRules(shingle=2)


def plain_set(text, size):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(len(words) - size + 1, 1))}


def plain(rows, size=2, percent=80):
    """(doc_id, n_shingles, component_id, kept), comparing all pairs."""
    sets = [frozenset(plain_set(t, size)) for _, t in rows]
    parent = {s: s for s in sets}

    def find(s):
        while parent[s] != s:
            s = parent[s]
        return s

    distinct = list(parent)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(a)] = find(b)
    first = {}
    for (doc, _), s in zip(rows, sets, strict=True):
        if s and doc is not None:
            first[find(s)] = min(doc, first.get(find(s), doc))
    named = [doc if not s else first.get(find(s)) for (doc, _), s in zip(rows, sets, strict=True)]
    return [(doc, len(s), c, doc == c) for (doc, _), s, c in zip(rows, sets, named, strict=True)]


def changed(words, rng, times):
    words = list(words)
    for _ in range(times):
        at = rng.randrange(len(words))
        words[at : at + rng.randint(0, 1)] = [f"new{rng.randrange(10**6)}"]
    return words


def corpus(seed=3):
    """Families of near copies at all distances, a chain, short texts, odd ones, repeated rows and ids."""
    rng = random.Random(seed)
    rows = []
    for _ in range(30):
        words = [f"w{rng.randrange(4000)}" for _ in range(rng.randint(3, 160))]
        for _ in range(rng.randint(1, 6)):
            rows.append(" ".join(changed(words, rng, rng.randint(0, len(words) // 8))))
    link = [f"c{i}" for i in range(120)]
    for _ in range(12):
        link = changed(link, rng, 5)
        rows.append(" ".join(link))
    rows += ["One", "one", "one two", "ONE  two\n", "one two three", "x" * 50_000, "é ß 日本 x y", "É ß 日本 x y"]
    rng.shuffle(rows)
    numbered = [(rng.randrange(10**9), t) for t in rows]
    odd = [(-1, None), (-2, ""), (-3, " \t\n"), (None, None), (None, "nobody else says this"), (None, "nobody else says this")]
    return [*numbered, *odd, numbered[0], (None, numbered[1][1]), (numbered[2][0], numbered[3][1])]


def test_shingles_are_told_apart_like_strings():
    texts = [None, "", " ", "a", "A", "b", "a b", "a  b", "b a", "a a", "a b a b", "ab", "a b c", "x " * 3000]
    for size in (1, 2, 5):
        for s in texts:
            found = minhash.shingle_set(None if s is None else s.encode(), size)
            assert len(found) == len(plain_set(s, size)) and list(found) == sorted(set(found.tolist()))
            for t in texts:
                same = plain_set(s, size) == plain_set(t, size)
                assert np.array_equal(found, minhash.shingle_set((t or "").encode(), size)) == same


def test_signatures_agree_as_often_as_sets_are_alike():
    factors, shifts = minhash._permutations(4000)
    rng = np.random.default_rng(1)
    for shared in (200, 900, 3000):
        x = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
        a, b = x[: 2000 + shared // 2], x[2000 - shared // 2 :]
        alike = (minhash.signature(a, factors, shifts) == minhash.signature(b, factors, shifts)).mean()
        assert abs(alike - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.04


def test_the_posterior_is_that_of_a_uniform_prior():
    def beyond(m, n, t):
        """P(similarity >= t) by integrating s^m (1-s)^(n-m) term by term."""
        norm = Fraction(factorial(m) * factorial(n - m), factorial(n + 1))
        total = Fraction(0)
        for k in range(n - m + 1):
            c = factorial(n - m) // (factorial(k) * factorial(n - m - k)) * (-1) ** k
            total += Fraction(c, m + k + 1) * (1 - Fraction(t) ** (m + k + 1))
        return total / norm

    for n in (5, 20, 40):
        m = minhash.least_matches(n, 0.75, 1e-3)
        assert m == 0 or beyond(m - 1, n, Fraction(3, 4)) < Fraction(1, 1000)
        assert beyond(m, n, Fraction(3, 4)) >= Fraction(1, 1000)


def test_batches_drop_what_single_pairs_would():
    rules = MinHashRules()
    rng = np.random.default_rng(2)
    left = rng.integers(0, 9, (400, rules.values), dtype=np.uint16)
    right = np.where(rng.random((400, 1)) > rng.random((400, rules.values)), left, 99).astype(np.uint16)
    expected = [
        i
        for i in range(400)
        if all((left[i, :stop] == right[i, :stop]).sum() >= least for _, stop, least in minhash._steps(rules))
    ]
    assert minhash.survivors(left, right, minhash._steps(rules)).tolist() == expected
    assert 0 < len(expected) < 400


@pytest.mark.parametrize("block", [3, 256])
def test_components_equal_brute_force(spark, block):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"SET": F.lit(1), "node": F.lit("x")})
    found = minhash.near_duplicates(docs.repartition(5), MinHashRules(shingle=2, block=block))
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(plain(rows), key=str)


def test_five_words_and_other_names_and_types(spark):
    rows = [(f"id{i}", t) for i, t in enumerate(["a b c d e f", "A b c d e f", "a b c d", "a b c d e", "", None, "a b c d"])]
    docs = spark.createDataFrame(rows, "name string, body string")
    found = minhash.near_duplicates(docs, id_column="name", text_column="body")
    assert sorted(map(tuple, found.collect())) == sorted(plain(rows, 5))
    assert minhash.near_duplicates(docs.limit(0), id_column="name", text_column="body").collect() == []
    numbers = docs.select(F.lit(7).alias("doc_id"), F.col("body").alias("text"))
    assert {r.component_id for r in minhash.near_duplicates(numbers).collect()} == {7}


def test_a_large_group_of_unlinked_texts_is_compared_completely(spark):
    """Texts that share two thirds of their shingles, and a few linked to one that is no pivot."""
    rng = random.Random(11)
    common = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(common + [f"o{i}x{j}" for j in range(55)])) for i in range(60)]
    for i in range(60, 70):
        base = rows[rng.randrange(20, 40)][1].split()
        rows.append((i, " ".join(changed(base, rng, 4))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = minhash.near_duplicates(docs, MinHashRules(shingle=2, bands=60, rows=3, block=8))
    assert sorted(map(tuple, found.collect())) == sorted(plain(rows))
