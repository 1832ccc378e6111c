"""SimHash fingerprints, links and components against brute force."""

from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from sievewright.llm import simhash
from sievewright.llm.components import components


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(len(words) - 3, 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def linked(fps):
    return roots(fps, [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4])


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a b c d", "A b\tc  d e", "word " * 50, "é ß 日本 x y z " * 9])
def test_fingerprint_is_the_majority_of_shingle_bits(text):
    found = simhash.fingerprint(None if text is None else text.encode())
    assert found & (1 << 64) - 1 == plain_fingerprint(text)


def test_long_texts_are_taken_in_parts():
    text = " ".join(str(i * i) for i in range(70_000))
    assert simhash.fingerprint(text.encode()) & (1 << 64) - 1 == plain_fingerprint(text)


def test_the_hash_is_that_of_spark(spark):
    row = spark.sql("SELECT xxhash64('a b c é') AS h").first()
    assert row.h & (1 << 64) - 1 == xxhash.xxh64_intdigest("a b c é".encode(), 42)


def flipped(value, rng, most):
    for _ in range(rng.randint(0, most)):
        value ^= 1 << rng.randrange(64)
    return simhash._signed(value & (1 << 64) - 1)


@pytest.mark.parametrize("most_pairwise", [2, 16, 1000])
def test_links_connect_what_brute_force_connects(spark, most_pairwise):
    """Chains, a dense group and unlinked values; whatever the size from which keys are dense."""
    rng = random.Random(most_pairwise)
    values = {rng.getrandbits(64) - (1 << 63) for _ in range(150)}
    for start in list(values)[:12]:
        for _ in range(6):
            start = flipped(start, rng, 6)
            values.add(start)
    centre = rng.getrandbits(63)
    values |= {flipped(centre, rng, 3) for _ in range(60)}
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    edges = [(r.a, r.b) for r in simhash.links(fps, most_pairwise).collect()]
    assert all(a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in edges)
    assert roots(values, edges) == linked(sorted(values))


def test_components_of_paths_hubs_and_odd_edges(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(200, 260)] + [(0, i) for i in range(1, 90)] + [(500, 500)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    rng.shuffle(edges)
    table = spark.createDataFrame([*edges, *edges[:5], (None, 3), (4, None)], "a long, b long")
    expected = roots({n for e in edges for n in e}, edges)
    assert {r.node: r.root for r in components(table).collect()} == {n: r for n, r in expected.items() if n != r}
    assert components(table.limit(0)).count() == 0


def near_rows():
    rng = random.Random(9)
    rows, n = [], 0
    for _ in range(25):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 300))]
        for _ in range(rng.randint(1, 5)):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((n, " ".join(copy)))
            n += 1
    rng.shuffle(rows)
    return [*rows, (900, None), (901, ""), (902, " "), (rows[0][0], rows[0][1]), (None, rows[1][1]), (None, "quite alone with these words here")]


def test_near_duplicates_equal_brute_force(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit("clash"), "component_id": F.lit(0)})
    prints = [simhash._signed(plain_fingerprint(t)) for _, t in rows]
    root, names = linked(sorted(set(prints))), {}
    for (doc, _), fp in zip(rows, prints, strict=True):
        if doc is not None:
            names[root[fp]] = min(doc, names.get(root[fp], doc))
    expected = [(doc, fp, names.get(root[fp])) for (doc, _), fp in zip(rows, prints, strict=True)]
    found = simhash.near_duplicates(docs)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    kept = simhash.keep_first(docs)
    assert kept.schema == docs.schema
    expected = sorted([str(x) for x in set(names.values())] + ["None", "None"])
    assert sorted(str(r.doc_id) for r in kept.collect()) == expected
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_first(docs.limit(0)).count() == 0


def test_survivors_are_told_by_id_and_text(spark):
    text = lambda seed: " ".join(f"w{random.Random(seed).randrange(5000)}x{i}" for i in range(80))
    one, two, three, four = (text(seed) for seed in range(4))
    rows = [(1, one), (1, two), (2, two), (1, one), (None, three), (None, three), (None, three), (None, four), (5, four)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, simhash.keep_first(docs).collect()), key=str)
    assert kept == sorted([(1, one), (1, two), (None, three), (None, four), (5, four)], key=str)
