"""Quality rules, line dedup and mixing against plain Python."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievewright.llm import line_dedup, mixing, repetition

SPACES = " \t\n\x0b\x0c\r"


def words_of(text: str) -> list[str]:
    out, word = [], ""
    for c in text:
        if c in SPACES:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return [*out, word] if word else out


def covered(words, n):
    grams = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return {i + j for i in range(len(words) - n + 1) if grams[tuple(words[i : i + n])] > 1 for j in range(n)}


def measured(text: str, lengths):
    words, seen, lines, chars = words_of(text), set(), 0, 0
    for line in text.split("\n"):
        if line in seen:
            lines += 1
            chars += sum(map(len, words_of(line)))
        elif words_of(line):
            seen.add(line)
    inside = [sum(len(words[i]) for i in covered(words, n)) for n in lengths]
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(covered(words, 3)), chars, *inside]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é\n\t#\x1c\x0b", max_size=200))
def test_measures_equal_a_plain_count(text):
    assert repetition.measure(text.encode(), (5, 7, 10)) == measured(text, (5, 7, 10))


def test_large_vocabularies_are_ranked_before_they_are_combined():
    words = [f"w{i}" for i in range(2_000_010)]
    found = repetition.measure(" ".join(words + words[:4]).encode(), (5,))
    assert found[0] == len(words) + 4 and found[4] == 8


def test_quality_rules_on_odd_rows(spark):
    clean = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (3, clean), (3, clean), (None, clean), (4, "same words again " * 60), (5, "\n".join([clean] + ["one line"] * 400))],
        "doc_id long, text string",
    ).withColumns({"kept": F.lit("clash"), "n_words": F.lit(None).cast("string")})
    kept = {(r.doc_id, r.kept, r.base_failed) for r in repetition.judge(docs).collect()}
    assert kept == {(1, False, True), (2, False, True), (3, True, False), (None, True, False), (4, False, True), (5, False, True)}
    left = repetition.keep(docs)
    assert left.schema == docs.schema and sorted(str(r.doc_id) for r in left.collect()) == ["3", "3", "None"]
    assert repetition.judge(docs.limit(0)).count() == 0


def deduped(docs, least=10, documents=2):
    lower = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    key = lambda line: line.strip(SPACES).translate(lower)
    holders = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= least:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        gone = [doc is not None and len(holders.get(key(x), ())) >= documents and min(holders[key(x)]) < doc for x in lines]
        out.append((doc, len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone, strict=True) if not g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("documents", [2, 3])
def test_line_dedup_equals_plain_python(spark, documents):
    rng = random.Random(3)
    lines = [f"shared line number {i}" for i in range(12)] + ["  SHARED line number 3\t", "short", "", "ÄÖ shared ÄÖ é", "ÄÖé日本語テキスト"]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for i in range(60)]
    rows += [(7, rows[7][1]), (None, "shared line number 1\nx"), (200, None), (201, ""), (202, "unique " * 20_000 + "\nshared line number 2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lines": F.lit(1), "n_dropped": F.lit("x")})
    rules = line_dedup.LineRules(min_documents=documents)
    done = line_dedup.dedup_lines(docs, rules, "done").select("doc_id", "done.n_lines", "done.n_dropped", "done.text")
    assert sorted(map(tuple, done.collect()), key=str) == deduped(rows, documents=documents)


def test_line_dedup_keeps_columns_and_fits_the_length(spark):
    docs = spark.createDataFrame(
        [(1, "a long shared line\nfirst", 24), (2, "A long shared line \nsecond", 26), (3, None, None)], "doc_id long, text string, n_chars int"
    )
    done = line_dedup.replace_texts(docs)
    assert done.schema == docs.schema
    assert sorted(map(tuple, done.collect())) == [(1, "a long shared line\nfirst", 24), (2, "second", 6), (3, None, None)]
    assert line_dedup.replace_texts(docs.limit(0)).count() == 0


def filled(sizes: dict, weights=(1, 2, 3), most=3):
    """Targets by sharing the excess again until no source is above its limit."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / open_weight for s in names}
        above = {s for s in names if s not in capped and target[s] > most * sizes[s]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("seed", range(6))
def test_targets_equal_repeated_sharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}é"[: rng.randint(2, 4)]: rng.choice([0, 1, 5, 40, 900]) for i in range(rng.randint(1, 9))}
    if seed % 2:
        sizes[None] = 77
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r.source: r.target for r in mixing.targets(rows).collect()}
    assert found == pytest.approx(filled(sizes))


def test_mix_emits_every_copy(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["a", "a", "a", "b", None]), 5) for i in range(400)]
    rows += [(None, "no id here", "b", 5), (3, None, "c", 5), (9, "x y", "d", 5), (9, "x y", "d", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy int")
    whole = mixing.with_copies(docs).select("doc_id", "source", "mix.*").collect()
    assert len(whole) == len(rows)
    sizes = Counter()
    for _, text, source, _ in rows:
        sizes[source] += len((text or "").split())
    target = filled(dict(sizes))
    for r in whole:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert r.copies in (int(r.rate), int(r.rate) + 1) and r.copies <= 3
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy_"]
    assert mixed.count() == sum(r.copies for r in whole)
    again = mixing.mix(docs.repartition(7))
    assert sorted(map(str, mixed.collect())) == sorted(map(str, again.collect()))
    for source in sizes:
        taken = sum(r.size * r.copies for r in whole if r.source == source)
        assert abs(taken - target[source]) <= 0.35 * max(target[source], 100)


def test_mix_without_rows_or_words(spark):
    docs = spark.createDataFrame([(1, None, None), (2, " \t", "a")], "doc_id long, text string, source string")
    assert [(r.mix.target, r.mix.copies) for r in mixing.with_copies(docs).collect()] == [(0.0, 0), (0.0, 0)]
    assert mixing.mix(docs.limit(0)).count() == 0


def test_each_repetition_limit_rejects_by_itself():
    """Texts that pass the base rule and exceed one limit only."""
    plain = iter(f"w{i:04}" for i in range(9999))
    some = lambda n: [next(plain) for _ in range(n)]

    def repeating(length, phrases, filler):
        twice = [some(length) for _ in range(phrases)]
        return " ".join(w for p in twice + twice for w in [*p, *some(filler // (2 * phrases))])

    # 45 % in 5-grams, 14 % in 7-grams, 12 % in 10-grams
    five, seven, ten = repeating(5, 10, 120), repeating(7, 2, 172), repeating(12, 1, 176)
    lines = "\n".join(x for w in some(40) for x in ("a-long-word-in-a-line", w))
    fine = repeating(9, 1, 182)
    texts = [t.encode() for t in (five, seven, ten, lines, fine)]
    limits = repetition.RULES.ngram_limits
    assert [most for _, most in limits] == [15, 13, 10] and repetition.RULES.max_line_characters == 20
    for measured, over in zip((repetition.measure(t, (5, 7, 10)) for t in texts), (0, 1, 2, None, None), strict=True):
        characters = measured[1]
        assert [100 * n > most * characters for n, (_, most) in zip(measured[6:], limits, strict=True)] == [i == over for i in range(3)]
        assert (100 * measured[5] > 20 * characters) == (measured is not None and measured[5] > 0)
    verdicts = list(zip(*repetition._verdicts(texts, repetition.RULES)[-2:], strict=True))
    assert verdicts == [(False, False)] * 4 + [(False, True)]


@pytest.mark.parametrize("known", [0, 2])
def test_mix_meets_its_targets_without_ids(spark, known):
    """Null ids, or half of them: the draw follows the text, so rows of different texts are drawn apart."""
    number = F.col("id")
    docs = spark.range(20_000).select(
        F.when(number % 2 < known // 2, number).alias("doc_id"),
        F.concat(F.lit("some words of "), number).alias("text"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c"), F.lit("c")), (number % 4 + 1).cast("int")).alias("source"),
    )
    mixed = mixing.with_copies(docs).groupBy("source").agg(F.sum(F.col("mix.size") * F.col("mix.copies")).alias("taken"), F.max("mix.target").alias("target"))
    for r in mixed.collect():
        assert abs(r.taken - r.target) <= 0.03 * r.target
