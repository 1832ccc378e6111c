"""Product quantisation: trees, ranges and whole runs against comparing everything."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievewright.llm import queries, vector_codes
from sievewright.llm.vector_codes import CodeRules


def plain(rows, rules):
    """{position of row: (code, error)} and the codebooks, in plain integers."""
    kept = [
        (i, v, row)
        for i, (v, row, _) in enumerate(rows)
        if row is not None and all(x is not None and math.isfinite(x) for x in row) and len(row) == 8
    ]
    whole = [[math.floor(rules.scale * x) for x in row] for _, _, row in kept]
    first = sorted(range(len(kept)), key=lambda k: (kept[k][1] is None, kept[k][1] or 0, kept[k][2]))[: rules.entries]
    width = 8 // rules.parts
    piece = lambda k, p: whole[k][p * width : (p + 1) * width]
    books = [[piece(k, p) for k in first] for p in range(rules.parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rules.rounds):
        for p, book in enumerate(books):
            held = {}
            for k in range(len(kept)):
                held.setdefault(nearest(piece(k, p), book)[1], []).append(piece(k, p))
            books[p] = [[sum(c) // len(c) for c in zip(*held[e], strict=True)] if e in held else book[e] for e in range(len(book))]
    done = {}
    for k, (i, _, _) in enumerate(kept):
        best = [nearest(piece(k, p), books[p]) for p in range(rules.parts)]
        done[i] = ("".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best))
    return done, books


@pytest.mark.parametrize("kind", ["spread", "lumps", "copies", "one", "huge"])
def test_ranges_are_nearest_entries(kind):
    rng = np.random.default_rng(4)
    lumps = rng.integers(-900, 900, (12, 5))
    points = {
        "spread": rng.integers(-300, 300, (500, 5)),
        "lumps": lumps[rng.integers(0, 12, 600)] + rng.integers(-6, 7, (600, 5)),
        "copies": lumps[rng.integers(0, 3, 200)],
        "one": lumps[:1],
        "huge": rng.integers(-vector_codes.MOST, vector_codes.MOST, (300, 5)),
    }[kind]
    order, nodes = vector_codes.build_tree(points, 4)
    assert sorted(order.tolist()) == list(range(len(points)))
    for node in nodes:
        inside = points[order[node["start"] : node["end"]]].astype(object) - points[node["center"]].astype(object)
        assert max((x * x).sum() for x in inside) <= node["radius"] ** 2 * (1 + 1e-9)
    for entries in (points[:40], lumps, np.repeat(lumps, 2, axis=0), lumps[:1]):
        start, end, code = vector_codes.nearest_ranges(points, order, nodes, entries)
        found = np.full(len(points), -1)
        found[order[vector_codes._spread(start, end - start)]] = np.repeat(code, end - start)
        far = [[sum((int(a) - int(b)) ** 2 for a, b in zip(x, c, strict=True)) for c in entries] for x in points]
        assert found.tolist() == [row.index(min(row)) for row in far]
        if kind == "lumps" and len(entries) == 12:
            assert len(start) < len(points) / 4  # whole subtrees, not points


def vectors(n=300, seed=8):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        row = [rng.choice([-0.5, 0.1, 0.9]) + rng.gauss(0, 0.05 if i % 3 else 0.4) for _ in range(8)]
        rows.append((rng.randrange(10**6), row, rng.choice([None, 1, 2, 2, 2])))
    rows += [(1, None, 1), (2, [None] * 8, 1), (3, [math.nan] * 8, 1), (4, [math.inf] + [0.0] * 7, 2), (5, [], 2), (6, [1.0, 2.0], 1)]
    return [*rows, (None, rows[0][1], None), (None, [-0.0] * 8, 1), rows[1], (rows[2][0], rows[3][1], 2)]


def test_codes_equal_comparing_everything(spark):
    rules, rows = CodeRules(entries=24, rounds=3, chunk=64, leaf=3), vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("CODE", F.lit("clash"))
    coded, books = vector_codes.encode(df.repartition(3), rules)
    done, expected = plain(rows, rules)
    assert books.tolist() == expected
    wanted = sorted(((rows[i][0], rows[i][2], *x) for i, x in done.items()), key=str)
    assert sorted(map(tuple, coded.collect()), key=str) == wanted
    totals = {}
    for _, label, _, error in wanted:
        totals[label] = totals.get(label, 0) + error
    labelled = vector_codes.with_label_errors(coded)
    assert {(r.label, r.label_error) for r in labelled.collect()} == set(totals.items())
    assert labelled.count() == len(wanted)
    numbers = ",".join(str(x) for book in expected for entry in book for x in entry)
    assert vector_codes.books_sha256(books) == hashlib.sha256(numbers.encode()).hexdigest()


def test_floats_few_rows_and_no_rows(spark):
    rows = [(i, [0.1 * i] * 8, "a") for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>, label string")
    coded, books = vector_codes.encode(df, CodeRules())
    assert books.shape == (4, 5, 2) and {r.error for r in coded.collect()} == {0}
    assert dict(coded.dtypes) == {"vec_id": "int", "label": "string", "code": "string", "error": "bigint"}
    for empty in (df.limit(0), df.withColumn("embedding", F.lit(None).cast("array<float>"))):
        coded, books = vector_codes.encode(empty)
        assert vector_codes.with_label_errors(coded).collect() == [] and books.size == 0


def test_the_sql_gives_the_same(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, [float(np.float32(rng.gauss(0, 0.3))) for _ in range(16)], rng.choice([None, 1, 2])) for i in range(400)]
    rows[7] = (7, None, 1)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.QUERIES["op13_vector_codes"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    expected = con.execute(queries.ORACLES["op13_vector_codes"]).df()
    order = lambda df: df.sort_values("vec_id").reset_index(drop=True)[sorted(df.columns)]
    pd.testing.assert_frame_equal(order(found), order(expected), check_dtype=False)
