"""Compact codes of vectors: product quantisation by Lloyd rounds over cover trees.

Vectors are cut into equal parts, and each part position has a codebook. Tasks
build one cover tree per position over every chunk of vectors they read: a
node covers its points within its radius, and is split by the next smaller
power of two into children whose centers lie further apart than that. Points
are stored in tree order, so that differences of cumulative sums are the sums
of whole subtrees. The trees are written once and serve all rounds.

In a round every task compares centers with the codebook, level by level. A
subtree whose center is nearer to one entry than to any other by more than
twice the radius belongs to that entry as a whole, by the triangle inequality,
and is added by its cumulative sums; other nodes descend, and the points of
undecided leaves are compared one by one. Comparisons are exact integers with
ties to the lower entry. Only sums and counts per entry, summed across tasks,
reach the driver, which holds the codebooks and nothing else.

Defined results: rows whose vector is null or holds null or non-finite
components are left out. Of different lengths the most frequent one that is a
multiple of the parts counts, the smaller in a tie, and other rows are left
out. Components are floors of ``scale`` times the value, held within 2**26 on
both sides, so that all squares fit 64 bits. The first entries are the vectors
of the smallest ids, null ids last, equal ids by their components; fewer
vectors than entries make a smaller codebook. Null and repeated ids are coded
like any other, repeated rows get equal codes, and null labels are summed
together. Extra columns may have any names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import bound_batches, materialize, sized

#: Components are held within these bounds.
MOST = 1 << 26
#: Up to this size sums of products are exact in doubles.
_EXACT = 1 << 22

NODE = np.dtype([(c, "<i4") for c in ("center", "start", "end", "child", "children", "same")] + [("radius", "<f8")])


@dataclass(frozen=True)
class CodeRules:
    parts: int = 4
    entries: int = 256  # in a codebook, at most 256
    rounds: int = 4
    scale: int = 1024
    chunk: int = 1024  # vectors under one tree
    leaf: int = 8  # points that are not split further


RULES = CodeRules()


def whole_numbers(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.clip(np.floor(vectors * float(scale)), -MOST, MOST).astype(np.int64)


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, a row per point."""
    if len(points) and len(entries) and max(np.abs(points).max(), np.abs(entries).max()) <= _EXACT:
        points, entries = points.astype(np.float64), entries.astype(np.float64)
    return (points * points).sum(axis=1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(axis=1)


def build_tree(points: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, nodes) of a cover tree; ``order`` are the points as they stand under the nodes' ranges."""
    apart = squares(points, points).astype(np.float64)
    # doubles round beyond 2**53: radii must never be too small
    slack = 1e-12 * float(apart.max(initial=0))
    order = np.empty(len(points), np.int32)
    nodes: list[tuple] = []
    todo = [(0, np.arange(len(points)), 0, 0)]  # center, points, start, whether the parent has the same center
    while todo:
        level, todo = todo, []
        free = len(nodes) + len(level)
        for center, members, start, same in level:
            away = apart[center, members]
            far = float(away.max())
            radius = 0.0 if (points[members] == points[center]).all() else float(np.sqrt(far + slack))
            child = children = 0
            if radius and len(members) > leaf:
                reach = 2.0 ** (np.ceil(np.log2(far) / 2) - 1)  # below the farthest point
                child, at, rest = free, start, members
                head = center
                while len(rest):
                    near = apart[head, rest] <= reach * reach
                    group, rest = rest[near], rest[~near]
                    todo.append((head, group, at, int(head == center)))
                    at, children = at + len(group), children + 1
                    head = rest[0] if len(rest) else head
                free += children
            else:
                order[start : start + len(members)] = members
            nodes.append((center, start, start + len(members), child, children, same, radius))
    return order, np.array(nodes, NODE)


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All numbers of the ranges that begin at ``starts`` and have ``counts`` members."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


def nearest_ranges(points: np.ndarray, order: np.ndarray, nodes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, entry): ranges of the tree's order that share their nearest entry; all points are in one."""
    found = []
    now, above = np.array([0]), np.zeros(1, np.int64)
    best_above, gap_above = np.zeros(1, np.int64), np.zeros(1)
    while len(now):
        level = nodes[now]
        best, gap = best_above[above], gap_above[above]
        new = np.flatnonzero((level["same"] == 0) | (now == 0))
        far = squares(points[level["center"][new]], entries)
        best[new] = far.argmin(axis=1)
        rows = np.arange(len(new))
        first = np.sqrt(far[rows, best[new]].astype(np.float64))
        far = far.astype(np.float64)
        far[rows, best[new]] = np.inf
        second = np.sqrt(far.min(axis=1))
        # roots of numbers beyond 2**53 are not exact either
        gap[new] = (second - first) - 1e-9 * (1 + first)
        settled = (level["radius"] == 0) | (gap > 2 * level["radius"])
        found.append((level["start"][settled], level["end"][settled], best[settled]))

        leaves = level[~settled & (level["children"] == 0)]
        if len(leaves):
            places = _spread(leaves["start"], leaves["end"] - leaves["start"])
            found.append((places, places + 1, squares(points[order[places]], entries).argmin(axis=1)))
        split = np.flatnonzero(~settled & (level["children"] > 0))
        counts = level["children"][split]
        now, above = _spread(level["child"][split], counts), np.repeat(split, counts)
        best_above, gap_above = best, gap
    return tuple(np.concatenate([f[i] for f in found]) for i in range(3))


def _kept(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, rules: CodeRules) -> tuple[DataFrame, int]:
    """(vec_id, label, vector) of the rows with whole vectors of one length, and that length (0: none)."""
    bound_batches(vectors.sparkSession)
    named = vectors.select(
        F.col(id_column).alias("vec_id"),
        F.col(label_column).alias("label"),
        F.col(vector_column).cast("array<double>").alias("vector"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    named = named.filter(F.col("vector").isNotNull() & finite)
    sizes = named.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"))
    sizes = sizes.filter((F.col("size") > 0) & (F.col("size") % rules.parts == 0))
    most = sizes.orderBy(F.desc("n"), "size").first()
    length = most["size"] if most else 0
    return named.filter(F.size("vector") == length), length


def _trees(kept: DataFrame, length: int, rules: CodeRules) -> DataFrame:
    """One row per chunk of vectors: ids, labels, components and a tree per part."""
    types = dict(kept.dtypes)
    schema = f"ids array<{types['vec_id']}>, labels array<{types['label']}>, points binary, orders array<binary>, nodes array<binary>"
    width = length // rules.parts

    def lists(column: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rules.chunk):
                part = batch.slice(at, rules.chunk)
                values = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                points = whole_numbers(values.reshape(part.num_rows, length), rules.scale)
                trees = [build_tree(points[:, i : i + width], rules.leaf) for i in range(0, length, width)]
                columns = [
                    lists(pa.concat_arrays([part.column("vec_id")])),
                    lists(pa.concat_arrays([part.column("label")])),
                    pa.array([points.astype("<i4").tobytes()], pa.binary()),
                    pa.array([[order.tobytes() for order, _ in trees]], pa.list_(pa.binary())),
                    pa.array([[nodes.tobytes() for _, nodes in trees]], pa.list_(pa.binary())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["ids", "labels", "points", "orders", "nodes"])

    return materialize(kept.mapInArrow(run, schema))


def _unpacked(batch: pa.RecordBatch, length: int, parts: int) -> Iterator[tuple[int, list]]:
    """(row, [(points, order, nodes) per part]) of every tree row of a batch."""
    width = length // parts
    columns = [batch.column(c).to_pylist() for c in ("points", "orders", "nodes")]
    for row, (data, orders, nodes) in enumerate(zip(*columns, strict=True)):
        points = np.frombuffer(data, "<i4").reshape(-1, length).astype(np.int64)
        yield row, [
            (points[:, i * width : (i + 1) * width], np.frombuffer(orders[i], "<i4"), np.frombuffer(nodes[i], NODE))
            for i in range(parts)
        ]


def _first_books(kept: DataFrame, length: int, rules: CodeRules) -> np.ndarray:
    """Entries (part, entry, position) of the smallest ids; at most ``entries`` rows reach the driver."""
    rows = kept.select("vec_id", "vector").orderBy(F.asc_nulls_last("vec_id"), "vector").limit(rules.entries).collect()
    numbers = whole_numbers(np.array([r.vector for r in rows], np.float64).reshape(len(rows), length), rules.scale)
    return numbers.reshape(len(rows), rules.parts, length // rules.parts).transpose(1, 0, 2)


def _next_books(trees: DataFrame, books: np.ndarray, length: int) -> np.ndarray:
    """Every entry replaced by the floored mean of the parts that are nearest to it."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for _, trees_of in _unpacked(batch, length, parts):
                for i, (points, order, nodes) in enumerate(trees_of):
                    start, end, code = nearest_ranges(points, order, nodes, books[i])
                    running = np.zeros((len(order) + 1, width), np.int64)
                    np.cumsum(points[order], axis=0, out=running[1:])
                    np.add.at(totals[i], code, np.column_stack([running[end] - running[start], end - start]))
        used = np.argwhere(totals[:, :, -1] > 0)
        sums = [totals[i, e] for i, e in used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()), pa.array(sums, pa.list_(pa.int64()))],
            names=["part", "entry", "sums"],
        )

    found = trees.select("points", "orders", "nodes").mapInArrow(run, "part int, entry int, sums array<bigint>")
    single = found.select("part", "entry", F.posexplode("sums").alias("place", "value"))
    summed = single.groupBy("part", "entry", "place").agg(F.sum("value").alias("value"))
    totals = np.zeros((parts, entries, width + 1), np.int64)
    for part, entry, place, value in summed.collect():  # as many rows as the codebooks have numbers
        totals[part, entry, place] = value
    counts = totals[:, :, -1:]
    return np.where(counts > 0, totals[:, :, :-1] // np.maximum(counts, 1), books)


def _coded(trees: DataFrame, books: np.ndarray, length: int) -> DataFrame:
    """(vec_id, label, code, error) of every vector."""
    types = dict(trees.dtypes)
    parts = books.shape[0]
    schema = f"vec_id {types['ids'][6:-1]}, label {types['labels'][6:-1]}, code string, error bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, trees_of in _unpacked(batch, length, parts):
                codes = np.empty((len(trees_of[0][1]), parts), np.uint8)
                error = np.zeros(len(codes), np.int64)
                for i, (points, order, nodes) in enumerate(trees_of):
                    start, end, code = nearest_ranges(points, order, nodes, books[i])
                    codes[order[_spread(start, end - start)], i] = np.repeat(code, end - start)
                    error += ((points - books[i][codes[:, i]]) ** 2).sum(axis=1)
                columns = [
                    batch.column("ids").slice(row, 1).flatten(),
                    batch.column("labels").slice(row, 1).flatten(),
                    pa.array([c.tobytes().hex() for c in codes], pa.string()),
                    pa.array(error, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, schema)


def books_sha256(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode(
    vectors: DataFrame,
    rules: CodeRules = RULES,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every kept row, written, and the codebooks (part, entry, position)."""
    kept, length = _kept(vectors, id_column, vector_column, label_column, rules)
    trees = _trees(kept, length or rules.parts, rules)
    books = _first_books(kept, length or rules.parts, rules)
    for _ in range(rules.rounds if length else 0):
        books = _next_books(trees, books, length)
    return materialize(_coded(trees, books, length or rules.parts)), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the errors summed over rows of equal label (nulls together)."""
    sums = materialize(coded.groupBy(F.col("label").alias("same")).agg(F.sum("error").alias("label_error")))
    return coded.join(sized(sums), F.col("label").eqNullSafe(F.col("same"))).drop("same")
