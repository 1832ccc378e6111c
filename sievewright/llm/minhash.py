"""Near duplicates by MinHash with sequential Bayesian verification.

A document's set are its distinct word shingles. Documents with equal sets are
one node; a node's MinHash signature is cut into bands, and nodes that share a
band are candidates. With 40 bands of 5 values a pair of similarity 0.8 shares
none with a probability of 1.3e-7.

A candidate's signatures are compared a batch of values at a time. With a
uniform prior, m equal values of n leave the similarity a posterior
Beta(m + 1, n - m + 1); a pair is dropped as soon as the posterior probability
of reaching the threshold falls below ``miss``. Pairs that survive all batches
are verified on their full sets, so no link is wrong.

Pairs inside a band's group are not all written out. Every member is first
compared with the least and the largest member of its group, which settles
groups of copies in rows linear in their members. Groups that then still hold
several components are cut into blocks of about ``block`` members; a task gets
two blocks at a time with their full sets, compares members of components that
are still apart, verifies the survivors at once and passes on only links that
join two components. A pair that shares several bands is verified under the
first. Groups of any size are compared completely. A large group of texts that
are all alike but not linked costs comparisons, though neither memory nor rows,
in the square of its members.

Defined results: null and empty texts and texts of white space have an empty
set, are linked with nothing and are kept. Texts with fewer words than a
shingle have their whole sequence as the only element. Texts are taken whole,
of any length. Repeated rows and documents with equal sets are in one
component. A null doc_id belongs to the component of its set but never names
it; a component without any id has a null component_id and keeps its rows.
Columns other than id and text play no part and may have any names. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import as_bytes, materialize, sized, texts_of
from sievewright.llm.components import components

_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)
_PART = 1024
_RESIDUES = 1 << 25


@dataclass(frozen=True)
class MinHashRules:
    shingle: int = 5
    percent: int = 80  # least similarity of linked documents, 100 * intersection / union
    bands: int = 40
    rows: int = 5  # signature values in a band
    batch: int = 40  # signature values compared before a pair is judged again
    miss: float = 1e-6  # posterior probability of a link below which a pair is dropped
    block: int = 256  # members of a large group compared at a time

    @property
    def values(self) -> int:
        return self.bands * self.rows


def shingle_set(data: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = (data or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    n = len(words) - size + 1
    # a whole sequence shorter than a shingle starts from its own length, so it equals no shingle
    mixed = np.full(n, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : i + n]) * _MIX
        mixed ^= mixed >> _SHIFT
    return np.unique(mixed)


def _permutations(values: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_613)
    drawn = rng.integers(0, 1 << 32, (2, values, 1), dtype=np.uint64).astype(np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


def signature(elements: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """The least of every permutation over the elements, of which there is one at least."""
    x = (elements >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), _PART):
        np.minimum(least, (factors * x[None, at : at + _PART] + shifts).min(axis=1), out=least)
    return least


def band_keys(signatures: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit key per row and band; the number of the band is part of it."""
    parts = signatures.reshape(len(signatures), bands, -1).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(parts.shape[2]):
        keys = (keys ^ parts[:, :, i]) * _MIX
        keys ^= keys >> _SHIFT
    return keys.view(np.int64)


def least_matches(compared: int, threshold: float, miss: float) -> int:
    """The fewest equal values of ``compared`` that leave a pair a chance of ``miss`` to reach the threshold.

    The posterior Beta(m + 1, n - m + 1) exceeds t with the probability that
    n + 1 throws of chance t succeed m times at most.
    """
    below = 0.0
    for m in range(compared + 1):
        below += comb(compared + 1, m) * threshold**m * (1 - threshold) ** (compared + 1 - m)
        if below >= miss:
            return m
    return compared + 1


def _steps(rules: MinHashRules) -> list[tuple[int, int, int]]:
    """(from, to, least matches so far) of every batch."""
    stops = [*range(rules.batch, rules.values, rules.batch), rules.values]
    return [
        (start, stop, least_matches(stop, rules.percent / 100, rules.miss))
        for start, stop in zip([0, *stops[:-1]], stops, strict=True)
    ]


def survivors(left: np.ndarray, right: np.ndarray, steps: list[tuple[int, int, int]]) -> np.ndarray:
    """Row numbers of the pairs of signatures (one pair a row) that no batch drops."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for start, stop, least in steps:
        matches = matches + (left[alive, start:stop] == right[alive, start:stop]).sum(axis=1)
        stays = matches >= least
        alive, matches = alive[stays], matches[stays]
    return alive


def _matrix(column: pa.Array, values: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), values)


def profiles(docs: DataFrame, rules: MinHashRules, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set, signature, bands) of every row; the last three are null for an empty set.

    ``set`` is a 128-bit hash of the whole set. Bands are made of the 32-bit
    signature; only the lower half of each of its values is kept to compare.
    """
    texts = texts_of(docs, id_column, text_column)
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, n_shingles bigint, set binary, signature binary, bands array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = _permutations(rules.values)
        for batch in batches:
            sizes, names, made = [], [], []
            for data in as_bytes(batch.column("text")):
                elements = shingle_set(data, rules.shingle)
                sizes.append(len(elements))
                names.append(xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None)
                if len(elements):
                    made.append(signature(elements, factors, shifts))
            signatures = np.array(made, np.uint32).reshape(len(made), rules.values)
            keys, short = iter(band_keys(signatures, rules.bands)), iter(signatures.astype(np.uint16))
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(names, pa.binary()),
                pa.array([next(short).tobytes() if n else None for n in sizes], pa.binary()),
                pa.array([next(keys) if n else None for n in sizes], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "set", "signature", "bands"])

    return texts.mapInArrow(run, schema)


def _sets(own: DataFrame) -> DataFrame:
    """(node, set, first, signature, bands): one row per different set; copies are reduced where they are read."""
    grouped = own.filter("set is not null").groupBy("set")
    once = grouped.agg(F.min("doc_id").alias("first"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    # numbered in the written rows, so they stay as they are
    return materialize(once.withColumn("node", F.monotonically_increasing_id()))


def _members(sets: DataFrame) -> DataFrame:
    """(key, n, least, most, node) for the bands that several nodes share."""
    tasks = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    postings = sets.select("node", "bands").repartition(tasks, "node").select("node", F.explode("bands").alias("key"))
    groups = postings.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least"), F.max("node").alias("most"))
    return materialize(postings.join(sized(materialize(groups.filter("n > 1"))), "key"))


def _likely(pairs: DataFrame, sets: DataFrame, rules: MinHashRules) -> DataFrame:
    """The pairs (a, b) that no batch of their signatures drops."""
    steps, values = _steps(rules), rules.values
    of_b = sets.select(F.col("node").alias("b"), F.col("signature").alias("of_b")).hint("merge")
    of_a = sets.select(F.col("node").alias("a"), F.col("signature").alias("of_a")).hint("merge")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = survivors(_matrix(batch.column("of_a"), values), _matrix(batch.column("of_b"), values), steps)
            yield batch.select(["a", "b"]).take(pa.array(rows))

    return pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "of_a", "of_b").mapInArrow(run, "a bigint, b bigint")


def _marked(needed: DataFrame) -> np.ndarray:
    """A bit per residue of the sets' hashes, set for those needed: 4 MB, whatever the number of sets."""
    residue = F.conv(F.hex(F.substring("set", 1, 4)), 16, 10).cast("bigint") % _RESIDUES
    words = needed.groupBy((residue / 32).cast("bigint").alias("word"))
    held = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (residue % 32).cast("int"))).alias("bits")).toArrow()
    marked = np.zeros(_RESIDUES // 32, np.uint32)
    marked[held.column("word").to_numpy()] = held.column("bits").to_numpy().astype(np.uint32)
    return marked


def _elements(docs: DataFrame, sets: DataFrame, members: DataFrame, rules: MinHashRules, *columns: str) -> DataFrame:
    """(node, elements): the full set of every node that shares a band, from the whole text of its first document.

    Most documents share no band. A bit table of fixed size, sent to all tasks,
    keeps nearly all of their sets out of the shuffle; the join decides.
    """
    texts = texts_of(docs, *columns)
    needed = materialize(members.select("node").distinct().join(sets.select("node", "set", "first"), "node"))
    sent = docs.sparkSession.sparkContext.broadcast(_marked(needed))
    needed = needed.select("node", F.col("set").alias("needed"), "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, names, lists = [], [], []
            for i, data in enumerate(as_bytes(batch.column("text"))):
                elements = shingle_set(data, rules.shingle)
                if not len(elements):
                    continue
                name = xxhash.xxh3_128_digest(elements.tobytes())
                residue = int.from_bytes(name[:4], "big") % _RESIDUES
                if sent.value[residue // 32] >> np.uint32(residue % 32) & np.uint32(1):
                    rows.append(i)
                    names.append(name)
                    lists.append(elements.view(np.int64))
            columns = [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(names, pa.binary()), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "set", "elements"])

    made = texts.mapInArrow(run, f"doc_id {dict(texts.dtypes)['doc_id']}, set binary, elements array<bigint>")
    # by id as well, so that the copies of a text do not meet in one task
    same = F.col("set").eqNullSafe(F.col("needed")) & F.col("doc_id").eqNullSafe(F.col("first"))
    met = made.join(sized(needed), same)
    return materialize(met.groupBy("node").agg(F.first("elements").alias("elements")))


def _confirmed(pairs: DataFrame, elements: DataFrame, rules: MinHashRules) -> DataFrame:
    """The pairs whose full sets are alike enough."""
    of_b = elements.select(F.col("node").alias("b"), F.col("elements").alias("of_b")).hint("merge")
    of_a = elements.select(F.col("node").alias("a"), F.col("elements").alias("of_a")).hint("merge")
    shared = F.size(F.array_intersect("of_a", "of_b"))
    found = pairs.join(of_b, "b").join(of_a, "a")
    found = found.select("a", "b", shared.alias("shared"), (F.size("of_a") + F.size("of_b")).alias("total"))
    return materialize(found.filter(F.lit(100) * F.col("shared") >= F.lit(rules.percent) * (F.col("total") - F.col("shared"))).select("a", "b"))


class _Block:
    """Members of one or two blocks of a group, and which of their components have been joined so far."""

    def __init__(self, rows: list[pa.RecordBatch], rules: MinHashRules):
        table = pa.Table.from_batches(rows).combine_chunks()
        self.rules, self.steps, self.key = rules, _steps(rules), table.column("key")[0].as_py()
        self.own, self.node, self.root = (table.column(c).to_numpy() for c in ("own", "node", "root"))
        self.across = table.column("lo")[0].as_py() != table.column("hi")[0].as_py()
        self.marks = _matrix(table.column("signature").combine_chunks(), rules.values)
        self.bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(len(self.node), rules.bands)
        lists = table.column("elements").combine_chunks()
        self.elements, self.starts = lists.flatten().to_numpy().view(np.uint64), np.append(0, np.cumsum(lists.value_lengths().to_numpy()))

    def links(self) -> pa.RecordBatch:
        found = [link for i in range(len(self.node) - 1) for link in self._links_of(i)]
        ends = [pa.array([link[i] for link in found], pa.int64()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    def _links_of(self, i: int) -> Iterator[tuple[int, int]]:
        """Links of member ``i`` to later ones that join two components."""
        sizes = np.diff(self.starts)
        others = np.arange(i + 1, len(self.node))
        apart = (self.root[others] != self.root[i]) & ((self.own[others] != self.own[i]) | (not self.across))
        # sets of too different sizes cannot be alike
        apart &= 100 * np.minimum(sizes[others], sizes[i]) >= self.rules.percent * np.maximum(sizes[others], sizes[i])
        others = others[apart]
        others = others[survivors(np.broadcast_to(self.marks[i], (len(others), self.rules.values)), self.marks[others], self.steps)]
        shared = self.bands[others] == self.bands[i]
        others = others[self.bands[others, shared.argmax(axis=1)] == self.key]
        if not len(others):
            return
        mine = self.elements[self.starts[i] : self.starts[i + 1]]
        theirs = np.concatenate([self.elements[self.starts[j] : self.starts[j + 1]] for j in others])
        hits = mine[np.minimum(np.searchsorted(mine, theirs), len(mine) - 1)] == theirs
        common = np.add.reduceat(hits.astype(np.int64), np.append(0, np.cumsum(sizes[others])[:-1]))
        linked = 100 * common >= self.rules.percent * (sizes[i] + sizes[others] - common)
        for j in others[linked]:
            if self.root[j] != self.root[i]:
                self.root = np.where(self.root == self.root[j], self.root[i], self.root)
                yield int(min(self.node[i], self.node[j])), int(max(self.node[i], self.node[j]))


def _block_links(members: DataFrame, rules: MinHashRules) -> DataFrame:
    """Links (a, b) that join different roots inside a group, (key, n, node, root, signature, bands, elements).

    Every member goes to each pair of blocks its own belongs to; the rows of a
    pair of blocks are neighbours in one task.
    """
    blocks = F.ceil(F.col("n") / rules.block)
    own = F.pmod(F.xxhash64("node"), blocks)
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)))
    dealt = dealt.withColumns({"lo": F.least("own", "other"), "hi": F.greatest("own", "other")})
    columns = ["key", "lo", "hi", "own", "node", "root", "signature", "bands", "elements"]
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.select(*columns).repartition(tasks, "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, now = [], None
        for batch in batches:
            names = np.stack([batch.column(c).to_numpy() for c in ("key", "lo", "hi")], axis=1)
            cuts = np.flatnonzero((names[1:] != names[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(names)], strict=True):
                if start == stop:
                    continue
                name = tuple(names[start])
                if rows and name != now:
                    yield _Block(rows, rules).links()
                    rows = []
                now = name
                rows.append(batch.slice(start, stop - start))
        if rows:
            yield _Block(rows, rules).links()

    return dealt.mapInArrow(run, "a bigint, b bigint")


def links(docs: DataFrame, sets: DataFrame, rules: MinHashRules, *columns: str) -> DataFrame:
    """Edges (a, b) between nodes whose sets are alike enough, enough to connect all that are linked."""
    members = _members(sets)
    elements = _elements(docs, sets, members, rules, *columns)
    ends = [members.select(F.least("node", p).alias("a"), F.greatest("node", p).alias("b")) for p in ("least", "most")]
    stars = materialize(ends[0].union(ends[1]).filter("a < b").distinct())
    edges = _confirmed(materialize(_likely(stars, sets, rules)), elements, rules)

    roots = components(edges).withColumnRenamed("node", "moved")
    larger = members.filter("n > 2").join(roots.hint("merge"), F.col("node") == F.col("moved"), "left")
    placed = materialize(larger.select("key", "n", "node", F.coalesce("root", "node").alias("root")))
    spread = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    unsettled = materialize(placed.join(sized(materialize(spread.select("key"))), "key"))
    marked = unsettled.join(sets.select("node", "signature", "bands").hint("merge"), "node")
    marked = marked.join(elements.hint("merge"), "node")
    return edges.union(materialize(_block_links(marked, rules).distinct()))


def near_duplicates(
    docs: DataFrame, rules: MinHashRules = MinHashRules(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    component_id is the smallest doc_id reachable over links, the row's own
    included; kept says that it is the row's own (or that there is none).
    """
    own = materialize(profiles(docs, rules, id_column, text_column))
    sets = _sets(own)
    roots = components(links(docs, sets, rules, id_column, text_column))
    # a root is in no row of its own
    linked = materialize(roots.union(roots.select("root", "root")).distinct())
    firsts = sets.select("node", "first")
    named = materialize(linked.join(firsts, "node").groupBy("root").agg(F.min("first").alias("component")))
    moved = linked.join(named, "root").select("node", "component", F.lit(True).alias("is_linked"))
    component = F.when(F.col("is_linked"), F.col("component")).otherwise(F.col("first"))
    names = materialize(sets.select("node", "set", "first").join(moved, "node", "left").select("set", component.alias("component_id")))
    filled = own.filter("set is not null").join(names, "set").select("doc_id", "n_shingles", "component_id")
    empty = own.filter("set is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return filled.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
