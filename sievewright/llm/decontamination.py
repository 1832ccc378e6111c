"""Benchmark decontamination by latent semantic retrieval.

The benchmark is the query set. It is searched in blocks of bounded size, each
against all documents:

1. The block's words are the vocabulary. Their frequencies over all passages
   (64 words) of all documents give the inverse document frequencies.
2. A randomised SVD of TF-IDF passages gives the latent space. Tasks sketch
   their passages with one Gaussian test matrix, the sketches are summed by
   term, and the singular vectors follow from the sum (Nystroem form). The
   passages are all items of the block and those of all documents.
3. Windows of every document are projected by differences of running sums and
   compared with the items by cosine. Windows overlap so that any span as long
   as an item lies inside one.
4. A candidate counts if the longest common subsequence of item and window has
   at least ``copied`` of the item's words, or ``paraphrased`` of them and the
   item's answer (what follows its last question mark, else its last sentence)
   word for word.

Documents are never shuffled. Null and empty texts and items have no words and
match nothing; punctuation and A-Z case are ignored. Repeated rows are judged
each by itself. An empty benchmark finds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sievewright.llm.common import as_bytes, texts_of

_LOWER = bytes(ord(" ") if chr(i) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" else i for i in range(256)).lower()


@dataclass(frozen=True)
class LeakRules:
    passage_words: int = 64
    latent: int = 64
    block_items: int = 2000
    cosine: float = 0.35
    projection: float = 0.5
    copied: float = 0.8
    paraphrased: float = 0.6
    seed: int = 7


RULES = LeakRules()
#: Words projected at a time; a multiple of every block of a span.
_CHUNK = 1 << 13
#: Passages sketched at a time; their rows of the test matrix stay in the cache.
_PASSAGES = 256


def words_of(data: bytes | None) -> list[bytes]:
    return (data or b"").translate(_LOWER).split()


def answer_of(text: str) -> list[bytes]:
    tail = text.rstrip().rpartition("?")[2]
    if not words_of(tail.encode()) or "?" not in text:
        tail = re.split(r"[.!?\n](?:\s|$)", text.rstrip().rstrip(".!?"))[-1]
    return words_of(tail.encode())


class Block:
    """A bounded set of items: its vocabulary, and per item its id, word numbers and answer."""

    def __init__(self, items: list[tuple[int, str]]):
        self.words: dict[bytes, int] = {}
        self.items = []
        for item, text in items:
            own = [self.words.setdefault(w, len(self.words)) for w in words_of((text or "").encode())]
            if own:
                answer = [self.words[w] for w in answer_of(text)]
                self.items.append((item, own, answer))

    def encode(self, data: bytes | None) -> np.ndarray:
        """The vocabulary number of every word, -1 for others."""
        words, get = words_of(data), self.words.get
        return np.array([get(w, -1) for w in words], np.int32)


def _passage_terms(coded: list[np.ndarray], size: int, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Passage, term and count of every pair that occurs, by passage; the number of passages."""
    keys, first = [], 0
    for ids in coded:
        at = np.flatnonzero(ids >= 0)
        keys.append((first + at // size) * terms + ids[at])
        first += -(-len(ids) // size)
    key, count = np.unique(np.concatenate(keys) if keys else np.zeros(0, np.int64), return_counts=True)
    return key // terms, key % terms, count, first


def _frequencies(texts: DataFrame, block: Block, rules: LeakRules) -> tuple[np.ndarray, int]:
    """Passages with each term, and all passages (term -1), over all documents."""
    shared = texts.sparkSession.sparkContext.broadcast(block)
    size = rules.passage_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total, passages = shared.value, None, 0
        total = np.zeros(len(block.words), np.int64)
        for batch in batches:
            coded = [block.encode(t) for t in as_bytes(batch.column("text"))]
            _, term, _, n = _passage_terms(coded, size, len(total))
            total += np.bincount(term, minlength=len(total))
            passages += n
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *found.tolist()], pa.int32()), pa.array([passages, *total[found].tolist()], pa.int64())],
            names=["term", "n"],
        )

    counted = texts.select("text").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = np.zeros(len(block.words), np.int64)
    passages = 0
    for term, n in counted.collect():  # a row per term of the block
        if term < 0:
            passages = n
        else:
            found[term] = n
    shared.unpersist()
    return found, passages


def _sketch_rows(coded: list[np.ndarray], rules: LeakRules, idf: np.ndarray, test: np.ndarray) -> np.ndarray:
    """AᵀA times the test matrix, for the passages of ``coded``; rows of A have length 1."""
    passage, term, count, _ = _passage_terms(coded, rules.passage_words, len(idf))
    total = np.zeros_like(test)
    if not len(term):
        return total
    value = count * idf[term]
    starts = np.flatnonzero(np.concatenate(([True], passage[1:] != passage[:-1])))
    terms = np.diff(np.append(starts, len(term)))
    value /= np.repeat(np.sqrt(np.add.reduceat(value * value, starts)), terms)
    for at in range(0, len(starts), _PASSAGES):
        first = starts[at : at + _PASSAGES]
        part = slice(first[0], first[-1] + terms[at + len(first) - 1])
        rows = test[term[part]]
        rows *= value[part, None]
        projected = np.add.reduceat(rows, first - first[0])
        order = np.argsort(term[part], kind="stable")
        rows = projected[np.repeat(np.arange(len(first)), terms[at : at + _PASSAGES])[order]]
        rows *= value[part][order, None]
        ranked = term[part][order]
        firsts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        total[ranked[firsts]] += np.add.reduceat(rows, firsts)
    return total


def _latent_space(texts: DataFrame, block: Block, idf: np.ndarray, rules: LeakRules) -> np.ndarray:
    """The leading right singular vectors of the TF-IDF passages, a row per term."""
    terms = len(idf)
    width = min(terms, rules.latent + 8)
    test = np.random.default_rng(rules.seed).standard_normal((terms, width))
    shared = texts.sparkSession.sparkContext.broadcast((block, idf, test))
    columns = [f"c{i}" for i in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, idf, test = shared.value
        total = np.zeros_like(test)
        for batch in batches:
            total += _sketch_rows([block.encode(t) for t in as_bytes(batch.column("text"))], rules, idf, test)
        found = np.flatnonzero(np.abs(total).sum(axis=1))
        arrays = [pa.array(found, pa.int32()), *(pa.array(total[found, i]) for i in range(width))]
        yield pa.RecordBatch.from_arrays(arrays, names=["term", *columns])

    schema = ", ".join(["term int", *(f"{c} double" for c in columns)])
    summed = texts.select("text").mapInArrow(run, schema).groupBy("term").agg(*[F.sum(c).alias(c) for c in columns])
    corpus = np.zeros_like(test)
    for term, *values in summed.collect():  # a row per term of the block
        corpus[term] = values
    shared.unpersist()
    own = _sketch_rows([np.array(ids, np.int32) for _, ids, _ in block.items], rules, idf, test)
    # items and corpus weigh the same, else a large corpus would leave no dimension to the items
    weight = np.linalg.norm(corpus) / max(np.linalg.norm(own), 1e-12) if corpus.any() else 1.0
    sketch = corpus + weight * own
    shift = 1e-8 * max(np.linalg.norm(sketch), 1e-12)
    shifted = sketch + shift * test
    core = test.T @ shifted
    root = np.linalg.cholesky((core + core.T) / 2 + shift * np.eye(width))
    vectors, _, _ = np.linalg.svd(np.linalg.solve(root, shifted.T).T, full_matrices=False)
    return vectors[:, : rules.latent]


def common_length(item: list[int], window: list[int]) -> int:
    """Length of the longest common subsequence, a machine word of the item per step."""
    places: dict[int, int] = {}
    for i, w in enumerate(item):
        places[w] = places.get(w, 0) | 1 << i
    row = all_ones = (1 << len(item)) - 1
    for w in window:
        if here := places.get(w):
            both = row & here
            row = (row + both) | (row - both)
            row &= all_ones
    return len(item) - row.bit_count()


def _contains(window: list[int], part: list[int]) -> bool:
    n = len(part)
    return n > 0 and any(window[i : i + n] == part for i in range(len(window) - n + 1) if window[i] == part[0])


class Searcher:
    """Finds the items of a block in coded texts."""

    def __init__(self, block: Block, idf: np.ndarray, vectors: np.ndarray, rules: LeakRules):
        self.block, self.rules = block, rules
        self.terms = np.vstack((idf[:, None] * vectors, np.zeros((1, vectors.shape[1])))).astype(np.float32)
        self.sets = [frozenset(ids) for _, ids, _ in block.items]
        # items by the power of two that holds them: (span, numbers of the items, latent vectors, lengths)
        spans: dict[int, list[int]] = {}
        for i, (_, ids, _) in enumerate(block.items):
            spans.setdefault(max(8, 1 << (len(ids) - 1).bit_length()), []).append(i)
        self.spans = []
        for span, members in sorted(spans.items()):
            latent = np.stack([self.terms[block.items[i][1]].sum(axis=0) for i in members])
            self.spans.append((span, np.array(members), latent, np.maximum(np.linalg.norm(latent, axis=1), 1e-9)))
        self.gap = 2 * max(spans, default=8)

    def candidates(self, ids: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(first word, end, item) of windows close to an item in the latent space.

        A window is three blocks of half a span and begins at every block; the
        blocks of a span are pairs of blocks of the span below.
        """
        finest = self.spans[0][0] // 2
        for low in range(0, len(ids), _CHUNK):
            # what windows that begin in this chunk reach beyond it
            part = ids[low : low + _CHUNK + self.gap]
            rows = -(-len(part) // finest)
            padded = np.full(rows * finest, -1, np.int32)
            padded[: len(part)] = part
            # -1 is the last row, which is zero
            sums, half = self.terms[padded].reshape(rows, finest, -1).sum(axis=1), finest
            for span, members, latent, length in self.spans:
                while half < span // 2:
                    if len(sums) % 2:
                        sums = np.vstack((sums, np.zeros_like(sums[:1])))
                    sums, half = sums[::2] + sums[1::2], 2 * half
                n = -(-min(_CHUNK, len(ids) - low) // half)
                blocks = np.vstack((sums, np.zeros((2, sums.shape[1]), np.float32)))
                windows = blocks[:n] + blocks[1 : n + 1] + blocks[2 : n + 2]
                norm = np.linalg.norm(windows, axis=1)
                dots = windows @ latent.T
                near = dots >= self.rules.cosine * norm[:, None] * length
                near &= dots >= self.rules.projection * length * length
                for w, j in zip(*np.nonzero(near), strict=True):
                    first = low + int(w) * half
                    yield first, first + 3 * half, int(members[j])

    def verify(self, window: list[int], number: int) -> tuple[int, bool] | None:
        """Common words and whether the answer is there; None for no match."""
        _, ids, answer = self.block.items[number]
        if sum(map(self.sets[number].__contains__, window)) < self.rules.paraphrased * len(ids):
            return None
        common = common_length(ids, window)
        if common < self.rules.paraphrased * len(ids):
            return None
        answered = _contains(window, answer)
        return (common, answered) if answered or common >= self.rules.copied * len(ids) else None

    def search(self, texts: list[bytes | None]) -> list[dict[int, tuple[int, bool]]]:
        """Per text: item number to its best match."""
        found: list[dict[int, tuple[int, bool]]] = [{} for _ in texts]
        coded, firsts, at = [], [], 0
        gap = np.full(self.gap, -1, np.int32)
        for t in texts:  # one long row of words, with gaps that no window crosses
            ids = self.block.encode(t)
            firsts.append(at)
            coded += [ids, gap]
            at += len(ids) + self.gap
        if not coded or not self.spans:
            return found
        row, begins = np.concatenate(coded), np.array(firsts)
        for first, end, number in self.candidates(row):
            window = row[first:end]
            inside = np.flatnonzero(window >= 0)
            matched = self.verify(window.tolist(), number)
            if matched:
                text = int(np.searchsorted(begins, first + int(inside[0]), side="right")) - 1
                found[text][number] = max(matched, found[text].get(number, matched))
        return found


def searchers(docs: DataFrame, benchmark: DataFrame, rules: LeakRules = RULES) -> Iterator:
    """A broadcast searcher per block of items; reads ``docs`` (doc_id, text) for the statistics of each."""
    # repeated items are one: all of them would fall into one block
    items = benchmark.select(F.col("item_id"), F.col("text")).filter(F.col("text").isNotNull()).distinct()
    blocks = -(-items.count() // rules.block_items)
    number = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))
    for i in range(blocks):
        rows = items.filter(number == i).orderBy("item_id", "text").collect()  # a block, bounded by block_items
        block = Block([(r.item_id, r.text) for r in rows])
        if block.items:
            frequency, passages = _frequencies(docs, block, rules)
            idf = np.log1p((passages - frequency + 0.5) / (frequency + 0.5))
            searcher = Searcher(block, idf, _latent_space(docs, block, idf, rules), rules)
            yield docs.sparkSession.sparkContext.broadcast(searcher)


def leaks(docs: DataFrame, benchmark: DataFrame, rules: LeakRules = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, item_id, item_words, common_words, answered) for every item found in a document."""
    texts = texts_of(docs, id_column, text_column)
    kind = dict(texts.dtypes)["doc_id"]
    item_kind, item_type = dict(benchmark.dtypes)["item_id"], to_arrow_type(benchmark.schema["item_id"].dataType)
    schema = f"doc_id {kind}, item_id {item_kind}, item_words long, common_words long, answered boolean"
    found = None
    for shared in searchers(texts, benchmark, rules):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            searcher = shared.value
            for batch in batches:
                rows = [
                    (i, *searcher.block.items[k][:2], *match)
                    for i, matches in enumerate(searcher.search(as_bytes(batch.column("text"))))
                    for k, match in sorted(matches.items())
                ]
                ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                if not rows:
                    continue
                item = pa.array([r[1] for r in rows], item_type)
                words, common = [len(r[2]) for r in rows], [r[3] for r in rows]
                arrays = [ids, item, pa.array(words, pa.int64()), pa.array(common, pa.int64()), pa.array([r[4] for r in rows])]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "item_id", "item_words", "common_words", "answered"])

        part = texts.mapInArrow(run, schema)
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def clean(docs: DataFrame, benchmark: DataFrame, rules: LeakRules = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no item was found, with all their columns as they are."""
    kept = docs
    for shared in searchers(texts_of(docs, id_column, text_column), benchmark, rules):

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = shared.value.search(as_bytes(batch.column(text_column)))
                yield batch.filter(pa.array([not x for x in found], pa.bool_()))

        kept = kept.mapInArrow(run, docs.schema)
    return kept
