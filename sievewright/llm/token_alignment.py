"""Alignment of two tokenizers' tokens over the bytes of the same texts.

Both vocabularies cut a text's bytes. Where a token of A and one of B end
together, a group ends, and those two tokens are linked. How often every pair
of ids is linked is counted over all documents, and every document is told how
many of its links have the count that is its B id's highest, and their sum.

Most groups are one token of A and the one of B with the same bytes. An array
from A ids to B ids, made from the vocabularies alone, recognises them; they
are kept as A ids and counted in vectors as long as the vocabulary. Only other
links are kept as pairs and enter the shuffle of pairs, added up per task
first. Texts are encoded once: their links are written as numbers, which
counting and scoring read.

Counts of the regular links and the highest count of every B id fit vectors of
the vocabularies' lengths. Of the other pairs the ``frequent`` most frequent
at most, by a cut in their counts, go to all tasks; a document's other pairs
meet their counts in a join, where no key is hot, as each has a count below
the cut.

Defined results: texts that are null or empty, are no valid UTF-8, or whose
tokens' bytes of A or B differ from a space and the text (U+2581, which stands
for a space in B) have no tokens, groups or links. Texts are encoded whole; a
task holds the tokens of one text, or of texts of ``part`` bytes together.
Null and repeated ids and repeated rows are documents like any other. Tied
counts are all highest. Other columns play no part and may have any names. An
empty table gives an empty result. The tokenizer files must lie under the same
path on all machines.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import as_bytes, materialize, sized, texts_of

# Fixed value: the pattern by which byte-level vocabularies of this kind split texts.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LONG_RUN = 2000
_BLANKS = re.compile(r"\s{%d}" % _LONG_RUN)


@dataclass(frozen=True)
class AlignmentRules:
    folder: str = "/opt/tokenizers"
    a: str = "byte_bpe_50k.json"
    b: str = "piece_bpe_32k.model"
    frequent: int = 1 << 18  # irregular pairs that go to all tasks, at most
    part: int = 1 << 18  # bytes of texts encoded at a time


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable Latin-1 as itself, the rest from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabularies:
    """Both tokenizers, the bytes of their ids, and the B id with the bytes of each A id (-1: none)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        special = {token.content for token in self.a.get_added_tokens_decoder().values()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters, vocabulary = byte_letters(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, number in vocabulary.items():
            self.a_bytes[number] = bytes(letters[c] for c in entry)
        # the same vocabulary, splitting pattern and merges in a faster implementation
        ranks = {bytes(letters[c] for c in entry): number for entry, number in vocabulary.items() if entry not in special}
        self.fast = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]
        self.a_lengths, self.b_lengths = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        # of several B ids with the same bytes one is regular; the others are irregular pairs
        by_bytes = {x: i for i, x in enumerate(self.b_bytes)}
        self.same = np.array([by_bytes.get(x, -1) for x in self.a_bytes], np.int64)
        self.id_type = np.uint16 if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else np.uint32
        self._a_inner, self._a_last = self._texts(len(self.a_bytes), b",", b"|")
        self._b_inner, self._b_last = self._texts(len(self.b_bytes), b",", b";")

    @staticmethod
    def _texts(n: int, *ends: bytes) -> list[np.ndarray]:
        return [np.array([b"%d%s" % (i, end) for i in range(n)], object) for end in ends]

    def a_ids(self, text: str) -> list[int]:
        """Ids of A. Very long runs, on which the fast implementation may fail, go to the other one."""
        if max(map(len, text.split()), default=0) < _LONG_RUN and not _BLANKS.search(text):
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        theirs = self.b.encode(texts, num_threads=1)
        for text, b in zip(texts, theirs, strict=True):
            a, full = self.a_ids(" " + text), b" " + text.encode()
            whole = b"".join(map(self.a_bytes.__getitem__, a)) == full == b"".join(map(self.b_bytes.__getitem__, b))
            yield (np.array(a, np.int64), np.array(b, np.int64)) if whole else (np.zeros(0, np.int64),) * 2

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places in ``a`` and in ``b`` of the tokens that end together."""
        a_ends, b_ends = np.cumsum(self.a_lengths[a]), np.cumsum(self.b_lengths[b])
        at = np.searchsorted(b_ends, a_ends)
        together = np.flatnonzero(b_ends[at] == a_ends)  # both end with the text, so every place is in range
        return together, at[together]

    def groups_text(self, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> bytes:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        a_sizes, b_sizes = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
        parts = np.empty(len(a) + len(b), object)
        # tokens stand behind all those of earlier groups, and those of B behind their group's of A
        a_places = np.arange(len(a)) + np.repeat(b_last + 1 - b_sizes, a_sizes)
        b_places = np.arange(len(b)) + np.repeat(a_last + 1, b_sizes)
        parts[a_places], parts[b_places] = self._a_inner[a], self._b_inner[b]
        parts[a_places[a_last]], parts[b_places[b_last]] = self._a_last[a[a_last]], self._b_last[b[b_last]]
        return b"".join(parts.tolist())[:-1]


@functools.lru_cache(maxsize=1)
def _vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(a_path, b_path)


def vocabularies(rules: AlignmentRules) -> Vocabularies:
    return _vocabularies(f"{rules.folder}/{rules.a}", f"{rules.folder}/{rules.b}")


def _parts(texts: list[bytes | None], most: int) -> Iterator[list[tuple[int, str]]]:
    """Numbered texts, together of about ``most`` bytes; null, empty and broken ones are left out."""
    held, size = [], 0
    for i, data in enumerate(texts):
        if not data:
            continue
        try:
            held.append((i, data.decode()))
        except UnicodeDecodeError:
            continue
        size += len(data)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def aligned(docs: DataFrame, rules: AlignmentRules, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, groups_sha256, same, odd) of every row of ``docs``, written.

    ``same`` holds the A ids of the regular links and ``odd`` the ids of the
    other ones, A and B in turn.
    """
    texts = texts_of(docs, id_column, text_column)
    counts = ["n_a", "n_b", "n_groups"]
    schema = f"doc_id {dict(texts.dtypes)['doc_id']}, {', '.join(f'{c} bigint' for c in counts)}, groups_sha256 string, same binary, odd binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = vocabularies(rules)
        for batch in batches:
            rows: list[tuple] = [(0, 0, 0, "", b"", b"")] * batch.num_rows
            for part in _parts(as_bytes(batch.column("text")), rules.part):
                for (i, _), (a, b) in zip(part, both.encode([t for _, t in part]), strict=True):
                    if not len(a):
                        continue
                    a_last, b_last = both.align(a, b)
                    links = np.stack([a[a_last], b[b_last]], axis=1)
                    # a regular link's tokens have the same bytes, so they are their whole group
                    regular = both.same[links[:, 0]] == links[:, 1]
                    digest = hashlib.sha256(both.groups_text(a, b, a_last, b_last)).hexdigest()
                    same, odd = links[regular, 0].astype(both.id_type), links[~regular].astype(both.id_type)
                    rows[i] = (len(a), len(b), len(links), digest, same.tobytes(), odd.tobytes())
            types = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * 2
            made = [pa.array(column, t) for column, t in zip(zip(*rows, strict=True), types, strict=True)] if rows else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], names=["doc_id", *counts, "groups_sha256", "same", "odd"])

    return materialize(texts.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()))


def _joined(column: pa.Array, id_type: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), id_type).astype(np.int64)


def regular_counts(links: DataFrame, both: Vocabularies) -> np.ndarray:
    """How often every A id is linked to the B id of the same bytes."""
    id_type, size = both.id_type, len(both.a_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(size, np.int64)
        for batch in batches:
            totals += np.bincount(_joined(batch.column("same"), id_type), minlength=size)
        seen = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(totals[seen])], names=["a", "n"])

    counted = links.select("same").mapInArrow(run, "a bigint, n bigint").groupBy("a").agg(F.sum("n").alias("n"))
    totals = np.zeros(size, np.int64)
    for a, n in counted.collect():  # one row per id of the vocabulary at most
        totals[a] = n
    return totals


def irregular_counts(links: DataFrame, both: Vocabularies) -> DataFrame:
    """(pair, b, n): how often the ids of every other pair are linked; ``pair`` is a * (B's size) + b. Written."""
    id_type, width = both.id_type, len(both.b_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            ids = _joined(batch.column("odd"), id_type).reshape(-1, 2)
            new, times = np.unique(ids[:, 0] * width + ids[:, 1], return_counts=True)
            pairs, place = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, times]), len(pairs)).astype(np.int64)
            if len(pairs) > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])
                pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    counted = links.select("odd").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    return materialize(counted.select("pair", (F.col("pair") % width).alias("b"), "n"))


def _highest(regular: np.ndarray, irregular: DataFrame, both: Vocabularies) -> np.ndarray:
    """The highest count of every B id."""
    most = np.zeros(len(both.b_bytes), np.int64)
    has = both.same >= 0
    np.maximum.at(most, both.same[has], regular[has])
    for b, n in irregular.groupBy("b").agg(F.max("n").alias("n")).collect():  # one row per id of the vocabulary at most
        most[b] = max(most[b], n)
    return most


def _cut(irregular: DataFrame, most: int) -> int:
    """The least power of two such that at most ``most`` pairs have a count of at least that."""
    sizes = irregular.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count("*").alias("pairs")).collect()
    at_least, cut = 0, (1 << 63) - 1  # no count is larger
    for bits, pairs in sorted(map(tuple, sizes), reverse=True):
        at_least += pairs
        if at_least > most:
            break
        cut = 1 << (bits - 1)
    return cut


def link_scores(links: DataFrame, both: Vocabularies, regular: np.ndarray, irregular: DataFrame, rules: AlignmentRules) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``links``."""
    spark, id_type, width = links.sparkSession, both.id_type, len(both.b_bytes)
    most, cut = _highest(regular, irregular, both), _cut(irregular, rules.frequent)
    chosen = irregular.filter(F.col("n") >= cut).orderBy("pair").toArrow()  # bounded by ``frequent``
    pairs, counts = (chosen.column(c).to_numpy().astype(np.int64) for c in ("pair", "n"))
    regular_best = (regular == most[both.same]) & (both.same >= 0)
    sent = spark.sparkContext.broadcast((regular, regular_best, pairs, counts, counts == most[pairs % width]))
    kept = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    types = dict(links.dtypes)
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", best bigint, total bigint, rare array<bigint>, times array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        regular, regular_best, pairs, counts, pair_best = sent.value
        for batch in batches:
            rows = []
            for same, odd in zip(batch.column("same").to_pylist(), batch.column("odd").to_pylist(), strict=True):
                a = np.frombuffer(same, id_type)
                ids = np.frombuffer(odd, id_type).astype(np.int64).reshape(-1, 2)
                keys = ids[:, 0] * width + ids[:, 1]
                at = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
                known = pairs[at] == keys if len(pairs) else np.zeros(len(keys), bool)
                at = at[known]
                rare, times = np.unique(keys[~known], return_counts=True)
                best = int(regular_best[a].sum()) + int(pair_best[at].sum())
                rows.append((best, int(regular[a].sum()) + int(counts[at].sum()), rare, times))
            lists = pa.list_(pa.int64())
            made = [pa.array([r[i] for r in rows], t) for i, t in enumerate([pa.int64(), pa.int64(), lists, lists])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *made], names=[*kept, "best", "total", "rare", "times"])

    scored = materialize(links.select(*kept, "same", "odd").mapInArrow(run, schema))
    # highest counts of rare pairs, one row per B id at most
    highest = spark.createDataFrame([(int(b), int(most[b])) for b in np.flatnonzero(most)], "b int, highest bigint")
    rare = irregular.filter(F.col("n") < cut).join(F.broadcast(highest), "b")
    rare = rare.select("pair", "n", (F.col("n") == F.col("highest")).cast("bigint").alias("is_best"))
    asked = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("pair"), "x.times")
    met = asked.join(rare.hint("merge"), "pair").groupBy("row")
    found = met.agg(F.sum(F.col("times") * F.col("is_best")).alias("rare_best"), F.sum(F.col("times") * F.col("n")).alias("rare_total"))
    whole = scored.drop("rare", "times").join(sized(materialize(found)), "row", "left")
    return whole.select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        (F.col("best") + F.coalesce("rare_best", F.lit(0))).alias("n_best"),
        (F.col("total") + F.coalesce("rare_total", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


def align_tokenizers(
    docs: DataFrame, rules: AlignmentRules = AlignmentRules(), id_column: str = "doc_id", text_column: str = "text"
) -> tuple[DataFrame, np.ndarray, DataFrame]:
    """The scores of every row of ``docs``, the counts of regular links by A id, and the table of the other pairs."""
    both = vocabularies(rules)
    links = aligned(docs, rules, id_column, text_column)
    regular, irregular = regular_counts(links, both), irregular_counts(links, both)
    return link_scores(links, both, regular, irregular, rules), regular, irregular
