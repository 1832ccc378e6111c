"""Quality rules by repetition coverage.

For every text the share of characters that lie inside repeated word n-grams
of several lengths, and inside repeated lines, is measured with rolling hashes
in numpy. One narrow pass; nothing is shuffled.

Null and empty texts have no words and fail the base rule. Repeated rows are
judged alike, each by itself. Other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sievewright.llm.common import as_bytes, bound_batches, map_texts, texts_of

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class RepetitionRules:
    """Limits in percent of the characters that stand in words.

    They fall with the length of the n-gram, as a repeated long one is the surer
    sign; those of published rules for web corpora.
    """

    min_words: int = 50
    max_repeat_words: int = 50
    ngram_limits: tuple[tuple[int, int], ...] = ((5, 15), (7, 13), (10, 10))
    max_line_characters: int = 20


RULES = RepetitionRules()


def _repeated(codes: np.ndarray) -> np.ndarray:
    """True where a value occurs twice or more."""
    found = np.zeros(len(codes), bool)
    if len(codes) < 2:
        return found
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """True for the words inside n-grams that begin at ``starts``."""
    edges = np.zeros(n + 1, np.int32)
    edges[starts] += 1
    edges[starts + length] -= 1
    return np.cumsum(edges[:n]) > 0


def measure(data: bytes | None, lengths: tuple[int, ...]) -> list[int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line characters, then characters per length."""
    data = data or b""
    raw = np.frombuffer(data, np.uint8)
    space = _SPACE[raw]
    character = (raw & 0xC0) != 0x80
    character &= ~space
    word_chars = int(character.sum())
    words = data.split()
    n = len(words)
    dup_lines = line_chars = 0
    seen: set[bytes] = set()
    at = 0
    for line in data.split(b"\n"):
        end = at + len(line)
        if line in seen:
            dup_lines += 1
            line_chars += int(character[at:end].sum())
        elif line.strip():
            seen.add(line)
        at = end + 1
    repeat_words = 0
    inside = dict.fromkeys(lengths, 0)
    if n >= 3:
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = np.fromiter(map(number.__getitem__, words), np.int64, n)
        size = len(number)
        # exact codes of 3-word windows; a product that could overflow is ranked first
        pairs = ids[:-1] * size + ids[1:]
        if size > 2_000_000:
            pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        three = _repeated(pairs[: n - 2] * size + ids[2:])
        starts = np.flatnonzero(three)
        if len(starts):
            repeat_words = int(_covered(starts, 3, n).sum())
            opened = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
            chars = np.add.reduceat(character.astype(np.int64), opened)
            mixed = (ids.astype(np.uint64) + np.uint64(1)) * _STEP
            mixed ^= mixed >> np.uint64(29)
            for length in lengths:
                # a repeated n-gram begins with repeated 3-word windows all along
                m = n - length + 1
                if m < 2:
                    continue
                whole = np.ones(m, bool)
                for i in range(length - 2):
                    whole &= three[i : i + m]
                candidates = np.flatnonzero(whole)
                if len(candidates) < 2:
                    continue
                rolling = mixed[candidates]
                for i in range(1, length):
                    rolling = rolling * _BASE + mixed[candidates + i]
                starts = candidates[_repeated(rolling)]
                if len(starts):
                    inside[length] = int(chars[_covered(starts, length, n)].sum())
    return [n, word_chars, int(_SYMBOL[raw].sum()), dup_lines, repeat_words, line_chars, *inside.values()]


def _verdicts(texts: list[bytes | None], rules: RepetitionRules) -> list[list]:
    lengths = tuple(length for length, _ in rules.ngram_limits)
    rows = [measure(t, lengths) for t in texts]
    columns = [list(c) for c in zip(*rows, strict=True)] if rows else [[] for _ in range(6 + len(lengths))]
    failed, kept = [], []
    for n, chars, _, _, repeated, in_lines, *inside in rows:
        bad = n < rules.min_words or 100 * repeated > rules.max_repeat_words * n
        over = 100 * in_lines > rules.max_line_characters * chars
        over = over or any(100 * x > most * chars for x, (_, most) in zip(inside, rules.ngram_limits, strict=True))
        failed.append(bad)
        kept.append(not bad and not over)
    return [*columns, failed, kept]


def judge(docs: DataFrame, rules: RepetitionRules = RULES, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: the measures, ``base_failed`` and ``kept``."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars"]
    names += [f"dup_chars_{length}" for length, _ in rules.ngram_limits]
    schema = ", ".join([*(f"{c} long" for c in names), "base_failed boolean", "kept boolean"])
    return map_texts(texts_of(docs, id_column, text_column), lambda texts: _verdicts(texts, rules), schema)


def keep(docs: DataFrame, rules: RepetitionRules = RULES, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns as they are."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = _verdicts(as_bytes(batch.column(text_column)), rules)[-1]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
