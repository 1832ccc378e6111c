"""Quality by compression: which of two zstandard dictionaries shortens a text more.

One dictionary is built from texts labelled good, one from texts labelled bad.
A text is compressed in pieces with each; the difference of the compressed
sizes, divided by the size of the text, becomes a score by logistic
calibration on labelled texts that are in no dictionary.

Learned from a bounded sample (``per_class`` labelled ids each, at most
``pieces`` pieces of a text for a dictionary); every text is scored whole, by
itself, in a narrow pass. Null and empty texts have difference 0. Labels other
than 0 and 1 are not used; without both labels every score is the share of the
label seen (0.5 if none). Repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import as_bytes, map_texts, texts_of
from sievewright.llm.sampling import pick, picked_texts


@dataclass(frozen=True)
class CompressionRules:
    per_class: int = 3000
    piece_bytes: int = 512
    pieces: int = 8
    dictionary_bytes: int = 1 << 16
    level: int = 3


RULES = CompressionRules()


@dataclass(frozen=True)
class Model:
    """Dictionaries and calibration; plain bytes and numbers, small enough for every task."""

    good: bytes
    bad: bytes
    slope: float
    offset: float
    rules: CompressionRules


class Compressor:
    def __init__(self, model: Model):
        self.piece = model.rules.piece_bytes
        self.sides = []
        for data in (model.good, model.bad):
            known = zstandard.ZstdCompressionDict(data)
            known.precompute_compress(level=model.rules.level)
            options = {"write_content_size": False, "write_dict_id": False, "write_checksum": False}
            self.sides.append(zstandard.ZstdCompressor(dict_data=known, level=model.rules.level, **options))

    def difference(self, data: bytes | None) -> float:
        """(size with the bad dictionary - size with the good one) / size of the text."""
        if not data:
            return 0.0
        parts = [data[i : i + self.piece] for i in range(0, len(data), self.piece)]
        good, bad = (sum(len(side.compress(p)) for p in parts) for side in self.sides)
        return (bad - good) / len(data)


def _pieces(data: bytes | None, rules: CompressionRules) -> list[bytes]:
    """Up to ``pieces`` pieces, spread evenly over the text."""
    parts = [data[i : i + rules.piece_bytes] for i in range(0, len(data or b""), rules.piece_bytes)]
    if len(parts) <= rules.pieces:
        return parts
    return [parts[i * len(parts) // rules.pieces] for i in range(rules.pieces)]


def _dictionary(samples: list[bytes], rules: CompressionRules) -> bytes:
    size = min(rules.dictionary_bytes, max(sum(map(len, samples)) // 4, 512))
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from: their own bytes serve
        return b"".join(samples)[-rules.dictionary_bytes :]


def _calibrate(differences: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, lightly held towards 0, by Newton steps."""
    scale = max(float(np.std(differences)), 1e-9)
    design = np.column_stack([differences / scale, np.ones(len(labels))])
    theta = np.zeros(2)
    hold = np.diag([1e-2, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        slope = design.T @ (weights * (p - labels)) + hold @ theta
        curve = (design * (weights * p * (1 - p))[:, None]).T @ design + hold
        step = np.linalg.solve(curve, slope)
        theta -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(theta[0] / scale), float(theta[1])


def train(docs: DataFrame, labelled: DataFrame, rules: CompressionRules = RULES) -> Model:
    """``docs`` has (doc_id, text), ``labelled`` (doc_id, label) with label 1 for good and 0 for bad."""
    known = labelled.filter(F.col("label").isin(0, 1))
    seen = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(seen) < 2:
        share = 0.5 if not seen else 0.999 if 1 in seen else 0.001
        return Model(b"", b"", 0.0, float(np.log(share / (1 - share))), rules)
    texts = picked_texts(docs, pick(known, rules.per_class))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, found = batch.column("label").to_pylist(), []
            for label, data in zip(labels, as_bytes(batch.column("text")), strict=True):
                found += [(label, p) for p in _pieces(data, rules)]
            arrays = [pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["label", "piece"])

    build = texts.filter("draw < 0.6").select(F.col("label").cast("int").alias("label"), "text")
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for label, piece in build.mapInArrow(cut, "label int, piece binary").collect():  # bounded by per_class and pieces
        samples[label].append(bytes(piece))
    good, bad = (_dictionary(sorted(samples[x]), rules) for x in (1, 0))
    raw = Model(good, bad, 1.0, 0.0, rules)
    rest = texts.filter("draw >= 0.6").select(F.col("label").cast("int").alias("label"), "text")
    scored = map_texts(rest, _differences(raw), "difference double").collect()  # bounded by per_class
    labels = np.array([r.label for r in scored], float)
    if len(set(labels)) < 2:
        share = seen[1] / (seen[0] + seen[1])
        return Model(good, bad, 0.0, float(np.log(share / (1 - share))), rules)
    # the sample holds the labels in other shares than the corpus
    inside = {x: max((labels == x).sum(), 1) for x in (0, 1)}
    weights = np.where(labels == 1, seen[1] / inside[1], seen[0] / inside[0])
    weights = weights * len(labels) / weights.sum()
    slope, offset = _calibrate(np.array([r.difference for r in scored]), labels, weights)
    return Model(good, bad, slope, offset, rules)


def _differences(model: Model):
    held: list[Compressor] = []

    def compute(texts: list[bytes | None]) -> list:
        if not held:
            held.append(Compressor(model))
        return [[held[0].difference(t) for t in texts]]

    return compute


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, difference, score) for every row."""
    texts = texts_of(docs, id_column, text_column)
    if not model.good or not model.bad:
        found = texts.select("doc_id", F.lit(0.0).alias("difference"))
    else:
        found = map_texts(texts, _differences(model), "difference double")
    scored = 1 / (1 + F.exp(-(F.col("difference") * model.slope + model.offset)))
    return found.withColumn("score", scored)
