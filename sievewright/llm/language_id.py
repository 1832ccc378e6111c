"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams (1 to 3) of the lower-cased letters,
weighted by TF-IDF. Weights are learned by follow-the-regularised-leader with
elastic-net penalties, in shards of a bounded sample whose models are averaged,
then the probabilities are sharpened or softened by one temperature, fitted on
a shard that no model has seen.

Document frequencies cover all learnable documents; the sample has at most
``per_language`` documents of each language. Every text is judged whole.
Null texts and texts without a letter are ``und`` with score 0. Null languages
teach nothing; without any learnable document every text is ``und``.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import as_bytes, map_texts, texts_of
from sievewright.llm.sampling import pick, picked_texts


@dataclass(frozen=True)
class LanguageRules:
    per_language: int = 600
    shards: int = 8
    epochs: int = 3
    bits: int = 16
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.1


RULES = LanguageRules()
_PART = 1 << 18


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def ngrams(data: bytes | None, bits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Hashed n-grams and their counts; None without a letter."""
    codes = np.frombuffer((data or b"").decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32)
    letters = _letters()[codes]
    if not letters.any():
        return None
    # each run of other characters is one space, and one stands at either end
    before = np.concatenate(([True], letters[:-1]))
    codes = np.where(letters, codes, 32)[letters | before]
    codes = np.concatenate((codes, [32]) if codes[-1] != 32 else (codes,)).astype(np.uint32)
    if codes[0] != 32:
        codes = np.concatenate((np.array([32], np.uint32), codes))
    counts = np.zeros(1 << bits, np.int64)
    for at in range(0, len(codes), _PART):
        part = codes[at : at + _PART + 2]
        first = len(codes[at : at + _PART])
        rolling = np.zeros(len(part), np.uint32)
        for n in (1, 2, 3):
            usable = len(part) - n + 1
            if usable < 1:
                break
            rolling = rolling[:usable] * np.uint32(0x01000193) + part[n - 1 :] + np.uint32(n * 0x9E37)
            mixed = rolling[:first] * np.uint32(0x85EBCA6B)
            counts += np.bincount(mixed >> np.uint32(32 - bits), minlength=1 << bits)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _vector(data: bytes | None, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    counted = ngrams(data, int(len(idf)).bit_length() - 1)
    if counted is None:
        return None
    value = np.log1p(counted[1]) * idf[counted[0]]
    return counted[0], value / max(float(np.linalg.norm(value)), 1e-12)


def _document_frequencies(texts: DataFrame, rules: LanguageRules) -> tuple[np.ndarray, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents = np.zeros(1 << rules.bits, np.int64), 0
        for batch in batches:
            for data in as_bytes(batch.column("text")):
                if counted := ngrams(data, rules.bits):
                    total[counted[0]] += 1
                    documents += 1
        found = np.flatnonzero(total)
        features = pa.array([-1, *found.tolist()], pa.int32())
        yield pa.RecordBatch.from_arrays([features, pa.array([documents, *total[found].tolist()], pa.int64())], names=["feature", "n"])

    counted = texts.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    frequency, documents = np.zeros(1 << rules.bits, np.int64), 0
    for feature, n in counted.collect():  # a row per hashed feature
        if feature < 0:
            documents = n
        else:
            frequency[feature] = n
    return frequency, documents


class Ftrl:
    """FTRL-proximal for softmax: per weight, a sum of gradients and one of their squares."""

    def __init__(self, classes: int, features: int, rules: LanguageRules):
        self.rules = rules
        self.z = np.zeros((features + 1, classes))
        self.n = np.zeros((features + 1, classes))

    def weights(self, rows: np.ndarray) -> np.ndarray:
        z, r = self.z[rows], self.rules
        pull = np.sign(z) * r.l1 - z
        return np.where(np.abs(z) <= r.l1, 0.0, pull / ((r.beta + np.sqrt(self.n[rows])) / r.alpha + r.l2))

    def learn(self, rows: np.ndarray, values: np.ndarray, label: int) -> None:
        rows, values = np.append(rows, len(self.z) - 1), np.append(values, 1.0)
        weights = self.weights(rows)
        error = softmax(values @ weights)
        error[label] -= 1
        gradient = values[:, None] * error
        grown = self.n[rows] + gradient**2
        self.z[rows] += gradient - (np.sqrt(grown) - np.sqrt(self.n[rows])) / self.rules.alpha * weights
        self.n[rows] = grown


def softmax(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max())
    return shifted / shifted.sum()


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float = 1.0

    def logits(self, data: bytes | None) -> np.ndarray | None:
        made = _vector(data, self.idf)
        return None if made is None else made[1] @ self.weights[made[0]] + self.weights[-1]


def _trainer(languages: list[str], idf: np.ndarray, rules: LanguageRules):
    def train_shard(rows: pd.DataFrame) -> pd.DataFrame:
        model = Ftrl(len(languages), len(idf), rules)
        number = {x: i for i, x in enumerate(languages)}
        made = [(_vector(t.encode() if t else None, idf), number[x]) for t, x in zip(rows["text"], rows["label"], strict=True)]
        made = [(*v, y) for v, y in made if v is not None]
        order = np.random.default_rng(int(rows["shard"].iloc[0]))
        for _ in range(rules.epochs):
            for i in order.permutation(len(made)):
                model.learn(*made[i])
        weights = model.weights(np.arange(len(idf) + 1))
        feature, label = np.nonzero(weights)
        return pd.DataFrame({"feature": feature, "class": label, "weight": weights[feature, label]})

    return train_shard


def _temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, from a fine grid."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        scaled = logits / t
        top = scaled.max(axis=1, keepdims=True)
        return float((np.log(np.exp(scaled - top).sum(axis=1)) + top[:, 0] - scaled[np.arange(len(labels)), labels]).mean())

    return float(min(np.exp(np.linspace(-4, 4, 161)), key=loss))


def train(learnable: DataFrame, rules: LanguageRules = RULES) -> Model:
    """``learnable`` has (doc_id, text, lang); rows without a lang are ignored."""
    known = learnable.filter(F.col("lang").isNotNull())
    frequency, documents = _document_frequencies(known, rules)
    idf = np.log((documents + 1) / (frequency + 1)) + 1
    picks = pick(known.select("doc_id", F.col("lang").alias("label")), rules.per_language)
    shard = F.floor(F.col("draw") * rules.shards).cast("int")
    texts = picked_texts(known, picks).withColumn("shard", shard)
    languages = sorted(r.label for r in picks.select("label").distinct().collect())
    empty = Model(languages, idf, np.zeros((len(idf) + 1, len(languages))))
    if not languages:
        return empty
    # the last shard is kept for the temperature
    shared = texts.filter(F.col("shard") < rules.shards - 1).select("shard", "label", "text")
    trained = shared.groupBy("shard").applyInPandas(_trainer(languages, idf, rules), "feature int, class int, weight double")
    summed = trained.groupBy("feature", "class").agg((F.sum("weight") / (rules.shards - 1)).alias("weight"))
    model = empty
    for feature, label, weight in summed.collect():  # at most a row per weight
        model.weights[feature, label] = weight
    number = {x: i for i, x in enumerate(languages)}
    rest = texts.filter(F.col("shard") == rules.shards - 1).select("label", "text").collect()  # bounded by the sample
    pairs = [(model.logits(r.text.encode() if r.text else None), number[r.label]) for r in rest]
    pairs = [(x, y) for x, y in pairs if x is not None]
    if pairs:
        model.temperature = _temperature(np.array([x for x, _ in pairs]), np.array([y for _, y in pairs]))
    return model


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts: list[bytes | None]) -> list:
        model, languages, scores = shared.value, [], []
        for data in texts:
            logits = model.logits(data) if model.languages else None
            if logits is None:
                languages.append("und")
                scores.append(0.0)
            else:
                likely = softmax(logits / model.temperature)
                languages.append(model.languages[int(likely.argmax())])
                scores.append(float(likely.max()))
        return [languages, scores]

    return map_texts(texts_of(docs, id_column, text_column), compute, "lang_pred string, score double")
