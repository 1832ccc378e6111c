"""Toxicity by gradient-boosted trees over dense features.

Features of a text: densities of a seed lexicon and of a lexicon learned from
labelled texts (words and word beginnings that stand out in toxic ones), their
closeness to second-person words, capitals, punctuation, and obfuscated
spellings. Spark's boosted trees rank the texts; isotonic regression on texts
that no tree has seen turns the ranks into probabilities.

Lexicon, trees and calibration are fitted on three disjoint parts of a bounded
sample (``per_class`` labelled ids each). Every text is scored whole. Null and
empty texts have all features 0 and get a score like any other. Labels other
than 0 and 1 are not used; if one label is missing, all scores are the share
of label 1 (0 if there are no labels).
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import as_bytes, materialize, texts_of
from sievewright.llm.sampling import pick, picked_texts

SEED_LEXICON = frozenset(
    "idiot idiots moron morons stupid loser losers scum trash clown pathetic worthless disgusting dumb fool jerk "
    "idiota idiotas imbécil estúpido estúpida basura tonto tonta payaso asqueroso idiote imbécile stupide crétin "
    "connard ordure débile minable dégoûtant dummkopf blöd trottel abschaum versager arschloch wertlos ekelhaft".split()
)
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch tú ti tus usted ustedes vosotros".split()
)
#: How far a second-person word may stand from a lexicon word.
REACH = 5
_PREFIXES = (4, 5, 6)
_NOTHING = (False, 0.0, False, False, False)
_TOKEN = re.compile(r"[^\W_]+(?:[@$!|*._'0-9-]+[^\W_]+)*")
_LEET = str.maketrans("013457@$!|", "oieastasil", "*._-'")
FEATURES = (
    "seed_density", "learned_density", "learned_weight", "largest_weight", "hits", "near_second_person", "second_person",
    "capital_letters", "capital_words", "exclamations", "questions", "other_marks", "obfuscated", "obfuscated_hits", "length",
)


@dataclass(frozen=True)
class ToxicityRules:
    per_class: int = 4000
    lexicon_size: int = 2000
    least_documents: int = 4
    least_ratio: float = 4.0
    trees: int = 20
    depth: int = 3
    seed: int = 11


RULES = ToxicityRules()


def _stems(word: str) -> list[str]:
    """The word and its beginnings; beginnings end in a mark, so that they never equal a word."""
    return [word, *(word[:n] + "-" for n in _PREFIXES if len(word) > n)]


@functools.cache
def _kinds() -> np.ndarray:
    """Per code point: 1 for a letter, 2 for a capital, 4 for white space."""
    points = map(chr, range(0x110000))
    return np.fromiter((x.isalpha() | x.isupper() << 1 | x.isspace() << 2 for x in points), np.uint8, 0x110000)


def features(data: bytes | None, lexicon: dict[str, float]) -> list[float]:
    text = (data or b"").decode("utf-8", "replace")
    tokens = _TOKEN.findall(text)
    n = len(tokens)
    kinds = np.bincount(_kinds()[np.frombuffer(text.encode("utf-32-le"), np.uint32)], minlength=8)
    letters, capitals, spaces = int(kinds[1::2].sum()), int(kinds[[2, 3, 6, 7]].sum()), int(kinds[4:].sum())
    if not n:
        return [0.0] * (len(FEATURES) - 4) + [1.0 if len(text) > spaces else 0.0, 0.0, 0.0, 0.0]
    known: dict[str, tuple[bool, float, bool, bool, bool]] = {}
    seed = obfuscated = hidden = second = shouted = 0
    weight = largest = 0.0
    hits, persons = [], []
    for i, token in enumerate(tokens):
        found = known.get(token)
        if found is None:
            word = token.lower()
            plain = word if word.isalpha() else word.translate(_LEET)
            value = max((lexicon.get(s, 0.0) for s in _stems(plain)), default=0.0)
            loud = len(token) > 1 and token.isupper()
            found = known[token] = (plain in SEED_LEXICON, value, plain != word, word in SECOND_PERSON, loud)
        if found == _NOTHING:
            continue
        bad, value, masked, person, loud = found
        if bad or value:
            hits.append(i)
            seed += bad
            weight += value
            largest = max(largest, value)
            hidden += masked
        obfuscated += masked
        shouted += loud
        if person:
            persons.append(i)
            second += 1
    near = 0
    if hits and persons:
        place = np.searchsorted(persons, hits)
        around = np.array([-(1 << 60), *persons, 1 << 60])
        near = int((np.minimum(np.array(hits) - around[place], around[place + 1] - np.array(hits)) <= REACH).sum())
    exclaimed, asked = text.count("!"), text.count("?")
    marks = len(text) - letters - spaces - exclaimed - asked
    return [
        seed / n, len(hits) / n, weight / n, largest, float(np.log1p(len(hits))), near / n, second / n,
        capitals / max(letters, 1), shouted / n, exclaimed / n, asked / n, marks / n, obfuscated / n, hidden / n, float(np.log1p(n)),
    ]


def _learn_lexicon(texts: DataFrame, rules: ToxicityRules) -> dict[str, float]:
    """Stems by the log of their ratio between toxic and other texts, the strongest first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stems, labels = [], []
            for label, data in zip(batch.column("label").to_pylist(), as_bytes(batch.column("text")), strict=True):
                words = set(_TOKEN.findall((data or b"").decode("utf-8", "replace").lower()))
                own = {s for w in words for s in _stems(w if w.isalpha() else w.translate(_LEET))}
                stems += own
                labels += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array(labels, pa.int32())], names=["stem", "label"])

    sums = {r.label: r.n for r in texts.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, other = sums.get(1, 0), sums.get(0, 0)
    if not toxic or not other:
        return {}
    counted = texts.select("label", "text").mapInArrow(run, "stem string, label int").groupBy("stem")
    counted = counted.agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b"))
    ratio = ((F.col("a") + 0.5) / (toxic + 1.0)) / ((F.col("b") + 0.5) / (other + 1.0))
    strong = counted.filter(F.col("a") >= rules.least_documents).withColumn("weight", F.log(ratio))
    strong = strong.filter(F.col("weight") >= float(np.log(rules.least_ratio)))
    ranked = strong.orderBy((F.col("weight") * F.sqrt("a")).desc(), "stem").limit(rules.lexicon_size)
    return {r.stem: r.weight for r in ranked.select("stem", "weight").collect()}


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: GBTClassificationModel | None = None
    curve: IsotonicRegressionModel | None = None
    share: float = 0.0


def _featured(texts: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """The columns of ``texts`` but the text, and ``features``."""
    kept = [c for c in texts.columns if c != "text"]
    types = dict(texts.dtypes)
    schema = ", ".join([*(f"{c} {types[c]}" for c in kept), "features array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t, lexicon) for t in as_bytes(batch.column("text"))]
            arrays = [*(batch.column(c) for c in kept), pa.array(made, pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "features"])

    return texts.mapInArrow(run, schema).withColumn("features", array_to_vector("features"))


def _margins(featured: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    """``featured`` with ``margin``, the trees' log odds."""
    raw = trees.transform(featured)
    return raw.withColumn("margin", vector_to_array(trees.getRawPredictionCol())[1])


def train(docs: DataFrame, labelled: DataFrame, rules: ToxicityRules = RULES) -> Model:
    """``docs`` has (doc_id, text), ``labelled`` (doc_id, label) with label 1 for toxic and 0 for others."""
    known = labelled.filter(F.col("label").isin(0, 1))
    seen = {r.label: r.n for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = seen.get(1, 0) / max(sum(seen.values()), 1)
    if len(seen) < 2:
        return Model({}, share=share)
    texts = picked_texts(docs, pick(known, rules.per_class)).withColumn("label", F.col("label").cast("int"))
    texts = materialize(texts)
    lexicon = _learn_lexicon(texts.filter("draw < 0.4"), rules)
    rest = materialize(_featured(texts.filter("draw >= 0.4"), lexicon))
    sizes = {(r.label, r.early): r.n for r in rest.groupBy("label", (F.col("draw") < 0.75).alias("early")).agg(F.count("*").alias("n")).collect()}
    if min(sizes.get(x, 0) for x in ((0, True), (1, True), (0, False), (1, False))) == 0:
        return Model(lexicon, share=share)
    # the sample holds the labels in other shares than the corpus; weights restore them
    weight = F.when(F.col("label") == 1, seen[1] / (sizes[1, True] + sizes[1, False])).otherwise(seen[0] / (sizes[0, True] + sizes[0, False]))
    rest = rest.withColumn("weight", weight)
    boosted = GBTClassifier(labelCol="label", weightCol="weight", maxIter=rules.trees, maxDepth=rules.depth, stepSize=0.3, seed=rules.seed)
    trees = boosted.fit(rest.filter("draw < 0.75"))
    ranked = _margins(rest.filter("draw >= 0.75"), trees).select(F.col("label").cast("double").alias("label"), "weight", "margin")
    isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight", predictionCol="score")
    curve = isotonic.fit(ranked)
    return Model(lexicon, trees, curve, share)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, margin, score) for every row."""
    texts = texts_of(docs, id_column, text_column)
    if model.trees is None:
        return texts.select("doc_id", F.lit(0.0).alias("margin"), F.lit(float(model.share)).alias("score"))
    ranked = _margins(_featured(texts, model.lexicon), model.trees).select("doc_id", "margin")
    return model.curve.transform(ranked)
