"""Language-model scores from a hidden Markov model of words.

Tokens are lower-cased words and one end per document. All training tokens are
counted, by partial aggregates. The most frequent words are sent to all tasks,
a bounded table (``frequent``); counts of the others come from a join, and as
no word in it is frequent, none makes a hot key.

The hidden states emit symbols: the ``symbols`` most frequent words and the
end, and a class by shape for all others. A word's probability within its
class follows its count. The parameters start from the plain frequencies of the
symbols with seeded noise; then every round of Baum-Welch runs over all
training documents, in segments of at most ``segment`` tokens, and its expected
counts are summed across partitions. Documents are written once as symbols, with
the sums over their words; rounds and scores read those and no texts. A
document's likelihood is exact: the scaled forward recursion runs over its whole
sequence, many documents at a time.

Null and empty texts are the end alone. Null doc_ids are learned from. Without
training documents all counts are 0 and every symbol is as likely as any
other. Repeated rows are scored alike.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import as_bytes, bound_batches, materialize

#: The end's key in tables of counts; no word is empty.
END = b""
_LENGTHS = (4, 6, 8, 10, 13)
CLASSES = 4 * (len(_LENGTHS) + 1) * 2 * 2


@dataclass(frozen=True)
class HmmRules:
    states: int = 8
    symbols: int = 1 << 14
    frequent: int = 1 << 18  # at most
    segment: int = 256
    rounds: int = 14  # of Baum-Welch, each over all training documents
    smoothing: float = 50.0
    seed: int = 5


RULES = HmmRules()
#: Different words a task holds before it hands their counts on.
_HELD_WORDS = 400_000
#: Segments computed side by side; about 36 MB, used again and again.
_SIDE_BY_SIDE = 1024
#: Steps of a recursion between two scalings. As emissions are shares of the largest of their symbol, a step leaves at least the
#: share of the least likely move, which is over 1 / (tokens + states): 1e-80 in eight steps over 10 billion tokens.
_UNSCALED = 8
#: Rows turned into columns at a time, so that they stay in the cache.
_TURNED = 4096


def words_of(data: bytes | None) -> list[bytes]:
    return (data or b"").lower().split()


def shape(word: bytes) -> int:
    """Class of a word: last mark, length, whether it holds digits or letters beyond ASCII."""
    last = word[-1:]
    mark = 1 if last == b"." else 2 if last == b"," else 3 if last in b";:!?)\"'" else 0
    length = sum(len(word) > n for n in _LENGTHS)
    digits = any(48 <= x <= 57 for x in word)
    return ((mark * (len(_LENGTHS) + 1) + length) * 2 + digits) * 2 + (not word.isascii())


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) over all tokens of ``texts`` (text); the end is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def handed(held: Counter) -> pa.RecordBatch:
            arrays = [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["word", "n"])

        held: Counter[bytes] = Counter()
        for batch in batches:
            for data in as_bytes(batch.column("text")):
                held.update(words_of(data))
                held[END] += 1
                if len(held) > _HELD_WORDS:
                    yield handed(held)
                    held.clear()
        yield handed(held)

    return texts.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Vocabulary:
    """The frequent words with their counts; the symbol of every word; totals of the counts and of each class."""

    def __init__(self, words: list[bytes], counts: list[int], own: int, total: int, distinct: int, class_sums: np.ndarray, class_words: np.ndarray):
        self.place = {w: i for i, w in enumerate(words)}
        self.log_counts = np.log10(np.array([*counts, 0], float) + 0.5)
        self.known = np.array([*(n > 0 for n in counts), False])
        self.own, self.total, self.distinct = own, total, distinct
        # counts of the symbols
        self.counts = np.concatenate((np.array(counts[:own], float), class_sums))
        self.symbol = np.array([i if i < own else own + shape(w) for i, w in enumerate(words)], np.int32)
        # log10 of the share that divides a word's count, by symbol; 0 for words that are symbols
        inside = np.log10(class_sums + 0.5 * (class_words + 1))
        self.log_class = np.concatenate([np.zeros(own), inside])

    @property
    def symbols(self) -> int:
        return self.own + CLASSES

    def encode(self, data: bytes | None) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Symbols and places of the tokens (-1: not frequent), and the words that are not frequent."""
        words = words_of(data)
        words.append(END)
        get = self.place.get
        places = np.array([get(w, -1) for w in words], np.int64)
        symbols = self.symbol[places]
        rare = [words[i] for i in np.flatnonzero(places < 0)]
        if rare:
            symbols[places < 0] = [self.own + shape(w) for w in rare]
        return symbols, places, rare


def _least_count(counts: DataFrame, most: int) -> int:
    """The count from which on there are at most ``most`` words.

    Words are counted per step of their counts (64 to an octave), a few thousand
    rows; a sort by count would send ``most`` words of every task to the driver.
    """
    steps = F.when(F.col("n") < 1024, F.col("n").cast("double")).otherwise(F.floor(F.log2("n") * 64) + 384)
    sized = counts.groupBy(steps.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n"))
    least, words = 1 << 62, 0
    for r in sized.orderBy(F.desc("step")).collect():
        words += r.words
        if words > most:
            break
        least = r.n
    return least


def vocabulary(counts: DataFrame, rules: HmmRules) -> Vocabulary:
    """From the written table of counts; the end comes first, then words by falling count."""
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v"), F.sum(F.when(F.col("word") == END, F.col("n"))).alias("ends")).first()
    others = counts.filter(F.col("word") != END)
    chosen = others.filter(F.col("n") >= _least_count(others, rules.frequent)).toArrow()  # bounded by ``frequent``
    chosen = chosen.sort_by([("n", "descending"), ("word", "ascending")])
    words = [END, *chosen.column("word").to_pylist()]
    numbers = [sums.ends or 0, *chosen.column("n").to_pylist()]
    own = min(len(words), rules.symbols)

    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.array([shape(w) if w else -1 for w in batch.column("word").to_pylist()], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(of), batch.column("n")], names=["class", "n"])

    class_sums, class_words = np.zeros(CLASSES), np.zeros(CLASSES)
    shaped = counts.mapInArrow(classes, "class int, n long").filter("class >= 0").groupBy("class")
    for r in shaped.agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # a row per class
        class_sums[r["class"]], class_words[r["class"]] = r.n, r.v
    for w, n in zip(words[1:own], numbers[1:own], strict=True):
        class_sums[shape(w)] -= n
        class_words[shape(w)] -= 1
    return Vocabulary(words, numbers, own, sums.n or 0, sums.v, class_sums, class_words)


def _active(lengths: np.ndarray) -> np.ndarray:
    """For sequences of falling ``lengths``: how many are longer than t, for every step t."""
    return np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")


@dataclass
class Hmm:
    start: np.ndarray
    moves: np.ndarray
    emit: np.ndarray  # a row per symbol

    def relative(self) -> tuple[np.ndarray, np.ndarray]:
        """Emissions as shares of the largest of their symbol, and the largest of every symbol."""
        top = np.maximum(self.emit.max(axis=1), np.finfo(float).tiny)
        return np.ascontiguousarray(self.emit / top[:, None]), top

    def log10(self, sequences: list[np.ndarray]) -> np.ndarray:
        """Exact log10 likelihood of every sequence, by the scaled forward recursion."""
        lengths = np.array([len(s) for s in sequences])
        tokens, firsts = np.concatenate(sequences), np.cumsum(lengths) - lengths
        emit, top = self.relative()
        ones, order = np.ones(len(self.start)), np.argsort(-lengths, kind="stable")
        begins, active = firsts[order], _active(lengths[order])
        logs, forward = np.zeros(len(sequences)), None
        for t, n in enumerate(active.tolist()):
            seen = emit.take(tokens[begins[:n] + t], axis=0)
            forward = self.start * seen if forward is None else np.matmul(forward[:n], self.moves)
            if t:
                forward *= seen
            scaled = _scaled_from(t, active)
            if scaled < n:
                total = forward[scaled:] @ ones
                logs[scaled:n] += np.log10(total)
                forward[scaled:] /= total[:, None]
        found = np.empty(len(sequences))
        found[order] = logs
        return found + np.add.reduceat(np.log10(top)[tokens], firsts)


def _scaled_from(t: int, active: np.ndarray) -> int:
    """The first sequence to scale at step ``t``: all of them at every ``_UNSCALED``-th step, else those that end."""
    return 0 if t % _UNSCALED == _UNSCALED - 1 or t + 1 == len(active) else int(active[t + 1])


class Expected:
    """Expected counts of Baum-Welch, summed over segments."""

    def __init__(self, model: Hmm):
        self.model = model
        k = len(model.start)
        self.start, self.moves = np.zeros(k), np.zeros((k, k))
        self.emit = np.zeros(model.emit.shape)
        # where a segment goes on in the middle of a document, states are as they are in the long run
        self.later = np.full(k, 1 / k) @ np.linalg.matrix_power(model.moves, 64)
        # the largest emission of a symbol cancels out of all expected counts
        self._emit, _ = model.relative()
        self._grow(0)

    def _grow(self, n: int) -> None:
        """Arrays for ``n`` tokens, used by one group of segments after the other."""
        k = len(self.start)
        self._tokens, self._forward, self._seen = np.empty(n, np.intp), np.empty((n, k)), np.empty((n, k))

    def add(self, sequences: list[np.ndarray], segment: int) -> None:
        if not sequences:
            return
        lengths = np.array([len(s) for s in sequences])
        pieces = -(-lengths // segment)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)  # of a segment in its sequence
        firsts = np.repeat(np.cumsum(lengths) - lengths, pieces) + number * segment
        sizes = np.minimum(np.repeat(lengths, pieces) - number * segment, segment)
        # segments of like lengths side by side, the longest first
        order, tokens = np.argsort(-sizes, kind="stable"), np.concatenate(sequences)
        for i in range(0, len(order), _SIDE_BY_SIDE):
            chosen = order[i : i + _SIDE_BY_SIDE]
            self._add(tokens, firsts[chosen], sizes[chosen], number[chosen] == 0)

    def _add(self, flat: np.ndarray, firsts: np.ndarray, sizes: np.ndarray, opens: np.ndarray) -> None:
        """Segments of ``flat`` by falling size; a row per token, step by step."""
        model, k = self.model, len(self.start)
        active = _active(sizes)
        offsets = np.concatenate(([0], np.cumsum(active))).tolist()
        if offsets[-1] > len(self._tokens):
            self._grow(offsets[-1])
        tokens, forward, seen = (x[: offsets[-1]] for x in (self._tokens, self._forward, self._seen))
        counts = active.tolist()
        for t, n in enumerate(counts):
            tokens[offsets[t] : offsets[t + 1]] = flat[firsts[:n] + t]
        self._emit.take(tokens, axis=0, out=seen, mode="clip")  # other modes copy once more
        ones = np.ones(k)
        step = forward[: counts[0]]
        step[:] = np.where(opens[:, None], model.start, self.later)
        for t, n in enumerate(counts):
            here = seen[offsets[t] : offsets[t + 1]]
            if t:
                before, step = step, forward[offsets[t] : offsets[t + 1]]
                np.matmul(before[:n], model.moves, out=step)
            step *= here
            scaled = _scaled_from(t, active)
            if scaled < n:
                total = (step[scaled:] @ ones)[:, None]
                step[scaled:] /= total
                here[scaled:] /= total
        turned = np.ascontiguousarray(model.moves.T)
        backward = np.ones((counts[0], k))
        moved = np.zeros((k, k))
        for t in range(len(counts) - 2, -1, -1):
            m = counts[t + 1]
            here, weighted = forward[offsets[t] : offsets[t + 1]], seen[offsets[t + 1] : offsets[t + 2]]
            weighted *= backward[:m]
            moved += here[:m].T @ weighted
            np.matmul(weighted, turned, out=backward[:m])
            # the posterior takes the forward value's place; it is not needed again
            here *= backward[: counts[t]]
        self.moves += moved * model.moves
        self.start += forward[: counts[0]][opens].sum(axis=0)
        by_state = seen.reshape(k, -1)  # these are not needed again either
        for i in range(0, len(tokens), _TURNED):
            by_state[:, i : i + _TURNED] = forward[i : i + _TURNED].T
        for state in range(k):
            self.emit[:, state] += np.bincount(tokens, by_state[state], len(self.emit))


def _maximize(start: np.ndarray, moves: np.ndarray, emit: np.ndarray, plain: np.ndarray, smoothing: float) -> Hmm:
    """Parameters from expected counts; emissions lean on the plain frequencies ``plain``."""
    k = len(start)
    start = (start + 1) / (start.sum() + k)
    moves = (moves + 1) / (moves.sum(axis=1, keepdims=True) + k)
    emit = (emit + smoothing * plain[:, None]) / (emit.sum(axis=0) + smoothing)
    return Hmm(start, moves, emit)


def _first_model(plain: np.ndarray, rules: HmmRules) -> Hmm:
    """The plain frequencies ``plain`` with seeded noise in every state; states tend to last."""
    k, random = rules.states, np.random.default_rng(rules.seed)
    noise = random.gamma(2.0, size=(len(plain), k))
    emit = plain[:, None] * noise
    return Hmm(np.full(k, 1 / k), np.full((k, k), 0.2 / k) + 0.8 * np.eye(k), emit / emit.sum(axis=0))


def encode_documents(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) as the bytes of its symbols' numbers, and what its score needs beside them.

    Written once for all rounds and scores: (row, doc_id, symbols, n_tokens,
    n_frequent, logs, inside, rare, times). ``logs`` and ``inside`` are sums of
    log10 over its frequent words; ``rare`` are its other words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(words)
    kind = _number(words.symbols)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, symbols binary, n_tokens long, n_frequent long, logs double, inside double, rare array<binary>, times array<int>"
    names = [part.split()[0] for part in schema.split(", ")]
    types = [pa.binary(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            rows = []
            for data in as_bytes(batch.column("text")):
                symbols, places, rare = words.encode(data)
                frequent = places[places >= 0]
                outside = symbols >= words.own
                own = words.log_counts[places]
                # log10(count + 0.5) of frequent words, and of those among them that are no symbols
                logs, classed = own[places >= 0].sum(), own[(places >= 0) & outside].sum()
                inside = classed - words.log_class[symbols[outside]].sum()
                known, held = int(words.known[frequent].sum()), Counter(rare)
                rows.append((symbols.astype(kind).tobytes(), len(symbols), known, float(logs), float(inside), list(held), list(held.values())))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=names)

    made = docs.select("doc_id", "text").mapInArrow(run, schema)
    # the number of a row is fixed once it is written
    written = materialize(made.withColumn("row", F.monotonically_increasing_id()))
    shared.unpersist()
    return written


def _number(symbols: int) -> str:
    return "<u2" if symbols <= 1 << 16 else "<i4"


def _iteration(encoded: DataFrame, model: Hmm, plain: np.ndarray, rules: HmmRules) -> Hmm:
    """One round of Baum-Welch over all of ``encoded`` (symbols)."""
    k = rules.states
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    columns = [f"s{i}" for i in range(k)]
    kind = _number(len(plain))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expected = Expected(shared.value)
        for batch in batches:
            expected.add([np.frombuffer(s, kind) for s in batch.column("symbols").to_pylist()], rules.segment)
        found = np.flatnonzero(expected.emit.any(axis=1))
        # below 0: the start, then a row per state of the moves
        names = np.concatenate((found, -1 - np.arange(k + 1)))
        rows = np.vstack((expected.emit[found], expected.start, expected.moves))
        arrays = [pa.array(names, pa.int32()), *(pa.array(rows[:, i]) for i in range(k))]
        yield pa.RecordBatch.from_arrays(arrays, names=["symbol", *columns])

    schema = ", ".join(["symbol int", *(f"{c} double" for c in columns)])
    summed = encoded.mapInArrow(run, schema).groupBy("symbol").agg(*[F.sum(c).alias(c) for c in columns])
    found = summed.toArrow()  # a row per symbol
    names = found.column("symbol").to_numpy()
    values = np.column_stack([found.column(c).to_numpy() for c in columns])
    start, moves, emit = np.zeros(k), np.zeros((k, k)), np.zeros((len(plain), k))
    emit[names[names >= 0]] = values[names >= 0]
    start += values[names == -1].sum(axis=0)
    moves[-2 - names[names < -1]] = values[names < -1]
    shared.unpersist()
    return _maximize(start, moves, emit, plain, rules.smoothing)


def learn(encoded: DataFrame, words: Vocabulary, rules: HmmRules = RULES) -> Hmm:
    """The model from the symbols of the training documents."""
    plain = (words.counts + 0.5) / (words.counts + 0.5).sum()
    model = _first_model(plain, rules)
    for _ in range(rules.rounds if words.total else 0):
        model = _iteration(encoded.select("symbols"), model, plain, rules)
    return model


def train(training: DataFrame, rules: HmmRules = RULES) -> tuple[DataFrame, Vocabulary, Hmm]:
    """Counts of all words, the vocabulary and the model, from ``training`` (doc_id, text)."""
    bound_batches(training.sparkSession)
    counts = materialize(count_words(training))
    words = vocabulary(counts, rules)
    return counts, words, learn(encode_documents(training, words), words, rules)


def score(docs: DataFrame, counts: DataFrame, words: Vocabulary, model: Hmm) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) for every row of ``docs`` (doc_id, text)."""
    return score_encoded(encode_documents(docs, words), counts, words, model)


def train_and_score(docs: DataFrame, held_out: Column, rules: HmmRules = RULES) -> tuple[DataFrame, Vocabulary, Hmm]:
    """The scores of every row of ``docs`` (doc_id, text), learned from those that ``held_out`` (of doc_id) leaves.

    All texts are encoded once; rounds read the training rows of that table, and
    scores read all of it.
    """
    bound_batches(docs.sparkSession)
    counts = materialize(count_words(docs.filter(~held_out)))
    words = vocabulary(counts, rules)
    encoded = encode_documents(docs, words)
    model = learn(encoded.filter(~held_out), words, rules)
    return score_encoded(encoded, counts, words, model), words, model


def score_encoded(encoded: DataFrame, counts: DataFrame, words: Vocabulary, model: Hmm) -> DataFrame:
    """:func:`score` of encoded documents."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    kind, types = _number(words.symbols), dict(encoded.dtypes)
    kept = ["row", "doc_id", "n_tokens", "n_frequent", "logs", "inside"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences = [np.frombuffer(s, kind) for s in batch.column("symbols").to_pylist()]
            if sequences:
                chain = pa.array(shared.value.log10(sequences))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), chain], names=[*kept, "chain"])

    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", chain double"
    local = encoded.select(*kept, "symbols").mapInArrow(run, schema)
    pairs = encoded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    n = F.coalesce("n", F.lit(0))
    found = pairs.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(n + 0.5)).alias("rare_logs"),
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    divisor = float(np.log10(words.total + 0.5 * (words.distinct + 1)))
    joined = local.join(found, "row", "left").na.fill(0, ["rare_logs", "rare_known"])
    return joined.select(
        "doc_id",
        "n_tokens",
        (F.col("n_frequent") + F.col("rare_known")).alias("n_known"),
        (F.col("logs") + F.col("rare_logs") - F.col("n_tokens") * divisor).alias("base_score"),
        (F.col("chain") + F.col("inside") + F.col("rare_logs")).alias("score"),
    )
