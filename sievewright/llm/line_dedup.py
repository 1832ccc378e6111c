"""Removal of lines that many documents share.

Lines are exploded and hashed (XXH3, 128 bits) where they are read; only hash
and doc_id move. Per hash the smallest and largest doc_id come from partial
aggregates, so a line that a third of all documents hold costs one row per
task. The hashes to drop are written once and joined to the exploded lines,
two plain tables of which adaptive execution can split a hot key. Each
document then receives the hashes it loses and is put together again by
position.

Null and empty texts are one empty line. A document with a null doc_id keeps
all its lines and counts for no line. Repeated rows of one doc_id are one
document: a line that only they hold stays in all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import as_bytes, fresh, materialize, texts_of


@dataclass(frozen=True)
class LineRules:
    min_characters: int = 10
    min_documents: int = 2


RULES = LineRules()


def line_hash(line: bytes, least: int) -> bytes | None:
    """Hash of the normalised line; None if it is shorter than ``least`` characters."""
    key = line.strip().lower()
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "replace")) < least):
        return None
    return xxhash.xxh3_128_digest(key)


def line_hashes(docs: DataFrame, rules: LineRules = RULES) -> DataFrame:
    """(hash, doc_id) for every different long line of every document."""
    texts = texts_of(docs).filter(F.col("doc_id").isNotNull())
    schema = f"hash binary, doc_id {dict(texts.dtypes)['doc_id']}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes = [], []
            for i, data in enumerate(as_bytes(batch.column("text"))):
                found = {line_hash(x, rules.min_characters) for x in (data or b"").split(b"\n")} - {None}
                hashes += found
                rows += [i] * len(found)
            ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.binary()), ids], names=["hash", "doc_id"])

    return texts.mapInArrow(run, schema)


def repeated_lines(lines: DataFrame, rules: LineRules = RULES) -> DataFrame:
    """(hash, first): the hashes in enough documents, and the smallest doc_id that holds each."""
    if rules.min_documents == 2:  # two documents differ exactly if smallest and largest do
        spread = lines.groupBy("hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        return spread.filter("first < last").select("hash", "first")
    counted = lines.distinct().groupBy("hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("documents"))
    return counted.filter(F.col("documents") >= rules.min_documents).select("hash", "first")


def _assembler(least: int):
    def assemble(text: pd.Series, dropped: pd.Series) -> pd.DataFrame:
        rows = []
        for value, hashes in zip(text, dropped, strict=True):
            if hashes is None or not len(hashes):
                rows.append((value or "", (value or "").count("\n") + 1, 0))
                continue
            gone = {bytes(h) for h in hashes}
            lines = value.split("\n")
            kept = [x for x in lines if line_hash(x.encode(), least) not in gone]
            rows.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_dropped"])

    return F.pandas_udf(assemble, "text string, n_lines long, n_dropped long")


def dedup_lines(docs: DataFrame, rules: LineRules = RULES, result: str = "lines") -> DataFrame:
    """``docs`` with a column ``result`` (text, n_lines, n_dropped); texts are never null there."""
    lines = materialize(line_hashes(docs, rules))
    repeated = materialize(repeated_lines(lines, rules))
    key = fresh(docs, "_sw_doc")
    gone = fresh(docs, "_sw_gone")
    dropped = (
        lines.join(repeated, "hash")
        .filter("doc_id > first")
        .groupBy(F.col("doc_id").alias(key))
        .agg(F.collect_set("hash").alias(gone))
    )
    joined = docs.join(dropped, docs["doc_id"] == dropped[key], "left").drop(key)
    assemble = _assembler(rules.min_characters)
    return joined.withColumn(result, assemble(F.col("text"), F.col(gone))).drop(gone)


def replace_texts(docs: DataFrame, rules: LineRules = RULES) -> DataFrame:
    """The columns of ``docs``, with shortened texts and, if there is one, a fitting n_chars."""
    result = fresh(docs, "_sw_lines")
    done = dedup_lines(docs, rules, result)
    text = F.when(F.col("text").isNotNull(), F.col(f"{result}.text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(dict(docs.dtypes)["n_chars"])
    return done.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
