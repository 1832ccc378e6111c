"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievewright.llm.common import bound_batches


def pick(labelled: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, label, draw): about ``per_class`` ids of each label, drawn by hash; all of a label that has no more.

    ``labelled`` has (doc_id, label). Null ids and labels are left out; an id
    under several labels counts for the most frequent, the largest in a tie.
    ``draw`` is a number in [0, 1) that depends on the id only.
    """
    known = labelled.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    votes = known.groupBy("doc_id", "label").agg(F.count("*").alias("n"))
    single = votes.groupBy("doc_id").agg(F.max_by("label", F.struct("n", "label")).alias("label"))
    # a share per label is drawn by hash; nothing is ranked, and no task holds a whole label
    sizes = {r.label: r.n for r in single.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = F.lit(1.0)
    for label, n in sizes.items():
        if n > per_class:
            share = F.when(F.col("label") == label, per_class / n).otherwise(share)
    drawn = single.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(1 << 20)) / float(1 << 20)
    return drawn.select("doc_id", "label", draw.alias("draw"))


def picked_texts(docs: DataFrame, picks: DataFrame) -> DataFrame:
    """(doc_id, label, draw, text) of the picks; ``picks`` is bounded and goes to all tasks, so no text is shuffled."""
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text").join(F.broadcast(picks), "doc_id").select("doc_id", "label", "draw", "text")
