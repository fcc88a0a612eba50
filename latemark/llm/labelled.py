"""Bounded, reproducible samples of labelled documents for fitting a classifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from latemark.llm.frames import whole

#: Of every FOLDS documents one fold is held out from learning.
FOLDS, HELD_OUT = 4, 2


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves HELD_OUT modulo FOLDS; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, letters: int) -> tuple[DataFrame, dict[int, int]]:
    """(text, label) of at most ``rows`` labelled documents a class, and the labels of each class.

    Ids are taken in the order of their hash, from labels outside the held-out fold; the
    label of an id with several is the greatest. Texts above ``letters`` characters are not
    learnt from, nor are labels without a document.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    ids = None
    for value in (0, 1):
        part = known.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        ids = part if ids is None else ids.unionByName(part)
    # 2 * rows ids at most
    found = docs.select("doc_id", whole().alias("text")).filter(F.length("text") <= letters).join(F.broadcast(ids), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("text", "label"), counts


def class_weights(labels, counts: dict[int, int]):
    """Weight of each row that gives the classes of a sample their shares among all labels."""
    import numpy as np

    weights = np.ones(len(labels))
    total = max(sum(counts.values()), 1)
    for value in (0, 1):
        own = labels == value
        if own.any():
            weights[own] = counts.get(value, 0) / total / own.mean()
    return weights
