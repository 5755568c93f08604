"""Bounded samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Labelled documents that a classifier is fitted on at most; they are chosen by the hash of their id.
SAMPLE = 20_000


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, where: Column | None = None, bound: int = SAMPLE) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``bound`` labelled ids, chosen by hash, one row for each.

    An id labelled twice has its largest label, and of several rows with one id the last text counts (null: empty), so the sample is
    bounded in rows. ``where`` is a condition on ``doc_id``. The chosen ids are at most ``bound`` rows, so they are broadcast.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    if where is not None:
        rows = rows.where(where)
    chosen = rows.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("label").alias("label"))
