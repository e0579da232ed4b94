"""Bounded samples of labelled documents, for the operators that learn from labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.lineage import cut
from .textops import bounded_batches


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, most: int) -> DataFrame:
    """(doc_id, text, label int) of at most ``most`` documents, cut from its lineage.

    Of the rows of ``labels`` whose label is 0 or 1 and for which ``train`` holds,
    those with the least hash of doc_id are taken; a doc_id labelled twice counts
    once, with the larger label, and a doc_id with several texts gives the least.
    Only ids within the bound are broadcast.
    """
    ids = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & train)
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    bounded_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(ids), "doc_id")
    return cut(texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label")).coalesce(8))
