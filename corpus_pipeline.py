"""From raw documents to token ids, in stages that each read what the last one wrote.

Every stage calls one operator of ``quarry.llm`` on all rows that its predecessor
kept, and its decisions take effect: documents of low quality go, one document of
each near-duplicate group stays, contaminated documents go, personal data is
masked, and what is left is encoded and decoded.  All stages but the last return
the columns of ``documents``, and rows that they keep keep their order of
columns and their other values.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from quarry.lineage import remove, shared_folder
from quarry.llm import bpe, decontaminate, pii, quality, simhash
from quarry.llm.queries import table, tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts.  The model is fitted on the raw table's labelled rows."""
    model = quality.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality.keep(docs, model)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each near-duplicate group."""
    return simhash.representatives(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and of the bytes that they decode to."""
    return bpe.round_trip(docs, tokenizer())


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_quality),
    ("near duplicates", one_of_each),
    ("decontamination", uncontaminated),
    ("personal data", masked),
    ("byte-level BPE", encoded),
]

#: A classifier's decisions are no SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder and read again.

    A stage's files go once the next stage is written; those of the last are the result.
    """
    folder = f"{shared_folder(spark)}/pipeline-{uuid4()}"
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:
            remove(spark, f"{folder}/{i - 1}")
    return docs
