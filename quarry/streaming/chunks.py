"""The chunker and the variable miner as streams: new texts in, new rows out.

Both are narrow, so the streaming plan is the batch plan; no state is kept.  Which
definition of a name wins is asked when the candidates written so far are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.chunking import OVERLAP, SIZE, chunk_table
from quarry.operators.variables import candidates, longest_wins
from quarry.schemas import TABLES

TEXTS = T.StructType([T.StructField("document_id", T.StringType()), T.StructField("text", T.StringType())])

CHUNKS = T.StructType([*TABLES["chunks"].fields, T.StructField("seq", T.LongType())])


def text_stream(spark: SparkSession, folder: str, files_a_trigger: int = 100) -> DataFrame:
    """Parquet files of (document_id, text) as they arrive in ``folder``."""
    return spark.readStream.schema(TEXTS).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)


def chunk_stream(texts: DataFrame, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """chunk_id, document_id, text of each chunk of each new text."""
    cut = chunk_table(texts, "document_id", "text", size, overlap)
    return cut.select(F.concat_ws("__chunk_", "document_id", F.col("chunk_index").cast("string")).alias("chunk_id"), "document_id", F.col("chunk_text").alias("text"))


def _append(rows: DataFrame, out: str, checkpoint: str, once: bool):
    writer = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append")
    query = (writer.trigger(availableNow=True) if once else writer).start()
    if once:
        query.awaitTermination()
    return query


def append_chunks(texts: DataFrame, out: str, checkpoint: str, once: bool = True, **chunking):
    """Write the chunks of new texts to ``out``, exactly once; the query, ended if ``once``."""
    return _append(chunk_stream(texts, **chunking), out, checkpoint, once)


def chunk_rows(spark: SparkSession, folder: str, files_a_trigger: int = 100) -> DataFrame:
    """Parquet files of chunks, with ``seq``, as they arrive in ``folder``."""
    return spark.readStream.schema(CHUNKS).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)


def append_candidates(chunks: DataFrame, out: str, checkpoint: str, once: bool = True):
    """Write what new chunks say of variable names to ``out``, exactly once; the query, ended if ``once``."""
    return _append(candidates(chunks), out, checkpoint, once)


def variables_so_far(spark: SparkSession, out: str) -> DataFrame:
    """The variables of all candidates written to ``out``: for each the longest definition, then the earliest."""
    return longest_wins(spark.read.parquet(out).filter(F.col("definition").isNotNull()))
