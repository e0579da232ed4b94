"""Variable definitions mined from chunks, in column expressions and one shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as X
from quarry.functions.urls import variable_id
from quarry.schemas import TABLES

_ROW = TABLES["variables"].names


def candidates(chunks: DataFrame) -> DataFrame:
    """One row for each name of each chunk, judged on the first line that has it.

    A name without a definition there has ``definition`` NULL: later lines of the
    chunk do not help it.  The first lines are found inside the row, so this is
    one narrow stage over ``chunks`` (their columns and ``seq``).
    """
    numbered = F.posexplode(X.lines(F.col("text"))).alias("line_no", "line")
    per_line = chunks.select("seq", "chunk_id", "source_document", "page", "dataset", "url", X.lines(F.col("text")).alias("all_lines"), numbered)
    named = per_line.select("*", F.explode(X.variable_names(F.col("line"))).alias("variable_name"))
    earlier = F.slice("all_lines", F.lit(1), F.col("line_no"))
    first = ~F.exists(earlier, lambda x: F.array_contains(X.variable_names(x), F.col("variable_name")))
    return named.filter(first).select(
        variable_id(F.col("dataset"), F.col("variable_name")).alias("variable_id"), "variable_name", F.col("dataset").alias("dataset_id"),
        X.definition(F.col("line"), F.col("variable_name")).alias("definition"), X.aliases(F.col("line")).alias("aliases"), X.years(F.col("line")).alias("years"),
        "source_document", F.col("url").alias("source_url"), "page", "chunk_id", F.lit("").alias("extraction_notes"), "seq", "line_no",
    )


def longest_wins(rows: DataFrame) -> DataFrame:
    """One row for each variable_id: the longest definition, then the earliest row.

    ``max_by`` is summed up before the shuffle, so a name that stands everywhere
    is no hot key.
    """
    rank = F.struct(F.length("definition"), -F.col("seq"), -F.col("line_no"), F.col("variable_name"))
    return rows.groupBy("variable_id").agg(F.max_by(F.struct(*_ROW), rank).alias("r")).select("r.*")


def extract_variables(chunks: DataFrame, known_files: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(variables, edges, failures, skipped) of chunks with ``seq``.

    A chunk whose source_document is blank, or not among ``known_files``
    (local_path) where that is given, fails.
    """
    path = X.strip(X.text_of("source_document"))
    named = chunks.withColumn("_path", path)
    if known_files is not None:
        known = known_files.select(F.col("local_path").alias("_known")).distinct()
        named = named.join(known, F.col("_path") == F.col("_known"), "left")
        missing = F.col("_known").isNull()
    else:
        missing = F.lit(False)
    reason = F.when(F.col("_path") == "", "chunk has empty source_document").when(missing, "source_document does not exist locally")
    judged = named.withColumn("reason", reason)
    failures = judged.filter(F.col("reason").isNotNull()).select("chunk_id", "source_document", "reason")
    found = candidates(judged.filter(F.col("reason").isNull()).select(chunks.columns))
    variables = longest_wins(found.filter(F.col("definition").isNotNull()))
    edges = variables.select(F.col("dataset_id").alias("source_id"), F.col("variable_id").alias("target_id"), F.lit("contains").alias("relationship"), "source_url", "source_document", "page", "chunk_id")
    return variables, edges, failures, found.filter(F.col("definition").isNull())
