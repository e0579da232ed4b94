"""From metadata tables and files to chunks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import safe_id_error, strip, text_of
from quarry.operators import chunking
from quarry.schemas import TABLES
from quarry.sources.files import parsed_texts


@dataclass(frozen=True)
class Parsing:
    texts: DataFrame  # document_id, text: all parts of a document
    chunks: DataFrame
    failures: DataFrame  # url, local_path, reason


def _jobs(datasets: DataFrame, documents: DataFrame) -> DataFrame:
    """Datasets (HTML pages) and documents as one table of files to parse, with errors seen so far."""
    ids = datasets.select(F.col("dataset_id").alias("_known")).distinct()
    pages = datasets.select(
        F.lit("dataset").alias("what"), F.col("dataset_id").alias("document_id"), "dataset_id", F.lit("html").alias("document_kind"), "source_url", "local_path",
        safe_id_error("dataset_id", text_of("dataset_id")).alias("error"), "seq",
    )
    unknown = F.concat(F.lit("document dataset_id '"), text_of("dataset_id"), F.lit("' not found in datasets metadata"))
    errors = [safe_id_error("document_id", text_of("document_id")), safe_id_error("dataset_id", text_of("dataset_id")), F.when(F.col("_known").isNull(), unknown).otherwise("")]
    own = documents.join(ids, F.col("dataset_id") == F.col("_known"), "left").select(
        F.lit("document").alias("what"), "document_id", "dataset_id", "document_kind", "source_url", "local_path", F.coalesce(*(F.nullif(e, F.lit("")) for e in errors), F.lit("")).alias("error"), "seq",
    )
    return pages.unionByName(own)


def parse(datasets: DataFrame, documents: DataFrame, files: DataFrame, size: int = chunking.SIZE, overlap: int = chunking.OVERLAP) -> Parsing:
    """``files`` is (local_path, content).  A document is the parts that its file has:
    one for HTML, a page or a sheet each for PDF and XLSX.  Failures never stop
    the rest; they are rows.
    """
    chunking.check(size, overlap)
    held = files.select(F.col("local_path").alias("_path"), "content")
    path = strip(text_of("local_path"))
    jobs = _jobs(datasets, documents).withColumn("_local", path).join(held, F.col("_local") == F.col("_path"), "left")
    kind = F.col("document_kind")
    error = (
        F.when(F.col("error") != "", F.col("error"))
        .when(F.col("_local") == "", F.concat(F.col("what"), F.lit(" has empty local path")))
        .when(F.col("_path").isNull(), F.concat(F.col("what"), F.lit(" file does not exist locally")))
        .when(~kind.isin("pdf", "html", "xlsx"), F.concat(F.lit("unsupported document kind: "), text_of("document_kind")))
    )
    jobs = jobs.withColumn("reason", error).withColumn("_job", F.concat_ws("/", F.col("what"), F.col("document_id"), F.col("seq").cast("string")))
    ready = jobs.filter(F.col("reason").isNull())
    parts = parsed_texts(ready.select(F.col("_job").alias("document_id"), "document_kind", "content")).withColumnRenamed("document_id", "_job")
    known = ready.drop("content", "reason", "error", "_path", "_local")
    read = known.join(parts, "_job")
    empty = F.when(kind == "pdf", "extracted PDF text is empty (PDF may contain only scanned images and require OCR)").otherwise(F.concat(F.lit("extracted "), F.upper(kind), F.lit(" text is empty")))
    what = F.when(F.col("what") == "dataset", "dataset page").otherwise("document")
    why = F.when(F.col("error") == "empty", empty).otherwise(F.concat(F.lit("failed to parse/chunk "), what, F.regexp_replace("error", "^failed", "")))
    failures = jobs.filter(F.col("reason").isNotNull()).select(F.col("source_url").alias("url"), "local_path", "reason").unionByName(
        read.filter(F.col("error").isNotNull()).select(F.col("source_url").alias("url"), "local_path", why.alias("reason")))
    good = read.filter(F.col("error").isNull())
    pieces = chunking.chunk_table(good.withColumn("k", F.to_json(F.struct("_job", "part"))), "k", "text", size, overlap)
    pieces = pieces.select(F.from_json("k", "_job string, part int").alias("k"), "chunk_index", "chunk_text").select("k.*", "chunk_index", "chunk_text")
    mark = F.when(kind == "pdf", "__p").when(kind == "xlsx", "__s")
    place = F.coalesce(F.concat(mark, F.col("part").cast("string")), F.lit(""))
    chunks = known.join(pieces, "_job").select(
        F.concat(F.col("document_id"), place, F.lit("__chunk_"), F.col("chunk_index").cast("string")).alias("chunk_id"),
        F.col("local_path").alias("source_document"), F.col("part").alias("page"), F.col("chunk_text").alias("text"), F.col("dataset_id").alias("dataset"), F.col("source_url").alias("url"),
        F.struct(F.col("what") == "document", "seq", F.coalesce("part", F.lit(0)), "chunk_index").alias("_order"),
    )
    texts = good.groupBy("what", "document_id", "seq").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("part", F.lit(0)).alias("part"), "text"))).alias("p"))
    texts = texts.select("document_id", strip(F.array_join(F.transform("p", lambda x: x["text"]), "\n\n")).alias("text"))
    return Parsing(texts, chunks.select(*TABLES["chunks"].names, "_order"), failures)
