"""Readers and writers of the CSV and JSON-lines tables between phases."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.schemas import DOMAINS, INTEGERS, REQUIRED, TABLES

CSV = {"header": "true", "multiLine": "true", "escape": '"', "quote": '"'}


def with_seq(df: DataFrame) -> DataFrame:
    """Number rows in the order of their source; stable within one scan of it."""
    return df.withColumn("seq", F.monotonically_increasing_id())


def read_csv(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A table by its name in ``TABLES``, with ``seq``.

    ValueError names missing columns and, where a column has a fixed domain or is
    of whole numbers, the first values outside it; columns that the table does not
    know are ignored.
    """
    schema = TABLES[name]
    raw = spark.read.options(**CSV).csv(path)
    missing = sorted(REQUIRED.get(name, set(schema.names)) - set(raw.columns))
    if missing:
        raise ValueError(f"{path} is missing required columns: {', '.join(missing)}")

    def value(f: T.StructField) -> Column:
        if f.name not in raw.columns:
            return F.lit(None).cast(f.dataType) if f.name in INTEGERS else F.lit("")
        text = F.coalesce(F.col(f.name), F.lit(""))
        if f.name not in INTEGERS:
            return text
        number = F.expr(f"try_cast(nullif(trim(`{f.name}`), '') AS INT)")
        return F.coalesce(number, F.lit(0)) if f.name == "linked_documents" else number

    for f in schema:
        if f.name in INTEGERS & set(raw.columns):
            text = F.trim(F.coalesce(F.col(f.name), F.lit("")))
            if bad := raw.filter((text != "") & F.expr(f"try_cast(trim(`{f.name}`) AS INT)").isNull()).select(f.name).distinct().take(3):
                raise ValueError(f"{path}: {f.name} must be a whole number, not {', '.join(repr(r[0]) for r in bad)}")
    df = with_seq(raw).select(*(value(f).alias(f.name) for f in schema), "seq")
    for (table, column), allowed in DOMAINS.items():
        if table == name and (bad := df.filter(~F.col(column).isin(*allowed)).select(column).distinct().take(3)):
            raise ValueError(f"{path}: {column} cannot be {', '.join(repr(r[0]) for r in bad)}")
    return df


def _one_file(parts: DataFrameWriter, path: str, kind: str, head: str = "") -> None:
    """What a writer writes in parallel, as one file at ``path``: parts are streamed together, in order."""
    spark = SparkSession.getActiveSession()
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folder, whole, target = (jvm.org.apache.hadoop.fs.Path(x) for x in (f"{path}.parts", f"{path}.whole", path))
    fs = target.getFileSystem(conf)
    getattr(parts.mode("overwrite"), kind)(str(folder))
    out = fs.create(whole, True)
    try:
        out.write(bytearray(head.encode()))
        for name in sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")):
            held = fs.open(jvm.org.apache.hadoop.fs.Path(folder, name))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(held, out, 1 << 20, False)
            held.close()
    finally:
        out.close()
    fs.delete(target, True)
    fs.rename(whole, target)
    fs.delete(folder, True)


def write_csv(df: DataFrame, name: str, path: str) -> None:
    """A file with the table's columns in order, NULL as the empty text.

    Rows go in order of ``seq`` where they have one.  Tasks write parts, and the
    file appears when it is whole.
    """
    schema = TABLES[name]
    ordered = df.orderBy("seq") if "seq" in df.columns else df
    text = [F.coalesce(F.col(f.name).cast("string"), F.lit("")).alias(f.name) for f in schema]
    _one_file(ordered.select(*text).write.options(header="false", escape='"', emptyValue=""), path, "csv", ",".join(schema.names) + "\n")


def _line_numbers(few: DataFrame, lines: DataFrame) -> DataFrame:
    """``few`` of the ``lines`` with ``line``, their number in their file.

    A file is read in blocks; a line's number is the lines of earlier blocks and
    its place in its own.  Only counts of blocks meet, never the lines.
    """
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return few.join(blocks.withColumn("skip", earlier), ["file", "block"]).withColumn("line", F.col("skip") + F.col("seq") - F.col("first") + 1)


def read_chunks(spark: SparkSession, path: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Chunks of a JSON-lines file, and failures (chunk_id, source_document, reason).

    Blank lines are skipped.  A line that is no chunk becomes a failure named
    after its line number, unless ``strict``: then the first one is an error.
    """
    fields = TABLES["chunks"]
    lines = with_seq(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")))
    kind = T.StructType([*fields.fields, T.StructField("_bad", T.StringType())])
    parsed = lines.filter(F.trim("value") != "").withColumn("c", F.from_json("value", kind, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("c").isNull() | F.col("c._bad").isNotNull()
    for f in fields:
        if f.name != "page":
            bad = bad | F.col(f"c.{f.name}").isNull()
    numbered = _line_numbers(parsed.filter(bad), lines)
    if strict and (first := numbered.agg(F.min("line")).first()[0]):
        raise ValueError(f"failed to parse chunk JSON on line {first}")
    good = parsed.filter(~bad).select("c.*", "seq").drop("_bad")
    failures = numbered.select(F.concat(F.lit("line-"), F.col("line")).alias("chunk_id"), F.lit("").alias("source_document"), F.lit("failed to parse chunk JSON").alias("reason"))
    return good, failures


def write_chunks(chunks: DataFrame, path: str) -> None:
    """A file of JSON lines, NULL pages kept, in the order of ``chunks``."""
    _one_file(chunks.select(*TABLES["chunks"].names).write.option("ignoreNullFields", "false"), path, "json")


def pretty_json(names: list[str]) -> Column:
    """A row as indented JSON, NULLs kept."""
    return F.to_json(F.struct(*names), {"pretty": "true", "ignoreNullFields": "false"})


def write_files(df: DataFrame, key: str, body: str, folder: str, suffix: str) -> int:
    """One small file a row, named by ``key``; what stood in ``folder`` before is gone.

    Executors write into a folder that they share (for large results use
    ``write_chunks`` or Parquet: a file a row does not scale).  Ids must be safe
    as names.  The number of files.
    """
    shutil.rmtree(folder, ignore_errors=True)
    os.makedirs(folder)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, text in zip(batch["k"], batch["b"]):
                if os.path.basename(name) != name or not name.strip("."):
                    raise ValueError(f"unsafe name: {name}")
                with open(os.path.join(folder, name + suffix), "w", encoding="utf-8") as f:
                    f.write(text or "")
            yield pd.DataFrame({"n": [len(batch)]})

    written = df.select(F.col(key).alias("k"), F.col(body).alias("b")).mapInPandas(run, "n long")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
