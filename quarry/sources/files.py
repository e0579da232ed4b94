"""Local files as tables: bytes, digests, and text by kind of file."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.html import main_text
from quarry.sources.pdf import pdf_pages


def read_files(spark: SparkSession, root: str, relative_to: str | None = None) -> DataFrame:
    """(local_path, content, sha256, size) of every file under ``root``, hashed once each.

    ``local_path`` is relative to ``relative_to`` where that is given.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    path = F.regexp_replace("path", r"\A[a-z]+:/{1,3}", "/")
    if relative_to is not None:
        base = relative_to.rstrip("/") + "/"
        path = F.when(path.startswith(base), F.substr(path, F.lit(len(base) + 1))).otherwise(path)
    return files.select(path.alias("local_path"), "content", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size"))


def xlsx_sheets(content: bytes) -> list[tuple[int, str]]:
    """(number from 1, text) of each sheet, by the number in its file's name.

    Cells that hold something are joined by tabs, rows by line breaks.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.namelist()
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(x.itertext()).strip() for x in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]

        def cell(c: ElementTree.Element) -> str:
            if c.get("t") == "inlineStr":
                inline = c.find("{*}is")
                return "" if inline is None else "".join(inline.itertext()).strip()
            held = c.find("{*}v")
            text = (held.text or "").strip() if held is not None else ""
            if c.get("t") == "s" and text:
                try:
                    return shared[int(text)]
                except (ValueError, IndexError):
                    return text
            return text

        def order(name: str) -> tuple[int, str]:
            digits = re.search(r"sheet(\d+)\.xml$", name)
            return int(digits[1]) if digits else 0, name

        out = []
        sheets = sorted((n for n in names if re.match(r"xl/worksheets/sheet.*\.xml$", n)), key=order)
        for number, name in enumerate(sheets, 1):
            rows = ElementTree.fromstring(book.read(name)).iterfind(".//{*}sheetData/{*}row")
            lines = ("\t".join(filter(None, map(cell, row.iterfind("{*}c")))) for row in rows)
            out.append((number, "\n".join(x for x in lines if x.strip())))
        return out


def parsed_texts(files: DataFrame) -> DataFrame:
    """(document_id, part, text, error) of (document_id, document_kind, content).

    ``part`` is the page of a PDF or the sheet of a workbook, NULL for HTML.  What
    cannot be read is one row with ``error``; nothing raises.
    """

    def parts(kind: str, content: bytes) -> list[tuple[int | None, str]]:
        if kind == "html":
            return [(None, main_text(content.decode("utf-8", "replace")))]
        return pdf_pages(content) if kind == "pdf" else xlsx_sheets(content)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, kind, content in zip(batch["document_id"], batch["document_kind"], batch["content"]):
                try:
                    found = parts(kind, bytes(content))
                    rows += [(doc, p, t, None) for p, t in found] if any(t.strip() for _, t in found) else [(doc, None, "", "empty")]
                except Exception as e:  # one damaged file is one row
                    rows.append((doc, None, "", f"failed: {e}"))
            out = pd.DataFrame(rows, columns=["document_id", "part", "text", "error"])
            yield out.astype({"part": "Int32"})

    return files.select("document_id", "document_kind", "content").mapInPandas(run, "document_id string, part int, text string, error string")
