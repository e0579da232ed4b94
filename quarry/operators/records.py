"""The searchable records of the four metadata tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import is_blank, strip, text_of
from quarry.schemas import RECORDS

_NAMES = RECORDS.names


def _required(c: Column, row: str | Column, field: str) -> Column:
    who = F.lit(row) if isinstance(row, str) else row
    return F.when(is_blank(c), F.raise_error(F.concat(who, F.lit(f" has empty required field: {field}"))).cast("string")).otherwise(strip(c))


def _or(c: str, other: Column) -> Column:
    return F.when(text_of(c) == "", other).otherwise(F.col(c))


def _joined(*parts: Column) -> Column:
    return F.array_join(F.filter(F.array(*parts), lambda x: x != ""), " ")


def _record(df: DataFrame, kind: str, **columns: Column) -> DataFrame:
    columns = {"record_type": F.lit(kind), "page": F.lit(None).cast("int")} | columns
    return df.select(*(columns[n].alias(n) for n in _NAMES))


def dataset_records(datasets: DataFrame) -> DataFrame:
    i = _required(F.col("dataset_id"), "dataset row", "dataset_id")
    title = _or("name", i)
    text = _joined(i, title, *map(text_of, ("program", "category", "availability", "extraction_notes")))
    return _record(datasets, "dataset", record_id=i, title=title, dataset_id=i, text=text, source_url=_required(F.col("source_url"), i, "source_url"), source_document=text_of("local_path"), exact_terms=F.array(i, title))


def document_records(documents: DataFrame) -> DataFrame:
    i, d = _required(F.col("document_id"), "document row", "document_id"), text_of("dataset_id")
    title = _or("title", i)
    text = _joined(i, d, title, *map(text_of, ("document_kind", "content_type", "extraction_notes")))
    return _record(documents, "document", record_id=i, title=title, dataset_id=d, text=text, source_url=_required(F.col("source_url"), i, "source_url"), source_document=text_of("local_path"), exact_terms=F.array(i, d, title))


def variable_records(variables: DataFrame) -> DataFrame:
    i = _required(F.col("variable_id"), "variable row", "variable_id")
    name, d = _required(F.col("variable_name"), i, "variable_name"), text_of("dataset_id")
    bars = [F.replace(text_of(c), F.lit("|"), F.lit(" ")) for c in ("aliases", "years")]
    text = _joined(i, name, d, text_of("definition"), *bars, text_of("extraction_notes"))
    return _record(variables, "variable", record_id=i, title=name, dataset_id=d, text=text, source_url=_required(F.col("source_url"), i, "source_url"), source_document=text_of("source_document"), page=F.col("page"), exact_terms=F.array(i, name, d))


def chunk_records(chunks: DataFrame) -> DataFrame:
    i, d = F.col("chunk_id"), text_of("dataset")
    url = F.when(is_blank(F.col("url")), F.raise_error(F.concat(i, F.lit(" has empty required field: url"))).cast("string")).otherwise(F.col("url"))
    return _record(chunks, "chunk", record_id=i, title=i, dataset_id=d, text=text_of("text"), source_url=url, source_document=text_of("source_document"), page=F.col("page"), exact_terms=F.array(i, d))


def union_records(datasets: DataFrame, documents: DataFrame, variables: DataFrame | None = None, chunks: DataFrame | None = None) -> DataFrame:
    """All records; variables and chunks may be missing.  A blank id or URL is an error when it is read."""
    out = dataset_records(datasets).unionByName(document_records(documents))
    for more in ((variable_records(variables) if variables is not None else None), (chunk_records(chunks) if chunks is not None else None)):
        out = out.unionByName(more) if more is not None else out
    return out
