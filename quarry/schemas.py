"""The tables that phases hand to each other: fixed columns, never inferred.

In memory every table also has ``seq``, the place of a row in its source, for the
rules that say which of several rows wins.  A missing text is the empty text;
only ``http_status`` and ``page`` can be NULL.
"""

from __future__ import annotations

from pyspark.sql import types as T

INTEGERS = {"http_status", "page", "linked_documents"}


def _struct(names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.IntegerType() if n in INTEGERS else T.StringType()) for n in names.split()])


TABLES: dict[str, T.StructType] = {
    "inventory": _struct("url title resource_kind asset_kind content_type http_status link_state linked_documents source_url source_title"),
    "manifest": _struct("url resource_kind asset_kind source_url source_title content_type http_status archive_state downloaded_at_utc sha256 local_path error"),
    "datasets": _struct("dataset_id name program category availability source_url local_path sha256 extraction_notes"),
    "documents": _struct("document_id dataset_id title document_kind source_url local_path sha256 content_type extraction_notes"),
    "document_edges": _struct("source_id target_id relationship source_url local_path sha256"),
    "ontology_nodes": _struct("node_id node_class name source_url local_path sha256"),
    "ontology_edges": _struct("source_id target_id relationship source_url local_path sha256"),
    "chunks": _struct("chunk_id source_document page text dataset url"),
    "variables": _struct("variable_id variable_name dataset_id definition aliases years source_document source_url page chunk_id extraction_notes"),
    "variable_edges": _struct("source_id target_id relationship source_url source_document page chunk_id"),
    "findings": _struct("file item_id field severity message"),
}

#: Columns that a file must have; the others of its table may be missing.
REQUIRED: dict[str, set[str]] = {
    "datasets": {"dataset_id", "source_url", "local_path", "sha256"},
    "documents": {"document_id", "dataset_id", "source_url", "local_path", "sha256"},
    "document_edges": {"source_id", "target_id"},
}

DOMAINS: dict[tuple[str, str], set[str]] = {
    ("inventory", "resource_kind"): {"listing_page", "dataset_page", "documentation_page", "asset", "other"},
    ("inventory", "link_state"): {"live", "dead", "unknown"},
    ("manifest", "archive_state"): {"archived", "skipped", "failed"},
}

RECORDS = T.StructType([
    *(T.StructField(n, T.StringType()) for n in ("record_id", "record_type", "title", "dataset_id", "text", "source_url", "source_document")),
    T.StructField("page", T.IntegerType()),
    T.StructField("exact_terms", T.ArrayType(T.StringType())),
])
