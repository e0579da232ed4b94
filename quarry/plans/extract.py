"""From an archive manifest to datasets, documents and a graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import html as H
from quarry.functions import urls as U
from quarry.functions.text import collapse, slug
from quarry.lineage import cut
from quarry.operators.dedup import last_wins
from quarry.schemas import TABLES


@dataclass(frozen=True)
class Extraction:
    datasets: DataFrame
    documents: DataFrame
    document_edges: DataFrame
    ontology_nodes: DataFrame
    ontology_edges: DataFrame
    failures: DataFrame  # url, resource_kind, local_path, reason


def verified(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``rows`` with ``content`` and ``reason``: why a row's file cannot be trusted, else NULL."""
    held = files.select(F.col("local_path").alias("_path"), F.col("sha256").alias("_sha"), "content")
    joined = rows.join(held, F.col("local_path") == F.col("_path"), "left")
    reason = (
        F.when(F.col("local_path") == "", "archived row has no local path")
        .when(F.col("_path").isNull(), "archived file does not exist")
        .when(F.col("sha256") == "", "archived row has no sha256")
        .when(F.col("_sha") != F.col("sha256"), "checksum mismatch")
    )
    return joined.withColumn("reason", reason).drop("_path", "_sha")


def _failures(df: DataFrame, reason: str | Column = "reason") -> DataFrame:
    return df.select("url", "resource_kind", "local_path", (F.col(reason) if isinstance(reason, str) else reason).alias("reason"))


def _named(df: DataFrame, table: str, **columns: Column) -> DataFrame:
    return df.select(*(columns.get(n, F.col(n)).alias(n) for n in TABLES[table].names), "seq")


def dataset_pages(pages: DataFrame, title_end: str = H.TITLE_END) -> DataFrame:
    """Trusted dataset pages with their id, parsed fields and resolved links.

    ``title_end``, what the site puts after every title, is taken away.  Other than
    HTML, a file has its source title and no fields.
    """
    is_html = F.col("content_type") == "text/html"
    parsed = pages if "page" in pages.columns else pages.withColumn("page", F.when(is_html, H.page(F.when(is_html, F.col("content")))))
    title = collapse(F.coalesce(F.col("page.title"), F.lit("")))
    if title_end:
        title = F.when(title.endswith(title_end), F.substr(title, F.lit(1), F.length(title) - len(title_end))).otherwise(title)
    field = {c: F.coalesce(F.col(f"page.{c}"), F.lit("")).alias(c) for c in ("program", "category", "availability")}
    return parsed.select(
        "seq", "url", "local_path", "sha256", U.dataset_id(F.col("url")).alias("dataset_id"),
        F.when(title == "", F.col("source_title")).otherwise(title).alias("name"), *field.values(), F.col("page.hrefs").alias("hrefs"),
    )


def page_links(pages: DataFrame) -> DataFrame:
    """(seq, dataset_id, link_no, link) of all links, resolved and normalised."""
    links = pages.select("*", F.posexplode("hrefs").alias("link_no", "href"))
    return links.withColumn("link", U.resolved(F.col("url"), F.col("href"))).drop("hrefs", "href").filter(F.col("link").isNotNull())


def related(links: DataFrame) -> DataFrame:
    """``related_to`` edges: other datasets that a page links to, once a page, in link order."""
    target = links.withColumn("target_id", U.dataset_id_of_file_url(F.col("link"))).filter(F.col("target_id") != F.col("dataset_id"))
    once = target.groupBy("seq", "dataset_id", "url", "local_path", "sha256", "target_id").agg(F.min("link_no").alias("link_no"))
    return once.select(F.col("dataset_id").alias("source_id"), "target_id", F.lit("related_to").alias("relationship"), F.col("url").alias("source_url"), "local_path", "sha256", "seq", F.col("link_no").cast("long"))


def extract(manifest: DataFrame, files: DataFrame, title_end: str = H.TITLE_END) -> Extraction:
    """``manifest`` has ``seq``; ``files`` is (local_path, content, sha256).

    Documents are joined to datasets by the id in their own or their source's
    URL; assets without one by the pages that link to them.  Where ids repeat, the
    last row wins; edges of every page stay.  Files are joined, hashes compared and
    pages parsed once; what that gives, without file contents, is cut from its
    lineage, and all tables are made from it.
    """
    eligible = manifest.filter((F.col("archive_state") == "archived") & F.col("resource_kind").isin("dataset_page", "documentation_page", "asset"))
    is_html = F.col("reason").isNull() & (F.col("content_type") == "text/html") & F.col("resource_kind").isin("dataset_page", "documentation_page")
    checked = cut(verified(eligible, files).withColumn("page", F.when(is_html, H.page(F.when(is_html, F.col("content"))))).drop("content"))
    good, bad = checked.filter(F.col("reason").isNull()), checked.filter(F.col("reason").isNotNull())

    pages = dataset_pages(good.filter(F.col("resource_kind") == "dataset_page"), title_end)
    links = page_links(pages)
    datasets = last_wins(_named(pages, "datasets", source_url=F.col("url"), extraction_notes=F.lit("")), ["dataset_id"])
    program = pages.filter(F.col("program") != "").withColumn("program_id", F.concat(F.lit("program_"), slug(F.col("program"))))
    nodes = _named(pages, "ontology_nodes", node_id=F.col("dataset_id"), node_class=F.lit("Dataset"), source_url=F.col("url"))
    nodes = nodes.unionByName(_named(program, "ontology_nodes", node_id=F.col("program_id"), node_class=F.lit("Program"), name=F.col("program"), source_url=F.col("url")))
    belongs = _named(program, "ontology_edges", source_id=F.col("dataset_id"), target_id=F.col("program_id"), relationship=F.lit("belongs_to"), source_url=F.col("url")).withColumn("link_no", F.lit(-1).cast("long"))

    others = good.filter(F.col("resource_kind") != "dataset_page").drop("reason")
    by_source = F.when(F.col("source_url") != "", F.col("source_url")).otherwise(F.col("url"))
    direct = U.dataset_id_of_file_url(F.when(F.col("resource_kind") == "documentation_page", F.col("url")).otherwise(by_source))
    others = others.withColumn("direct", direct)
    owner = links.select(F.col("link").alias("_link"), F.col("dataset_id").alias("owner")).distinct()
    linked = others.join(owner, (F.col("url") == F.col("_link")) & F.col("direct").isNull() & (F.col("resource_kind") == "asset"), "left")
    owned = linked.withColumn("dataset_id", F.coalesce("direct", "owner")).drop("_link", "owner", "direct")
    ids = datasets.select(F.col("dataset_id").alias("_known"))
    placed = owned.join(ids, F.col("dataset_id") == F.col("_known"), "left")
    lost = F.when(F.col("dataset_id").isNull(), "document source is not linked to a dataset page").otherwise("document references missing dataset")
    found = placed.filter(F.col("_known").isNotNull())
    is_page = (F.col("resource_kind") == "documentation_page") & (F.col("content_type") == "text/html")
    title = F.when(is_page, F.col("page.title")).otherwise(F.col("source_title"))
    documents = _named(
        found, "documents", document_id=U.document_id(F.col("dataset_id"), F.col("url")), title=title,
        document_kind=U.document_kind(F.col("resource_kind"), F.col("asset_kind")), source_url=F.col("url"), extraction_notes=F.lit(""),
    )
    documents = last_wins(documents, ["document_id"])
    edges = _named(documents, "document_edges", source_id=F.col("dataset_id"), target_id=F.col("document_id"), relationship=F.lit("has_document"))
    failures = _failures(bad).unionByName(_failures(placed.filter(F.col("_known").isNull()), lost))
    return Extraction(datasets, documents, edges, last_wins(nodes, ["node_id"]), belongs.unionByName(related(links)), failures)
