"""Command line: one sub-command for each phase, and search.

Exit code 0 means that nothing failed (for ``qa``: that the verdict is pass).
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from functools import partial
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from quarry.config import ChunkConfig, Paths
from quarry.functions.html import TITLE_END
from quarry.lineage import cut
from quarry.operators import records as R
from quarry.operators import search as S
from quarry.operators import variables as V
from quarry.plans import archive as A
from quarry.plans import audit as Q
from quarry.plans import context as C
from quarry.plans import crawl as K
from quarry.plans import extract as E
from quarry.plans import parse as P
from quarry.plans import summaries as M
from quarry.schemas import TABLES
from quarry.session import local_session
from quarry.sources import tables as T
from quarry.sources.files import read_files
from quarry.sources.web import fetched, probe, request


def _read(spark: SparkSession, paths: Paths, name: str) -> DataFrame:
    if not paths.table(name).exists():
        raise FileNotFoundError(f"required file is missing: {paths.table(name)}")
    return T.read_csv(spark, name, str(paths.table(name)))


def _maybe(spark: SparkSession, paths: Paths, name: str) -> DataFrame | None:
    return _read(spark, paths, name) if paths.table(name).exists() else None


def _files(spark: SparkSession, paths: Paths, hashes_only: bool = False) -> DataFrame:
    if not paths.raw.exists() or not any(p.is_file() for p in paths.raw.rglob("*")):
        return spark.createDataFrame([], "local_path string, content binary, sha256 string, size long")
    files = read_files(spark, str(paths.raw.resolve()), str(paths.base.resolve()))
    return files.drop("content") if hashes_only else files


def _report(paths: Paths, name: str, text: str) -> None:
    paths.workspace.mkdir(parents=True, exist_ok=True)
    (paths.workspace / name).write_text(text, encoding="utf-8")


def load_records(spark: SparkSession, paths: Paths) -> DataFrame:
    """Records of datasets and documents, and of variables and chunks where they exist."""
    chunks = T.read_chunks(spark, str(paths.table("chunks")), strict=True)[0] if paths.table("chunks").exists() else None
    return R.union_records(_read(spark, paths, "datasets"), _read(spark, paths, "documents"), _maybe(spark, paths, "variables"), chunks)


def inventory(spark, paths: Paths, args) -> int:
    get, ask = partial(request, timeout=args.timeout), partial(probe, timeout=args.timeout)
    web = lambda urls: fetched(urls, get, args.delay).selectExpr("url", "status", "content_type", "body as html")
    told = -(10**9)

    def progress(message: str, done: int) -> None:
        nonlocal told
        if args.progress and done - told >= args.progress:
            told = done
            print(message)

    found = K.crawl(spark, K.CrawlConfig(args.base_url, args.max_pages, args.max_follow_pages, args.max_assets), web, lambda urls: fetched(urls, ask, args.delay).select("url", "status", "content_type"), progress)
    T.write_csv(found.inventory, "inventory", str(paths.inventory))
    _report(paths, "02_source_inventory.md", M.inventory_report(found.inventory, found.summary))
    return 0


def archive(spark, paths: Paths, args) -> int:
    previous, files = _maybe(spark, paths, "manifest"), _files(spark, paths, hashes_only=True)
    def download(url: str):
        time.sleep(args.delay)
        return request(url, timeout=args.timeout)

    rows = cut(A.archive(_read(spark, paths, "inventory"), str(paths.raw), cut(previous) if previous is not None else None, files, download))
    counts = A.counts(rows)
    T.write_csv(rows, "manifest", str(paths.manifest))
    _report(paths, "03_archive_manifest.md", M.archive_report(rows, counts))
    return int(counts["failed"] > 0)


def extract(spark, paths: Paths, args) -> int:
    found = E.extract(_read(spark, paths, "manifest"), _files(spark, paths), args.title_end)
    for name in ("datasets", "documents", "document_edges", "ontology_nodes", "ontology_edges"):
        T.write_csv(getattr(found, name), name, str(paths.table(name)))
    _report(paths, "04_extraction_pack.md", M.extraction_report(found))
    return int(bool(found.failures.take(1)))


def parse(spark, paths: Paths, args) -> int:
    config = ChunkConfig(args.chunk_size, args.chunk_overlap)
    found = P.parse(_read(spark, paths, "datasets"), _read(spark, paths, "documents"), _files(spark, paths), config.size, config.overlap)
    T.write_chunks(found.chunks.orderBy("_order"), str(paths.table("chunks")))
    T.write_files(found.texts, "document_id", "text", str(paths.parsed / "texts"), ".txt")
    T.write_files(found.chunks.withColumn("json", T.pretty_json(TABLES["chunks"].names)), "chunk_id", "json", str(paths.parsed / "chunks"), ".json")
    _report(paths, "05_parsing_pack.md", M.parsing_report(found))
    return int(bool(found.failures.take(1)))


def variables(spark, paths: Paths, args) -> int:
    chunks, bad = T.read_chunks(spark, str(paths.table("chunks")))
    rows, edges, failures, skipped = V.extract_variables(chunks, _files(spark, paths, hashes_only=True))
    failures = bad.unionByName(failures)
    T.write_csv(rows.orderBy("dataset_id", "variable_name"), "variables", str(paths.table("variables")))
    T.write_csv(edges, "variable_edges", str(paths.table("variable_edges")))
    _report(paths, "07_variable_pack.md", M.variables_report(rows, failures, skipped))
    return int(bool(failures.take(1)))


def qa(spark, paths: Paths, args) -> int:
    required = ("manifest", "datasets", "documents")
    if missing := [str(paths.table(n)) for n in required if not paths.table(n).exists()]:
        found = spark.createDataFrame(Q.missing_tables(missing), TABLES["findings"])
        _report(paths, "06_qa_review.md", M.audit_report(found, "redo", {}))
        return 1
    try:
        base = {n: _read(spark, paths, n) for n in required}
    except ValueError as e:
        found = spark.createDataFrame([("metadata", "header/parse", "csv_parsing", "error", str(e))], TABLES["findings"])
        _report(paths, "06_qa_review.md", M.audit_report(found, "redo", {}))
        return 1
    optional, unreadable = {}, []
    for name in ("document_edges", "variables", "variable_edges", "ontology_nodes", "ontology_edges"):
        try:
            optional[name] = _maybe(spark, paths, name)
        except ValueError as e:
            unreadable.append((str(paths.table(name)), str(e)))
    tables = Q.Tables(base["manifest"], base["datasets"], base["documents"], _files(spark, paths, hashes_only=True), unreadable=unreadable, **optional)
    found = cut(Q.findings(tables))
    word, errors, warnings, total = Q.verdict(found).first()
    count = lambda df: 0 if df is None else df.count()
    edges = sum(count(optional.get(n)) for n in ("document_edges", "variable_edges", "ontology_edges"))
    checked = {"Datasets Checked": base["datasets"].count(), "Documents Checked": base["documents"].count(), "Variables Checked": count(optional.get("variables")), "Edges Checked": edges, "Errors": errors, "Warnings": warnings, "Total Findings": total}
    T.write_csv(found, "findings", str(paths.workspace / "06_qa_findings.csv"))
    _report(paths, "06_qa_review.md", M.audit_report(found, word, checked))
    return int(word != "pass")


def search(spark, paths: Paths, args) -> int:
    rows = S.search(load_records(spark, paths), args.query, args.limit).collect()
    if args.json:
        print(json.dumps([r.asDict() for r in rows], indent=2))
    for r in [] if args.json else rows:
        page = f" page {r['page']}" if r["page"] is not None else ""
        print(f"{r['score']:.3f}\t{r['record_type']}\t{r['record_id']}\t{r['source_url']}{page}\n{r['snippet']}")
    return 0


def context(spark, paths: Paths, args) -> int:
    print(C.context_json(load_records(spark, paths), args.query, args.limit))
    return 0


COMMANDS = {f.__name__: f for f in (inventory, archive, extract, parse, variables, qa, search, context)}


#: Places of single tables, for commands that search.
GIVEN = {"datasets": "--datasets-metadata", "documents": "--documents-metadata", "variables": "--variables-metadata", "chunks": "--chunks-jsonl"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="quarry")
    sub = top.add_subparsers(dest="command", required=True)
    for name, f in COMMANDS.items():
        p = sub.add_parser(name, help=(f.__doc__ or name).strip().splitlines()[0])
        p.add_argument("--base", type=Path, default=Path("."))
        outputs = {"inventory": "--output"} if name == "inventory" else {"manifest": "--manifest-output"} if name == "archive" else {}
        more = {"raw": "--raw-root", "workspace": "--workspace-dir"} | outputs
        for place in ("metadata", "graph", "raw", "parsed", "workspace", "inventory", "manifest"):
            p.add_argument(f"--{place}", *([more[place]] if place in more else []), type=Path)
        if name in ("inventory", "archive"):
            p.add_argument("--timeout-seconds", "--timeout", dest="timeout", type=float, default=20.0)
            p.add_argument("--request-delay-seconds", "--delay", dest="delay", type=float, default=0.5)
        if name == "inventory":
            p.add_argument("--base-url", required=True)
            p.add_argument("--max-pages", "--max-listing-pages", type=int, default=4)
            p.add_argument("--max-follow-pages", type=int)
            p.add_argument("--max-assets", type=int)
            p.add_argument("--progress-interval", dest="progress", type=int, default=25, help="pages between two messages; 0: none")
        if name == "extract":
            p.add_argument("--title-end", default=TITLE_END, help="what the site puts after every title")
        if name == "parse":
            p.add_argument("--chunk-size", type=int, default=500)
            p.add_argument("--chunk-overlap", type=int, default=100)
        if name in ("search", "context"):
            p.add_argument("words", nargs="?", help="the query, as --query")
            p.add_argument("--query")
            p.add_argument("--limit", type=int, default=10 if name == "search" else 5)
            p.add_argument("--json", action="store_true")
            for table, flag in GIVEN.items():
                p.add_argument(flag, dest=f"given_{table}", type=Path)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    given = {t: place for t in GIVEN if (place := getattr(args, f"given_{t}", None))}
    paths = Paths(args.base, args.metadata, args.graph, args.raw, args.parsed, args.workspace, args.inventory, args.manifest, given)
    if args.command in ("search", "context"):
        if (args.query is None) == (args.words is None):
            print(f"Error in {args.command}: one query, please", file=sys.stderr)
            return 1
        args.query = args.words if args.query is None else args.query
    try:
        return COMMANDS[args.command](spark or local_session(), paths, args)
    except Exception as e:
        print(f"Error in {args.command}: {e}", file=sys.stderr)
        return 1


__all__ = ["COMMANDS", "load_records", "main", "parser"]
