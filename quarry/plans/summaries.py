"""Phase reports in Markdown, from counts and at most the first rows of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame

SHOWN, FINDINGS = 25, 1000  # rows that a report shows; findings are written as a table, too


def _cell(value) -> str:
    return "" if value is None else str(value).replace("|", "\\|").replace("\n", " ")


def rows_table(df: DataFrame, columns: list[str], shown: int = SHOWN) -> list[str]:
    """The first rows as a table, and how many are left out; only those rows reach the driver."""
    first = df.select(*columns).limit(shown).collect()
    if not first:
        return ["- None"]
    lines = [f"| {' | '.join(columns)} |", f"| {' | '.join('---' for _ in columns)} |"]
    lines += [f"| {' | '.join(map(_cell, r))} |" for r in first]
    if len(first) == shown and (more := df.count() - shown) > 0:
        lines.append(f"\n- Additional rows omitted: {more}")
    return lines


def report(title: str, facts: dict[str, object], sections: dict[str, list[str]]) -> str:
    lines = [f"# {title}", "", *(f"- {k}: {v}" for k, v in facts.items())]
    for name, body in sections.items():
        lines += ["", f"## {name}", "", *body]
    return "\n".join(lines) + "\n"


def kind_table(df: DataFrame, column: str, kinds: list[str]) -> list[str]:
    """Rows of each of the named kinds, zero where there are none."""
    found = {r[0]: r[1] for r in df.groupBy(column).count().collect()}
    return [f"| {column} | rows |", "| --- | ---: |", *(f"| {k} | {found.get(k, 0)} |" for k in kinds)]


def inventory_report(inventory: DataFrame, summary: dict[str, int]) -> str:
    kinds = ["listing_page", "dataset_page", "documentation_page", "asset", "other"]
    transient = inventory.filter("link_state = 'unknown' and http_status in (429, 500, 502, 503, 504)")
    return report("Source Inventory", summary, {
        "Resource kinds": kind_table(inventory, "resource_kind", kinds),
        "Asset kinds": kind_table(inventory.filter("asset_kind <> ''"), "asset_kind", ["pdf", "xlsx", "xls", "csv", "zip"]),
        "Dead links": rows_table(inventory.filter("link_state = 'dead'"), ["url", "http_status", "source_url"]),
        "Transient links": rows_table(transient, ["url", "http_status", "source_url"]),
    })


def archive_report(manifest: DataFrame, counts: dict[str, int]) -> str:
    return report("Archive Manifest", counts, {
        "Failures": rows_table(manifest.filter("archive_state = 'failed'"), ["url", "http_status", "error"]),
        "Skipped": rows_table(manifest.filter("archive_state = 'skipped'"), ["url", "archive_state", "error"]),
    })


def extraction_report(e) -> str:
    facts = {n: getattr(e, n).count() for n in ("datasets", "documents", "document_edges", "ontology_nodes", "ontology_edges", "failures")}
    return report("Extraction Pack", facts, {"Failures": rows_table(e.failures, ["url", "resource_kind", "local_path", "reason"])})


def parsing_report(p) -> str:
    facts = {"texts": p.texts.count(), "chunks": p.chunks.count(), "failures": p.failures.count()}
    return report("Parsing Pack", facts, {"Failures": rows_table(p.failures, ["url", "local_path", "reason"])})


def variables_report(variables: DataFrame, failures: DataFrame, skipped: DataFrame) -> str:
    facts = {"variables": variables.count(), "skipped candidates": skipped.count(), "failures": failures.count()}
    return report("Variable Pack", facts, {"Failures": rows_table(failures, ["chunk_id", "source_document", "reason"])})


def audit_report(found: DataFrame, verdict: str, checked: dict[str, int]) -> str:
    return report("QA Review", {"Verdict": f"**{verdict.upper()}**"} | checked, {"Findings": rows_table(found, ["file", "item_id", "field", "severity", "message"], FINDINGS)})
