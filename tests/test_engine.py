"""Whole phases on small inputs: search, variables, extraction, parsing, audit, crawl, archive."""

from __future__ import annotations

import hashlib
import io
import json
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quarry import lineage
from quarry.functions.html import TITLE_END
from quarry.operators import dedup, records, search, variables
from quarry.plans import archive, audit, context, crawl, extract, parse, summaries
from quarry.schemas import TABLES
from quarry.sources import files as S
from quarry.sources import tables as T
from quarry.sources import web
from quarry.streaming import chunks as stream

SHA = lambda b: hashlib.sha256(b).hexdigest()


def make(spark, name, *rows):
    """A table of ``TABLES`` from dicts; what a row leaves out is blank."""
    schema = TABLES[name]
    blank = {f.name: "" if f.dataType.typeName() == "string" else None for f in schema}
    data = [tuple((blank | r)[n] for n in schema.names) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, StructType([*schema.fields, StructField("seq", LongType())]))


def files_of(spark, **content):
    rows = [(k, v, SHA(v), len(v)) for k, v in content.items()]
    return spark.createDataFrame(rows, "local_path string, content binary, sha256 string, size long")


@pytest.fixture()
def corpus(spark):
    ds = make(spark, "datasets", {"dataset_id": "mbsf", "name": "Summary File", "program": "Medicare", "source_url": "https://ex.org/mbsf", "local_path": "m.html"})
    docs = make(spark, "documents", {"document_id": "mbsf__book", "dataset_id": "mbsf", "title": "Codebook", "document_kind": "pdf", "source_url": "https://ex.org/b.pdf", "local_path": "b.pdf"})
    var = make(spark, "variables", {"variable_id": "mbsf__var__bene-id", "variable_name": "BENE_ID", "dataset_id": "mbsf", "definition": "Beneficiary identifier", "source_url": "https://ex.org/b.pdf", "page": 3, "aliases": "bene|bid"})
    ch = make(spark, "chunks", {"chunk_id": "c1", "text": "People with dual eligibility and a BENE_ID.", "dataset": "mbsf", "url": "https://ex.org/b.pdf", "source_document": "b.pdf", "page": 3})
    return records.union_records(ds, docs, var, ch)


def test_exact_variable_comes_first(corpus):
    first = search.search(corpus, "BENE_ID").first()
    assert (first["record_id"], first["page"]) == ("mbsf__var__bene-id", 3)


def test_phrase_finds_the_chunk(corpus):
    first = search.search(corpus, "dual eligibility").first()
    assert first["record_id"] == "c1" and "dual eligibility" in first["snippet"]


def test_search_limits_and_errors(spark, corpus):
    for query, limit in (("", 1), ("  ", 1), ("!!!", 1), ("x", 0)):
        with pytest.raises(ValueError):
            search.search(corpus, query, limit)
    none = corpus.withColumn("text", F.lit("!!!"))
    assert search.search(none, "bene").count() == 0
    assert search.search(corpus.limit(0), "bene").count() == 0
    typed = search.search(corpus, "mbsf", 10, ["dataset"]).collect()
    assert [r["record_type"] for r in typed] == ["dataset"]


def test_statistics_follow_the_filter(corpus):
    mixed = {r["record_id"]: r["score"] for r in search.search(corpus, "eligibility").collect()}
    alone = {r["record_id"]: r["score"] for r in search.search(corpus, "eligibility", record_types=["chunk"]).collect()}
    assert mixed["c1"] != alone["c1"]


def test_blank_ids_are_refused(spark):
    bad = make(spark, "datasets", {"dataset_id": "x", "source_url": " "})
    with pytest.raises(Exception, match="source_url"):
        records.dataset_records(bad).collect()


def test_context_nests_citations(corpus):
    found = json.loads(context.context_json(corpus, "dual eligibility", 1))
    assert found["results"][0]["citation"] == {"source_url": "https://ex.org/b.pdf", "source_document": "b.pdf", "page": 3}
    tools = context.Tools(corpus)
    assert [r["record_id"] for r in json.loads(tools.search_variables("bene_id"))] == ["mbsf__var__bene-id"]
    assert len(json.loads(tools.search_chunks("bene_id", 1))) == 1 and json.loads(tools.get_agent_context("mbsf", 2))["query"] == "mbsf"
    first = tools.records
    tools.use(corpus.filter("record_type = 'dataset'"))
    assert not first.is_cached and tools.records.is_cached and json.loads(tools.search_variables("BENE_ID")) == []


def test_variables_need_a_definition_on_their_first_line(spark):
    text = "BENE_ID: Beneficiary identifier, also known as beneficiary id, 2020.\nOTHER_ID\nOTHER_ID: too late"
    chunks = make(spark, "chunks", {"chunk_id": "c1", "text": text, "dataset": "D S", "source_document": "b.pdf", "url": "u"}, {"chunk_id": "c2", "text": "BENE_ID: id", "dataset": "D S", "source_document": "b.pdf", "url": "u"}, {"chunk_id": "c3", "text": "X_Y: z", "source_document": " "}, {"chunk_id": "c4", "text": "X_Y: z", "source_document": "lost"})
    rows, edges, failures, skipped = variables.extract_variables(chunks, files_of(spark, **{"b.pdf": b"x"}))
    row = rows.collect()
    assert [(r["variable_id"], r["definition"], r["aliases"], r["years"], r["chunk_id"]) for r in row] == [("d-s__var__bene-id", "Beneficiary identifier, also known as beneficiary id, 2020", "beneficiary id", "2020", "c1")]
    assert [e["relationship"] for e in edges.collect()] == ["contains"]
    assert {(f["chunk_id"], f["reason"]) for f in failures.collect()} == {("c3", "chunk has empty source_document"), ("c4", "source_document does not exist locally")}
    assert [s["variable_name"] for s in skipped.collect()] == ["OTHER_ID"]


def test_bad_chunk_lines(spark, tmp_path):
    good = {"chunk_id": "a", "source_document": "s", "page": None, "text": "t", "dataset": "d", "url": "u"}
    path = tmp_path / "chunks.jsonl"
    path.write_text(json.dumps(good) + "\n\n{not-json}\n" + json.dumps(good | {"page": 2}) + "\n")
    rows, failures = T.read_chunks(spark, str(path))
    assert [r["page"] for r in rows.orderBy("seq").collect()] == [None, 2]
    assert [f["chunk_id"] for f in failures.collect()] == ["line-3"]
    with pytest.raises(ValueError, match="line 3"):
        T.read_chunks(spark, str(path), strict=True)


def test_csv_round_trip_and_checks(spark, tmp_path):
    rows = make(spark, "inventory", {"url": 'a"b,\nc', "title": "", "resource_kind": "asset", "link_state": "live", "http_status": 200, "linked_documents": 1}, {"url": "u", "resource_kind": "other", "link_state": "dead"})
    T.write_csv(rows, "inventory", str(tmp_path / "i.csv"))
    assert (tmp_path / "i.csv").is_file() and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["i.csv"]
    back = T.read_csv(spark, "inventory", str(tmp_path / "i.csv")).orderBy("seq").collect()
    assert [(r["url"], r["title"], r["http_status"], r["linked_documents"]) for r in back] == [('a"b,\nc', "", 200, 1), ("u", "", None, 0)]
    (tmp_path / "bad.csv").write_text("url,title\nx,y\n")
    with pytest.raises(ValueError, match="missing required columns"):
        T.read_csv(spark, "inventory", str(tmp_path / "bad.csv"))
    T.write_csv(rows.withColumn("link_state", F.lit("odd")), "inventory", str(tmp_path / "odd.csv"))
    with pytest.raises(ValueError, match="link_state"):
        T.read_csv(spark, "inventory", str(tmp_path / "odd.csv"))


def test_whole_numbers_are_checked(spark, tmp_path):
    head = ",".join(TABLES["inventory"].names)
    (tmp_path / "n.csv").write_text(f"{head}\nu,t,other,,,2x0,live,1,,\n")
    with pytest.raises(ValueError, match="http_status must be a whole number, not '2x0'"):
        T.read_csv(spark, "inventory", str(tmp_path / "n.csv"))


def test_sinks_are_files_in_order(spark, tmp_path):
    many = spark.range(500).select(*(F.concat(F.lit(n), F.col("id").cast("string")).alias(n) if n not in ("page",) else F.lit(None).cast("int").alias(n) for n in TABLES["chunks"].names), F.col("id").alias("k"))
    path = tmp_path / "c.jsonl"
    T.write_chunks(many.repartition(7).orderBy("k"), str(path))
    assert path.is_file() and [json.loads(x)["chunk_id"] for x in path.read_text().splitlines()] == [f"chunk_id{i}" for i in range(500)]
    T.write_csv(make(spark, "datasets"), "datasets", str(tmp_path / "none.csv"))
    assert (tmp_path / "none.csv").read_text() == ",".join(TABLES["datasets"].names) + "\n"
    T.write_csv(make(spark, "datasets", {"dataset_id": "x"}), "datasets", str(tmp_path / "none.csv"))  # over what was there
    assert T.read_csv(spark, "datasets", str(tmp_path / "none.csv")).count() == 1


def test_a_cluster_must_name_its_shared_folder(spark):
    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815

        class getConf:  # noqa: N801
            get = staticmethod(lambda key: None)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        lineage.shared_folder(type("Session", (), {"sparkContext": Context})())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        lineage.shared_folder(type("Session", (), {"sparkContext": Context})())
    assert lineage.shared_folder(spark)


PAGE = b"<title>Part D Event" + TITLE_END.encode() + b"""</title></head><body>
<div class="views-field views-field-field-program-type"><div class="field-content"> Medicare </div></div>
<a href="/cms-data/files/cmds-entity">x</a><a href="/cms-data/files/cmds-entity">y</a><a href="/f/Codes.PDF">codes</a></body></html>"""


def test_extraction(spark):
    base = {"archive_state": "archived", "content_type": "text/html"}
    site = "https://ex.org/cms-data/files/"
    manifest = make(spark, "manifest",
        base | {"url": site + "pde", "resource_kind": "dataset_page", "local_path": "pde", "sha256": SHA(PAGE)},
        base | {"url": site + "pde/data-documentation", "resource_kind": "documentation_page", "local_path": "doc", "sha256": SHA(b"<title>Docs</title>")},
        base | {"url": "https://ex.org/f/Codes.PDF", "resource_kind": "asset", "asset_kind": "pdf", "content_type": "application/pdf", "source_url": "https://ex.org/cms-data", "source_title": "Codes", "local_path": "a", "sha256": SHA(b"a")},
        base | {"url": "https://ex.org/g/codes.pdf", "resource_kind": "asset", "source_url": site + "pde", "asset_kind": "pdf", "local_path": "a", "sha256": SHA(b"a")},
        base | {"url": "https://ex.org/f/lone.pdf", "resource_kind": "asset", "local_path": "a", "sha256": SHA(b"a")},
        base | {"url": "https://ex.org/f/far.pdf", "resource_kind": "asset", "source_url": site + "none", "local_path": "a", "sha256": SHA(b"a")},
        base | {"url": "u1", "resource_kind": "asset", "local_path": "gone", "sha256": "x"}, base | {"url": "u2", "resource_kind": "asset", "local_path": "a", "sha256": "x"},
        base | {"url": "u3", "resource_kind": "asset", "local_path": "a"}, base | {"url": "u4", "resource_kind": "asset"},
        {"url": "skipped", "resource_kind": "asset", "archive_state": "skipped"})
    e = extract.extract(manifest, files_of(spark, pde=PAGE, doc=b"<title>Docs</title>", a=b"a"))
    d = e.datasets.collect()
    assert [(r["dataset_id"], r["name"], r["program"]) for r in d] == [("pde", "Part D Event", "Medicare")]
    docs = {r["document_id"].rsplit("__", 1)[0]: r for r in e.documents.collect()}
    assert len(e.documents.collect()) == 3 and set(docs) == {"pde__data-documentation", "pde__codes_pdf"}
    assert docs["pde__data-documentation"]["title"] == "Docs" and docs["pde__data-documentation"]["document_kind"] == "html"
    assert {r["node_id"] for r in e.ontology_nodes.collect()} == {"pde", "program_medicare"}
    assert {(r["source_id"], r["target_id"], r["relationship"]) for r in e.ontology_edges.collect()} == {("pde", "program_medicare", "belongs_to"), ("pde", "cmds-entity", "related_to")}
    assert {r["relationship"] for r in e.document_edges.collect()} == {"has_document"}
    why = {r["url"]: r["reason"] for r in e.failures.collect()}
    assert why == {"https://ex.org/f/lone.pdf": "document source is not linked to a dataset page", "https://ex.org/f/far.pdf": "document references missing dataset", "u1": "archived file does not exist", "u2": "checksum mismatch", "u3": "archived row has no sha256", "u4": "archived row has no local path"}
    assert "checksum mismatch" in summaries.extraction_report(e)


def workbook() -> bytes:
    out = io.BytesIO()
    row = lambda *c: f"<worksheet xmlns='m'><sheetData><row>{''.join(c)}</row></sheetData></worksheet>"
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/sharedStrings.xml", "<sst xmlns='m'><si><t>shared</t></si></sst>")
        z.writestr("xl/worksheets/sheet10.xml", row("<c><v>ten</v></c>"))
        z.writestr("xl/worksheets/sheet2.xml", row("<c t='s'><v>0</v></c>", "<c/>", "<c t='inlineStr'><is><t>in</t></is></c>", "<c t='s'><v>9</v></c>"))
    return out.getvalue()


def pdf(flate: bool = False) -> bytes:
    pages = [b"BT /F1 12 Tf (Page one \\(1\\)) Tj ET", b"BT [(Pa) -10 (ge)] TJ T* <74776f> Tj ET"]
    body = b"%PDF-1.4\n"
    for p in pages:
        data = zlib.compress(p) if flate else p
        body += b"1 0 obj << /Length %d %s>> stream\n%s\nendstream endobj\n" % (len(data), b"/Filter /FlateDecode " if flate else b"", data)
    return body


def tree_pdf(packed: bool) -> bytes:
    """Four pages of a nested tree, out of order in the file, one blank; fonts with a map, with differences and with an encoding."""
    cmap = b"/CIDInit /ProcSet findresource begin 1 begincodespacerange <0000> <ffff> endcodespacerange 2 beginbfchar <0001> <00480069> <0002> <d83dde42> endbfchar 1 beginbfrange <0010> <0012> <0061> endbfrange end"
    stream = lambda d, more=b"": b"<< /Length %d %s/Filter /FlateDecode >>\nstream\n%s\nendstream" % (len(z := zlib.compress(d)), more, z)
    objects = {
        9: stream(b"BT /U 12 Tf 1 0 0 1 50 700 Tm <00010002> Tj 1 0 0 1 90 700 Tm <001000110012> Tj 0 -14 Td <0010> Tj ET"), 8: stream(b"BT /D 9 Tf (\\001 caf\\002 \\(x\\)) Tj 10 0 Td (same line) Tj T* [(wi) -300 (de) 20 (r)] TJ ET"),
        7: stream(b"0 0 10 10 re f"), 10: stream(b"BT /W 9 Tf (\\223q\\224 ) Tj"), 11: b"<< /Length 12 0 R >>\nstream\n(\\200\\) nested (ok)) Tj ET\nendstream", 12: b"25",
        20: stream(cmap), 1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [3 0 R 6 0 R] /Count 4 /Resources << /Font << /U 21 0 R /D 22 0 R /W 23 0 R >> >> >>",
        3: b"<< /Type /Pages /Parent 2 0 R /Kids [4 0 R 5 0 R 3 0 R] >>", 4: b"<< /Type /Page /Contents 9 0 R >>", 5: b"<< /Type /Page /Contents [7 0 R] >>", 6: b"<< /Type /Pages /Kids [13 0 R 14 0 R] >>",
        13: b"<< /Type /Page /Contents 8 0 R >>", 14: b"<< /Type /Page /Contents [10 0 R 11 0 R] >>", 21: b"<< /Type /Font /Subtype /Type0 /Encoding /Identity-H /ToUnicode 20 0 R >>",
        22: b"<< /Type /Font /Subtype /Type1 /Encoding << /Differences [1 /fi /eacute] >> >>", 23: b"<< /Type /Font /Subtype /TrueType /Encoding /WinAnsiEncoding >>",
    }
    out = b"%PDF-1.5\n"
    inside = [n for n in objects if packed and b"stream" not in objects[n] and n != 12]
    if inside:
        heads, bodies = b"", b""
        for n in inside:
            heads += b"%d %d " % (n, len(bodies))
            bodies += objects.pop(n) + b" "
        objects[30] = stream(heads + bodies, b"/Type /ObjStm /N %d /First %d " % (len(inside), len(heads)))
    for n, body in objects.items():
        out += b"%d 0 obj\n%s\nendobj\n" % (n, body)
    return out + b"trailer << /Root 1 0 R >>\n%%EOF"


@pytest.mark.parametrize("packed", [False, True])
def test_pdf_pages_come_from_the_tree(packed):
    assert S.pdf_pages(tree_pdf(packed)) == [(1, "Hi🙂 abc\na"), (3, "fi café (x) same line\nwi der"), (4, "“q” €) nested (ok)")]
    with pytest.raises(ValueError, match="encrypted"):
        S.pdf_pages(tree_pdf(packed).replace(b"trailer <<", b"trailer << /Encrypt 1 0 R"))
    for cut in range(0, len(tree_pdf(packed)), 97):  # damage gives fewer pages or an error, never a hang
        try:
            assert all(n >= 1 and t for n, t in S.pdf_pages(tree_pdf(packed)[:cut]))
        except (ValueError, KeyError, TypeError, zlib.error):
            pass


def test_extraction_parses_each_page_once(spark):
    found = extract.extract(make(spark, "manifest", {"url": "https://ex.org/cms-data/files/a", "resource_kind": "dataset_page", "archive_state": "archived", "content_type": "text/html", "local_path": "a", "sha256": SHA(b"<title>A - Site</title>")}), files_of(spark, a=b"<title>A - Site</title>"), " - Site")
    for name in ("datasets", "documents", "document_edges", "ontology_nodes", "ontology_edges", "failures"):
        plan = getattr(found, name)._jdf.queryExecution().executedPlan().toString()
        assert "page(" not in plan and "content#" not in plan, name
    assert found.datasets.first()["name"] == "A"


def test_readers_of_files():
    assert S.xlsx_sheets(workbook()) == [(1, "shared\tin\t9"), (2, "ten")]
    for flate in (False, True):
        assert S.pdf_pages(pdf(flate)) == [(1, "Page one (1)"), (2, "Page\ntwo")]
    with pytest.raises(ValueError):
        S.pdf_pages(b"no")


def test_parsing(spark):
    ds = make(spark, "datasets", {"dataset_id": "d", "local_path": "h", "source_url": "u"}, {"dataset_id": "../x", "local_path": "h"}, {"dataset_id": "e", "local_path": " "}, {"dataset_id": "f", "local_path": "lost"}, {"dataset_id": "g", "local_path": "blank"})
    docs = make(spark, "documents",
        {"document_id": "p", "dataset_id": "d", "document_kind": "pdf", "local_path": "p"}, {"document_id": "x", "dataset_id": "d", "document_kind": "xlsx", "local_path": "x"},
        {"document_id": "c", "dataset_id": "d", "document_kind": "csv", "local_path": "h"}, {"document_id": "n", "dataset_id": "zz", "document_kind": "pdf", "local_path": "p"},
        {"document_id": "q", "dataset_id": "d", "document_kind": "pdf", "local_path": "h"}, {"document_id": "s", "dataset_id": "d", "document_kind": "pdf", "local_path": "scan"})
    out = parse.parse(ds, docs, files_of(spark, h=b"<p>Hello</p>", p=pdf(), x=workbook(), blank=b"<nav>x</nav>", scan=b"%PDF-1.4"))
    assert {(r["chunk_id"], r["page"], r["text"]) for r in out.chunks.collect()} == {("d__chunk_0", None, "Hello"), ("p__p1__chunk_0", 1, "Page one (1)"), ("p__p2__chunk_0", 2, "Page\ntwo"), ("x__s1__chunk_0", 1, "shared in 9"), ("x__s2__chunk_0", 2, "ten")}
    assert {r["document_id"]: r["text"] for r in out.texts.collect()}["x"] == "shared\tin\t9\n\nten"
    why = sorted(r["reason"] for r in out.failures.collect())
    assert len(why) == 8 and any("failed to parse/chunk document: not a PDF" == w for w in why) and "extracted HTML text is empty" in why
    assert any(w.startswith("extracted PDF text is empty") for w in why) and "dataset file does not exist locally" in why and "unsupported document kind: csv" in why


def audited(spark, **change):
    content = {"h": b"h", "b": b"b"}
    url = "https://ex.org/d"
    rows = {
        "manifest": [{"url": url, "archive_state": "archived", "sha256": SHA(b"h")}, {"url": url + "2", "archive_state": "archived", "sha256": SHA(b"b")}],
        "datasets": [{"dataset_id": "d", "source_url": url, "local_path": "h", "sha256": SHA(b"h")}],
        "documents": [{"document_id": "x", "dataset_id": "d", "source_url": url + "2", "local_path": "b", "sha256": SHA(b"b")}],
        "document_edges": [{"source_id": "d", "target_id": "x", "relationship": "has_document", "source_url": url, "local_path": "h", "sha256": SHA(b"h")}],
        "variables": [{"variable_id": "v", "variable_name": "V_A", "dataset_id": "d", "definition": "x", "chunk_id": "c", "source_url": url, "source_document": "b"}],
        "variable_edges": [{"source_id": "d", "target_id": "v", "relationship": "contains", "source_url": url, "source_document": "b", "chunk_id": "c"}],
        "ontology_nodes": [{"node_id": "d", "node_class": "Dataset", "source_url": url, "local_path": "h", "sha256": SHA(b"h")}],
        "ontology_edges": [{"source_id": "d", "target_id": "d", "relationship": "related_to", "source_url": url}],
    } | change
    tables = {n: make(spark, n, *r) if r is not None else None for n, r in rows.items()}
    found = audit.findings(audit.Tables(files=files_of(spark, **content), **tables)).collect()
    df = spark.createDataFrame(found, TABLES["findings"])
    return [tuple(r) for r in found], audit.verdict(df).first()["verdict"]


def test_audit_passes_a_whole_set(spark):
    assert audited(spark) == ([], "pass")


@pytest.mark.parametrize(
    "change,want,verdict",
    [
        ({"documents": [{"document_id": "x", "dataset_id": "d", "source_url": "https://ex.org/d2", "local_path": "gone", "sha256": "s"}]}, {("x", "local_path", "error")}, "fix"),
        ({"datasets": [{"dataset_id": "d", "source_url": "https://ex.org/d", "local_path": "h", "sha256": "bad"}]}, {("d", "sha256", "error")}, "fix"),
        ({"document_edges": None}, {("N/A", "file_existence", "warning")}, "pass"),
        ({"document_edges": [{"source_id": "no", "target_id": "x"}]}, {("Line 2", "source_id", "error")}, "redo"),
        ({"ontology_edges": [{"source_id": "d", "target_id": "no"}]}, {("Line 2", "target_id", "warning")}, "pass"),
        ({"ontology_nodes": [{"node_id": "d", "node_class": "Odd", "source_url": "https://ex.org/d", "local_path": "h", "sha256": SHA(b"h")}]}, {("d", "node_class", "error")}, "redo"),
        ({"variables": [{"variable_id": " "}]}, {("N/A", "variable_id", "error"), ("Line 2", "target_id", "error")}, "redo"),
        ({"documents": [{"document_id": " x", "dataset_id": "zz", "source_url": "nope", "local_path": "b", "sha256": SHA(b"b")}]}, {(" x", "document_id", "warning"), (" x", "dataset_id", "error"), (" x", "source_url", "error"), ("Line 2", "target_id", "error")}, "redo"),
    ],
)
def test_audit_rules(spark, change, want, verdict):
    found, word = audited(spark, **change)
    assert {f[1:4] for f in found} == want and word == verdict


def test_audit_duplicates_and_empty_tables(spark):
    url = "https://ex.org/d"
    row = {"dataset_id": "d", "source_url": url, "local_path": "h", "sha256": SHA(b"h")}
    found, word = audited(spark, datasets=[row, row])
    assert [f[4] for f in found] == ["Duplicate dataset_id encountered: d"] and word == "redo"
    found, word = audited(spark, datasets=[], documents=[])
    assert {"dataset_count", "document_count"} <= {f[2] for f in found} and word == "redo"


def test_a_key_that_repeats_without_end(spark):
    rows = [{"dataset_id": "same", "source_url": "https://ex.org/a", "local_path": "a", "sha256": SHA(b"x")}] * 300 + [{"dataset_id": "other", "source_url": "https://ex.org/a", "local_path": "a", "sha256": SHA(b"x")}]
    marked = audit._occurrence(make(spark, "datasets", *rows), "dataset_id").select("dataset_id", "seq", "_again").collect()
    assert len(marked) == 301 and [(r["dataset_id"], r["seq"]) for r in marked if not r["_again"]] in ([("same", 0), ("other", 300)], [("other", 300), ("same", 0)])


def test_reports_show_bounded_rows(spark):
    lines = summaries.rows_table(spark.range(40).selectExpr("id AS url"), ["url"], 25)
    assert len(lines) == 2 + 25 + 1 and "15" in lines[-1]


def test_many_errors_mean_redo(spark):
    found, word = audited(spark, ontology_nodes=[{"node_id": f"n{i}", "node_class": "Dataset", "source_url": "https://ex.org/d", "local_path": "h", "sha256": "bad"} for i in range(6)])
    assert len(found) == 6 and word == "redo"


def the_web(spark, **extra):
    listing = '<title>All</title><a href="/cms-data/files/pde">PDE</a><a href="/cms-data/files/pde">again</a><a href="/f/a.pdf">A</a><a href="/other">o</a>'
    pages = {
        "https://ex.org/cms-data?page=0": (200, "text/html", listing),
        "https://ex.org/cms-data?page=1": (200, "text/html", listing),
        "https://ex.org/cms-data/files/pde": (200, "text/html", '<title>Own</title><a href="/cms-data/files/pde/data-documentation">Docs</a><a href="/f/b.xlsx">B</a>'),
        "https://ex.org/cms-data/files/pde/data-documentation": (200, "text/html", "<h1>Documentation</h1>"),
        "https://ex.org/f/a.pdf": (200, "application/pdf", ""),
        "https://ex.org/f/b.xlsx": (404, None, ""),
    } | extra
    return crawl.table_web(spark.createDataFrame([(u, *p) for u, p in pages.items()], "url string, status int, content_type string, html string"))


def test_crawl(spark):
    c = crawl.crawl(spark, crawl.CrawlConfig("https://ex.org/cms-data", 5), the_web(spark))
    rows = {r["url"].removeprefix("https://ex.org"): r for r in c.inventory.collect()}
    assert len(rows) == 6 and rows["/cms-data/files/pde"]["title"] == "PDE" and rows["/cms-data/files/pde/data-documentation"]["title"] == "Docs"
    assert rows["/f/b.xlsx"]["link_state"] == "dead" and rows["/f/b.xlsx"]["asset_kind"] == "xlsx" and rows["/f/a.pdf"]["source_title"] == "All"
    assert rows["/cms-data?page=0"]["linked_documents"] == 2 and rows["/cms-data/files/pde"]["linked_documents"] == 2
    assert c.summary["dead_links"] == 1 and c.summary["listing_page"] == 2 and c.summary["duplicates_skipped"] == 4


def test_crawl_limits_and_transient_states(spark):
    web = the_web(spark, **{"https://ex.org/cms-data/files/pde": (503, "text/html", ""), "https://ex.org/f/a.pdf": (503, None, "")})
    c = crawl.crawl(spark, crawl.CrawlConfig("https://ex.org/cms-data", 1), web)
    states = {r["url"]: r["link_state"] for r in c.inventory.collect()}
    assert states["https://ex.org/cms-data/files/pde"] == states["https://ex.org/f/a.pdf"] == "unknown" and c.summary["transient_links"] == 2
    none = crawl.crawl(spark, crawl.CrawlConfig("https://ex.org/cms-data", 1, 0, 0), the_web(spark))
    assert {r["resource_kind"] for r in none.inventory.collect()} == {"listing_page", "dataset_page"}
    assert "Dead links" in summaries.inventory_report(none.inventory, none.summary)
    with pytest.raises(ValueError):
        crawl.CrawlConfig("x", 0)


def test_archive(spark, tmp_path):
    live = {"link_state": "live", "http_status": 200}
    inv = make(spark, "inventory",
        live | {"url": "https://8.8.8.8/cms-data/files/pde", "resource_kind": "dataset_page"}, live | {"url": "https://8.8.8.8/f/a.pdf", "resource_kind": "asset", "asset_kind": "pdf"},
        live | {"url": "file:///x.pdf", "resource_kind": "asset"}, live | {"url": "https://8.8.8.8/f/fail.pdf", "resource_kind": "asset"}, {"url": "https://8.8.8.8/dead", "resource_kind": "asset", "link_state": "dead", "http_status": 404})
    get = lambda url: web.Answer(url, 503, error="HTTP 503") if "fail" in url else web.Answer(url, 200, "text/html", b"body")
    first = archive.archive(inv, str(tmp_path), download=get).collect()
    assert [r["archive_state"] for r in first] == ["archived", "archived", "failed", "failed", "skipped"]
    assert "absolute http(s)" in first[2]["error"] and first[3]["http_status"] == 503 and first[0]["sha256"] == SHA(b"body") and first[4]["error"] == archive.SKIPPED

    def never(url):
        raise AssertionError(url)

    log = tmp_path / "downloads.log"

    def noted(url):
        with open(log, "a") as f:
            f.write(url + "\n")
        return web.Answer(url, 200, "text/html", b"body")

    kept = archive.archive(inv.limit(2), str(tmp_path / "twice"), download=noted)
    assert kept.count() == 2 and len(kept.collect()) == 2 and len(log.read_text().split()) == 2  # asked twice, fetched once
    log.unlink()
    again = archive.archive(inv.limit(2), str(tmp_path), make(spark, "manifest", *[r.asDict() for r in first[:2]]), S.read_files(spark, str(tmp_path)), download=never).collect()
    assert [(r["archive_state"], r["sha256"]) for r in again] == [("archived", SHA(b"body"))] * 2


class Reply:
    def __init__(self, status, body=b"", **headers):
        self.status, self.body, self.headers = status, io.BytesIO(body), headers

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    def read(self, n):
        return self.body.read(n)


def test_requests_retry_and_stop():
    from urllib.error import HTTPError, URLError

    waits = []
    tries = iter([HTTPError("u", 503, "", {"Retry-After": "7"}, None), URLError("down"), Reply(200, b"ok", **{"Content-Type": "Text/HTML; x"})])

    def opener(*_, **__):
        r = next(tries)
        if isinstance(r, Exception):
            raise r
        return r

    a = web.request("http://x", opener=opener, sleep=waits.append)
    assert (a.status, a.body, a.content_type, waits) == (200, b"ok", "text/html", [7.0, 2.0])
    big = web.request("http://x", opener=lambda *_, **__: Reply(200, b"x" * 10), most=5)
    assert big.error and not big.body
    gone = web.request("http://x", opener=lambda *_, **__: (_ for _ in ()).throw(HTTPError("u", 404, "", {}, None)), sleep=waits.append)
    assert gone.status == 404 and len(waits) == 2
    asked = []
    web.probe("http://x", ask=lambda url, **k: asked.append(k) or web.Answer(url, 405 if k.get("method") else 206))
    assert asked[1]["headers"] == {"Range": "bytes=0-0"}
    assert web.retry_after("0", 3.0) == 3.0 and web.retry_after("soon", 1.0) == 1.0


def test_winners(spark):
    df = spark.createDataFrame([("a", "", 1), ("a", "x", 2), ("a", "y", 3), ("b", "", 4)], "k string, t string, seq long")
    assert {(r["k"], r["t"]) for r in dedup.last_wins(df, ["k"]).collect()} == {("a", "y"), ("b", "")}
    assert {(r["k"], r["t"]) for r in dedup.first_wins(df, ["k"]).collect()} == {("a", ""), ("b", "")}
    assert {tuple(r) for r in dedup.merged(df, "k", ["t"]).collect()} == {("a", "x", 1, 3), ("b", "", 4, 1)}


def test_ranks_without_a_single_task(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("(id * 7919) % 1000 as k")
    assert [tuple(r) for r in dedup.ranked(df, "k", "place", 5).orderBy("k").collect()] == [(k, k + 5) for k in range(1000)]


def test_streamed_chunks_equal_batch_chunks(spark, tmp_path):
    from quarry.operators.chunking import chunks_of
    from quarry.streaming import chunks as C

    texts = spark.createDataFrame([("a", "word " * 300), ("b", ""), ("c", None)], C.TEXTS)
    texts.write.parquet(str(tmp_path / "in"))
    C.append_chunks(C.text_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("chunk_id").collect()
    assert [r["text"] for r in got] == chunks_of("word " * 300) and {r["document_id"] for r in got} == {"a"}


def test_streamed_variables_equal_batch_variables(spark, tmp_path):
    rows = [{"chunk_id": f"c{i}", "source_document": "d", "dataset": "mbsf", "url": "https://ex.org/b", "text": t} for i, t in enumerate(("BENE_ID: short one, 1999", "see\nBENE_ID - a much longer definition of it, aka bid", "CLM_NO means claim number.\nBENE_ID is late", "OTHER_NAME only stands here"))]
    chunks = make(spark, "chunks", *rows)
    for at, n in ((0, 2), (2, 4)):
        chunks.filter(f"seq >= {at} and seq < {n}").select(*TABLES["chunks"].names, "seq").write.mode("append").parquet(str(tmp_path / "in"))
        stream.append_candidates(stream.chunk_rows(spark, str(tmp_path / "in"), 1), str(tmp_path / "out"), str(tmp_path / "at"))
    got = sorted(map(tuple, stream.variables_so_far(spark, str(tmp_path / "out")).collect()), key=repr)
    assert got == sorted(map(tuple, variables.extract_variables(chunks)[0].collect()), key=repr) and len(got) == 2


def test_estimates_of_sizes_do_not_grow_with_rounds(spark):
    now = spark.range(200).withColumn("n", F.col("id") + 1)
    for _ in range(7):
        now = lineage.cut(now.join(now.select(F.col("id").alias("n"), F.col("n").alias("m")), "n").select("id", F.col("m").alias("n")))
        assert "E+" not in now._jdf.queryExecution().optimizedPlan().stats().simpleString()
    assert {tuple(r) for r in now.collect()} == {(i, i + 128) for i in range(73)}


def test_deep_crawl(spark):
    """A chain of pages: each level costs the same few checkpoints, and the driver's estimates stay small."""
    site = "https://ex.org/cms-data/files/s"
    web = {f"{site}{i}": (200, "text/html", f'<a href="/cms-data/files/s{i + 1}">n</a><a href="/f/{i % 3}.pdf">a</a>') for i in range(7)}
    web["https://ex.org/cms-data?page=0"] = (200, "text/html", '<a href="/cms-data/files/s0">n</a>')
    said, made = [], []
    kept, crawl.cut = crawl.cut, lambda df: made.append(kept(df)) or made[-1]
    try:
        c = crawl.crawl(spark, crawl.CrawlConfig("https://ex.org/cms-data", 1), crawl.table_web(spark.createDataFrame([(u, *p) for u, p in web.items()], "url string, status int, content_type string, html string")))
    finally:
        crawl.cut = kept
    assert c.summary["asset"] == 3 and c.summary["dataset_page"] == 8 and c.summary["duplicates_skipped"] == 4
    assert not any("E+" in df._jdf.queryExecution().optimizedPlan().stats().simpleString() for df in made)
    assert len(made) <= 2 * 9 + 2


def test_postings_of_repeated_and_own_ids(spark, monkeypatch):
    """Records with ids of their own are counted without a shuffle; repeated and NULL ids are added up."""
    rows = [("a", "x y x"), ("b", None), ("c", "Z, x"), ("d", "  ")]
    more = [("c", "x x x x"), (None, "n"), (None, "N n m")]
    as_set = lambda df: {tuple(r) for r in df.select("term", "record_id", "tf", "length").collect()}
    own = search.postings(spark.createDataFrame(rows, "record_id string, text string"))
    assert "Exchange" not in own._jdf.queryExecution().executedPlan().toString()
    assert as_set(own) == {("x", "a", 2, 3), ("y", "a", 1, 3), ("z", "c", 1, 2), ("x", "c", 1, 2)}
    want = {("x", "a", 2, 3), ("y", "a", 1, 3), ("z", "c", 1, 2), ("x", "c", 5, 4), ("n", None, 3, 3), ("m", None, 1, 3)}
    both = spark.createDataFrame(rows + more, "record_id string, text string")
    assert as_set(search.postings(both)) == want == as_set(search.postings(search.tokenized(both)))
    monkeypatch.setattr(search, "SENT", 0)
    assert as_set(search.postings(both)) == want
    monkeypatch.setattr(search, "PAIRS", 1)
    assert as_set(search.postings(spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "record_id long, text string"))) == {("x", 0, 2, 3), ("y", 0, 1, 3), ("z", 2, 1, 2), ("x", 2, 1, 2)}
