"""The command line over a small folder."""

from __future__ import annotations

import hashlib
import json

import pytest

from quarry.cli import main, parser


@pytest.fixture()
def folder(tmp_path):
    body = b"<title>Set</title><p>BENE_ID: Beneficiary identifier, aka bid.</p>"
    (tmp_path / "data/raw").mkdir(parents=True)
    (tmp_path / "data/raw/pde.html").write_bytes(body)
    sha = hashlib.sha256(body).hexdigest()
    (tmp_path / "manifests").mkdir()
    head = "url,resource_kind,asset_kind,source_url,source_title,content_type,http_status,archive_state,downloaded_at_utc,sha256,local_path,error"
    rows = [f"https://ex.org/cms-data/files/pde,dataset_page,,,,text/html,200,archived,,{sha},data/raw/pde.html,", f"https://ex.org/cms-data/files/pde/data-documentation,documentation_page,,,,text/html,200,archived,,{sha},data/raw/pde.html,"]
    (tmp_path / "manifests/archive_manifest.csv").write_text("\n".join([head, *rows]) + "\n")
    return tmp_path


def test_phases_in_a_row(spark, folder, capsys):
    run = lambda *a: main([a[0], "--base", str(folder), *a[1:]], spark)
    assert run("search", "x") == 1 and "missing" in capsys.readouterr().err
    assert run("qa") == 1
    assert run("extract") == 0
    assert run("parse", "--chunk-size", "200", "--chunk-overlap", "20") == 0
    assert (folder / "data/parsed/texts/pde.txt").read_text().startswith("BENE_ID")
    first = json.loads((folder / "data/parsed/chunks/pde__chunk_0.json").read_text())
    assert list(first) == ["chunk_id", "source_document", "page", "text", "dataset", "url"] and first["page"] is None
    assert run("variables") == 0
    assert run("qa") == 0, (folder / "_workspace/06_qa_review.md").read_text()
    assert "PASS" in (folder / "_workspace/06_qa_review.md").read_text()
    capsys.readouterr()
    assert run("search", "BENE_ID", "--json") == 0
    assert json.loads(capsys.readouterr().out)[0]["record_id"] == "pde__var__bene-id"
    assert run("search", "BENE_ID") == 0 and "pde__var__bene-id" in capsys.readouterr().out
    assert run("context", "beneficiary", "--limit", "1") == 0
    assert len(json.loads(capsys.readouterr().out)["results"]) == 1
    assert run("search", " ") == 1
    assert run("search") == 1 and run("search", "a", "--query", "b") == 1
    capsys.readouterr()
    elsewhere = folder / "elsewhere.csv"
    elsewhere.write_bytes((folder / "data/metadata/variables.csv").read_bytes())
    (folder / "data/metadata/variables.csv").unlink()
    assert run("search", "--query", "BENE_ID", "--variables-metadata", str(elsewhere), "--json") == 0
    assert json.loads(capsys.readouterr().out)[0]["record_id"] == "pde__var__bene-id"
    assert (folder / "data/metadata/datasets.csv").is_file() and (folder / "data/parsed/chunks.jsonl").is_file() and (folder / "_workspace/06_qa_findings.csv").is_file()
    assert run("parse", "--chunk-size", "0") == 1


def test_aliases_of_flags():
    assert parser().parse_args(["inventory", "--base-url", "x", "--max-listing-pages", "3"]).max_pages == 3
    a = parser().parse_args(["inventory", "--base-url", "x", "--timeout-seconds", "3", "--request-delay-seconds", "0", "--progress-interval", "0", "--output", "o.csv", "--workspace-dir", "w"])
    assert (a.timeout, a.delay, a.progress, str(a.inventory), str(a.workspace)) == (3.0, 0.0, 0, "o.csv", "w")
    a = parser().parse_args(["archive", "--timeout-seconds", "3", "--request-delay-seconds", "1", "--manifest-output", "m.csv", "--raw-root", "r"])
    assert (a.timeout, a.delay, str(a.manifest), str(a.raw)) == (3.0, 1.0, "m.csv", "r")
