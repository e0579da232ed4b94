"""Each stage of the pipeline against its operator and a brute-force version, in order."""

from __future__ import annotations

from pathlib import Path

import corpus_pipeline
from quarry.llm import decontaminate, pii, quality, queries, simhash

from .test_operators import brute, naive_print, slow_contamination

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, small, tmp_path):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near duplicates", "decontamination", "personal data", "byte-level BPE"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    steps = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, steps[-1], small).write.parquet(str(tmp_path / str(i)))
        steps.append(spark.read.parquet(str(tmp_path / str(i))))
    assert all(s.columns == COLUMNS for s in steps[:-1])
    rows = [{r["doc_id"]: r for r in s.collect()} for s in steps]
    scored = queries.op10_quality(spark, small).collect()
    assert set(rows[1]) == {r["doc_id"] for r in scored if r["score"] >= quality.THRESHOLD}
    prints = {i: naive_print(r["text"]) for i, r in rows[1].items()}
    root = brute(list(prints.values()))
    least = {}
    for i, p in prints.items():
        least[root[p]] = min(least.get(root[p], i), i)
    assert set(rows[2]) == set(least.values())
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    found = slow_contamination([(i, r["text"]) for i, r in rows[2].items()], items)
    assert set(rows[3]) == {i for i, f in found.items() if not f[1]}
    field = pii.trained()
    for i, r in rows[3].items():
        text = pii.redacted(r["text"], pii.all_spans(r["text"], field)[1])
        assert rows[4][i]["text"] == text and rows[4][i]["n_chars"] == len(text) and rows[4][i]["source"] == r["source"]
    codec = queries.tokenizer()
    assert all(rows[5][i]["n_tokens"] == len(codec.encode(rows[4][i]["text"])) for i in rows[4]) and set(rows[5]) == set(rows[4])
    made = corpus_pipeline.run(spark, small)
    assert {tuple(r) for r in made.collect()} == {tuple(r) for r in rows[5].values()}
    last = made.inputFiles()[0].removeprefix("file:").rsplit("/", 2)[0]
    assert [p.name for p in Path(last).iterdir()] == ["4"]  # what earlier stages wrote is gone


def test_stages_take_awkward_rows(spark, edges, small):
    docs = edges.select(*COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        n = out.count()
        assert n <= docs.count()
        if name in ("personal data", "byte-level BPE"):
            assert n == docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), small).count() == 0


def test_keepers_keep_columns(spark, edges):
    assert decontaminate.clean(edges, spark.createDataFrame([(1, "twice for you")], "item_id long, text string")).columns == edges.columns
    assert simhash.representatives(edges).columns == edges.columns
