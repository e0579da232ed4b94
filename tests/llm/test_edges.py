"""Every operator on awkward rows: one row out for each row in, none from none, equal for equal texts."""

from __future__ import annotations

from collections import Counter

import pytest

from quarry.llm import decontaminate, jpeg, licenses, ngram, pii, preferences, quality, queries, simhash, toxicity

from .conftest import EDGES


@pytest.fixture(scope="session")
def benchmark(spark):
    rows = [(1, "several words in it"), (1, "several words in it"), (None, "the same text stands"), (2, None), (3, ""), (4, "ipsum"), (5, "Under an ID")]
    return spark.createDataFrame(rows, "item_id long, text string")


def operators(labels, benchmark):
    return {
        "jpeg": lambda d: jpeg.media_features(jpeg.media_column(d)),
        "pii": pii.detect,
        "ngram": ngram.score,
        "toxicity": lambda d: toxicity.classify(d, labels),
        "simhash": simhash.near_duplicates,
        "licenses": licenses.scan,
        "bpe": lambda d: queries.bpe.round_trip(d, queries.tokenizer()),
        "decontaminate": lambda d: decontaminate.contamination(d, benchmark),
        "quality": lambda d: quality.classify(d, labels),
    }


NAMES = ["jpeg", "pii", "ngram", "toxicity", "simhash", "licenses", "bpe", "decontaminate", "quality"]


@pytest.mark.parametrize("name", NAMES)
def test_a_row_for_each_row(name, edges, labels, benchmark):
    rows = operators(labels, benchmark)[name](edges).collect()
    assert len(rows) == len(EDGES)
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(i) for i, _ in EDGES)
    skip = {"doc_id"} | ({"held_out"} if name in ("ngram", "toxicity", "quality") else set())
    strip = lambda r: tuple(v for k, v in r.asDict().items() if k not in skip)
    empty = {strip(r) for r in rows if r["doc_id"] in (1, 2)}
    assert len(empty) == 1  # null counts as the empty text
    twice = Counter(strip(r) for r in rows if r["doc_id"] == 4)  # three rows, two of them alike
    assert sum(twice.values()) == 3 and max(twice.values()) >= 2


def same(one, two):
    """Equal values, floats but for the last digits."""
    return len(one) == len(two) and all(a == b or isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 1e-9 * max(1, abs(a)) for a, b in zip(one, two))


@pytest.mark.parametrize("name", NAMES)
def test_equal_texts_give_equal_results(name, spark, benchmark):
    texts = list(dict.fromkeys(t for _, t in EDGES))
    labels = spark.createDataFrame([(1000 + i, i // 2 % 2, int(i // 2 % 5 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame([(1000 + 2 * i + j, t) for i, t in enumerate(texts) for j in (0, 1)], "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: tuple(v for k, v in r.asDict().items() if k not in ("doc_id", "held_out")) for r in operators(labels, benchmark)[name](frame).collect()}
    assert len(got) == 2 * len(texts)
    for i, t in enumerate(texts):
        assert same(got[1000 + 2 * i], got[1001 + 2 * i]), t and t[:50]
    assert len(set(got.values())) > 2  # and other texts give other results


@pytest.mark.parametrize("name", NAMES)
def test_no_rows_from_no_rows(name, nothing, no_labels, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert operators(no_labels, none)[name](nothing).collect() == []


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_labels_of_documents_that_are_not_there(name, edges, spark):
    away = spark.createDataFrame([(i, i % 2, i % 2) for i in range(5000, 5020)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in operators(away, None)[name](edges).collect()} == {0.5}


@pytest.mark.parametrize("name", ["toxicity", "quality"])
def test_without_labels_every_score_is_the_prior(name, edges, no_labels):
    scores = {r["score"] for r in operators(no_labels, None)[name](edges).collect()}
    assert scores == {0.5}


def test_empty_benchmark_is_clean(edges, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in decontaminate.contamination(edges, none).collect())


def test_no_conversations(spark):
    assert preferences.preferences(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_results_do_not_depend_on_partitions(edges, labels, benchmark):
    ops = operators(labels, benchmark)
    for name in ("ngram", "simhash", "decontaminate", "quality", "toxicity"):
        coarse = lambda r: repr([round(v, 6) if isinstance(v, float) else v for v in r])
        one, two = (sorted((tuple(r) for r in ops[name](edges.repartition(n)).collect()), key=coarse) for n in (1, 5))
        assert len(one) == len(two) == len(EDGES)
        assert all(same(a, b) for a, b in zip(one, two)), name
