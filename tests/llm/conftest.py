from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fingerprint string, fp long, words string, key long, media binary, held_out boolean, text_hash long, grp long, label int"

LONG = "lorem 4111111111111111 ipsum " * 9000 + "x" * 50_000
EDGES = [
    (None, None), (None, "no id, some words here"), (1, ""), (2, None), (3, LONG), (4, "the same text stands here twice for you"), (4, "the same text stands here twice for you"),
    (4, "another text under an id that is taken"), (5, "   \t\n "), (6, "É È ünïcödé 🙂 a@b.example +1 (499) 555-6503"), (7, "one"), (8, "THE same text stands here twice FOR you"), (9, "\x00\x0b|||---"),
    (10, "released under the mit licence and more words"), (11, "1" * 3000), (12, "@" * 2000), (13, "a.b" * 2000), (14, "cc by cc by All rights, reserved"), (-20, "negative id text with several words in it"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Awkward rows, with extra columns whose names operators might use."""
    rows = [(i, t, None, None, None, None, None, None, None, None, None, None, None, None, None) for i, t in EDGES]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, q, t) for i in range(15) for q, t in ((i % 2, int(i % 5 == 0)),)] + [(None, 1, 1), (3, None, None), (4, 7, 7)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.01"
