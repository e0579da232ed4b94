"""Licence notices: exact phrases, and short notices with a bounded number of edits.

A notice with at most k edits keeps at least one of k + 1 pieces intact.  So the
pieces of every notice are exact seeds: one pass of a set matcher over a batch
tells which texts hold any of them, and only those are looked at again.  Where a
seed stands, and the stretch of text that the seed's place allows lacks no more than k
of the notice's letters, the regex library matches the notice within k edits in
that stretch, and so gives the edits and the span.  Spans are places of words; a span's score is one less its edits over the
notice's length.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .textops import LOWER_ALNUM, bounded_batches, id_text, raw, slices, strings, word_count

# The base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices as words, their labels, and the edits allowed: about one in ten letters.
NOTICES = [
    ("released under the mit license", "mit", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 7),
    ("licensed under the apache license version 2 0", "apache-2.0", 4),
    ("under the terms of the gnu general public license", "gpl", 4),
    ("licensed under the gnu general public license version", "gpl", 5),
    ("licensed under cc by nc 4 0", "cc-by-nc", 2),
    ("licensed under a creative commons attribution", "cc", 4),
    ("redistribution and use in source and binary forms", "bsd", 4),
    ("subject to the terms of the mozilla public license", "mpl", 5),
    ("all rights reserved worldwide", "reserved", 2),
    ("no part of this work may be reproduced", "reserved", 3),
]


def seeds(notice: str, k: int) -> list[tuple[int, str]]:
    """The k + 1 pieces of a notice with their places; as even as can be, never blank at an end."""
    cuts = [round(i * len(notice) / (k + 1)) for i in range(k + 2)]
    out = []
    for a, b in zip(cuts, cuts[1:]):
        piece = notice[a:b]
        lead = len(piece) - len(piece.lstrip(" "))
        out.append((a + lead, piece.strip(" ")))
    return out


_SEEDS = [(i, at, piece) for i, (notice, _, k) in enumerate(NOTICES) for at, piece in seeds(notice, k)]
_LETTERS = [Counter(n.replace(" ", "")).most_common() for n, _, _ in NOTICES]
_FUZZY = [regex.compile(rf"(?b)(?:{regex.escape(n)}){{e<={k}}}") for n, _, k in NOTICES]
#: What one of stands in any text with a find; blanks may be several there.
_ANY = "|".join(sorted({p.replace(" ", " +") for _, _, p in _SEEDS} | {p.replace(" ", " +") for p in PHRASES}))


def _lacking(letters: list[tuple[str, int]], piece: str, k: int) -> bool:
    """Whether a stretch lacks more than k of a notice's letters: each costs an edit."""
    for c, n in letters:
        k -= max(0, n - piece.count(c))
        if k < 0:
            return True
    return False


def notices_in(line: str) -> list[tuple[int, int, str, int, int]]:
    """(start, end, label, edits, length) of each notice found in single-spaced lower-case words.

    Of overlapping finds of one label the one with the fewest edits, then the
    first, then the longest stays.
    """
    found = set()
    tried: set[tuple[int, int]] = set()
    for i, at, piece in _SEEDS:
        notice, label, k = NOTICES[i]
        here = line.find(piece)
        while here >= 0:
            a, b = max(0, here - at - k), min(len(line), here - at + len(notice) + k)
            if (i, here - at) not in tried:
                tried.add((i, here - at))
                if not _lacking(_LETTERS[i], line[a:b], k) and (m := _FUZZY[i].search(line, a, b)):
                    start, end = m.span()
                    # Words are whole: an edge inside a word, or on a blank, moves to the word's.
                    start += len(line[start:end]) - len(line[start:end].lstrip(" "))
                    end = start + len(line[start:end].rstrip(" "))
                    found.add((start, end, label, sum(m.fuzzy_counts), len(notice)))
            here = line.find(piece, here + 1)
    kept: list[tuple[int, int, str, int, int]] = []
    taken: dict[str, list[tuple[int, int]]] = {}  # disjoint spans of each label, sorted
    for f in sorted(found, key=lambda f: (f[3], f[0], f[0] - f[1], f[2])):
        own = taken.setdefault(f[2], [])
        at = bisect_right(own, (f[0], f[1]))
        if (at == 0 or own[at - 1][1] <= f[0]) and (at == len(own) or own[at][0] >= f[1]):
            own.insert(at, (f[0], f[1]))
            kept.append(f)
    return sorted(kept)


def scan_words(words: list[str]) -> dict:
    """What a list of lower-case words holds: base places, fuzzy spans, labels and a score."""
    line = " ".join(words)
    padded = f" {line} "
    starts = np.cumsum([0] + [len(w) + 1 for w in words[:-1]]).tolist()
    places: list[tuple[int, str]] = []
    for phrase, label in PHRASES.items():
        at = padded.find(f" {phrase} ")
        while at >= 0:
            places.append((bisect_right(starts, at) - 1, label))
            at = padded.find(f" {phrase} ", at + 1)
    spans = [(bisect_right(starts, a) - 1, bisect_right(starts, max(a, b - 1)) - 1, label, edits, 1 - edits / length) for a, b, label, edits, length in notices_in(line)]
    base = sorted({label for _, label in places})
    return {
        "n_base": len(places),
        "first_word": min((w for w, _ in places), default=None),
        "last_word": max((w for w, _ in places), default=None),
        "base_labels": ",".join(base),
        "labels": ",".join(sorted({*base, *(s[2] for s in spans)})),
        "score": 1.0 if places else max((s[4] for s in spans), default=0.0),
        "spans": ",".join(f"{label}:{a}:{b}:{edits}" for a, b, label, edits, _ in spans),
    }


_NOTHING = {"n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "spans": ""}
_TYPES = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": pa.string()}


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        data, offs = raw(batch.column("text"))
        lowered = LOWER_ALNUM[data]
        texts = strings(lowered, offs)
        likely = pc.match_substring_regex(texts, _ANY).to_numpy(zero_copy_only=False)
        rows = [_NOTHING] * len(texts)
        for i in np.flatnonzero(likely).tolist():
            rows[i] = scan_words([w for w in texts[i].as_py().split(" ") if w])
        columns = {"doc_id": batch.column("doc_id"), "n_words": pa.array(word_count(lowered, offs))}
        columns |= {c: pa.array([r[c] for r in rows], t) for c, t in _TYPES.items() if c not in columns}
        yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels, score, spans (label:first word:last word:edits).

    Null and empty texts have no words, empty labels and score 0; repeated rows
    get equal results; texts of any length are scanned whole.
    """
    bounded_batches(docs.sparkSession)
    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double"}
    return id_text(docs).mapInArrow(_scan, ", ".join(f"{c} {kinds[t]}" for c, t in _TYPES.items()))
