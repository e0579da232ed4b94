"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Every word of every labelled text is a term, and so is the stem of every longer
word, its first ``STEM`` letters (a stemmer that needs to know no language); none
is selected, joined or rounded.  A term's weight in a text is (1 + ln count) times
its inverse document frequency.  Frequency is counted in either class, and the idf
is the distance between the two: |ln share of label 1 texts with the term - ln
share of label 0 texts with it|, both shares smoothed by ``SMOOTH`` texts of the
sample's mix ("delta TF-IDF").  The plain idf of all texts together finds few toxic
documents here, as their toxic words are few among many rare ones (README has the
figures).

The examples stand in an inverted index over ranges of ``BLOCK`` examples, weights
rounded up; each frequent term has its largest weight in each range.  A query adds
up the lists of its rarer terms, then frequent terms from the largest possible
share down, until those left over could not carry a range past the k-th sum; with
their range maxima as bounds, whole ranges drop out, and what remains is scored
again in double precision.  So the neighbours are exact however little of the index
is read.  Examples with equal vectors are one with two counts.

Votes weigh by distance; a logistic curve over the vote, fitted on the leave-one-out
votes of all labelled rows of the sample, makes it a probability, and the nearest
examples are the evidence.

The sample is bounded by ``MAX_TRAIN_DOCS`` labelled rows, and it alone bounds the
index.  All documents are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sample import labelled_sample
from .textops import LOWER_ALNUM, bounded_batches, fold, id_text, pack, raw, slices, split, translated, unpack, word_count

MAX_TRAIN_DOCS = 20_000
THRESHOLD = 0.7
K, BLOCK, SMOOTH, STEM = 10, 32, 2.0, 5
CACHE = 100_000
GRAIN = 1 << 16  # steps of a weight in a list
TEXTS = 12 << 20  # bytes of texts that are looked up in the vocabulary together
DENSE, FREQUENT, TOGETHER = 20, 50, 256  # a term in more than one example of DENSE has a dense column, of FREQUENT range maxima

Part = tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of a column, and (row, term, count) by row and term."""
    words, n = split(translated(texts, LOWER_ALNUM))
    coded = words.dictionary_encode()
    names = coded.dictionary.cast(pa.large_string())
    row, code = np.repeat(np.arange(len(n)), n), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    stems = pc.binary_join_element_wise(pc.utf8_slice_codeunits(names, 0, STEM), pa.scalar("*", pa.large_string()), pa.scalar("", pa.large_string())).dictionary_encode()
    longer = pc.utf8_length(names).to_numpy(zero_copy_only=False) > STEM
    stem = np.where(longer, stems.indices.to_numpy(zero_copy_only=False).astype(np.int64) + len(names), -1)[code]
    size = len(names) + len(stems.dictionary) + 1
    key, count = np.unique(np.concatenate([row * size + code, row[stem >= 0] * size + stem[stem >= 0]]), return_counts=True)
    return pa.concat_arrays([names, stems.dictionary.cast(pa.large_string())]), key // size, key % size, count


def contrast(df0: np.ndarray, df1: np.ndarray, n0: int, n1: int) -> np.ndarray:
    """The idf of terms in df0 of n0 texts of label 0 and in df1 of n1 of label 1."""
    share = n1 / (n0 + n1)
    return np.abs(np.log((df1 + SMOOTH * share) / (n1 + SMOOTH)) - np.log((df0 + SMOOTH * (1 - share)) / (n0 + SMOOTH)))


class Index:
    """Labelled examples, searchable by exact cosine."""

    def __init__(self, parts: list[Part]) -> None:
        """parts: doc ids, labels and numbers of distinct terms of some examples; their terms, and for each distinct term of each example its place there and its count."""
        self.names = pa.concat_arrays([p[3] for p in parts]).unique() if parts else pa.array([], pa.large_string())
        self.names = self.names.take(pc.sort_indices(self.names))
        size, some, cells = len(self.names), [], []
        while parts:
            docs, labels, sizes, names, code, count = parts.pop()
            term = pc.index_in(names, self.names).to_numpy(zero_copy_only=False).astype(np.int32)[code]
            order = np.lexsort((term, np.repeat(np.arange(len(sizes)), sizes)))
            term, count = term[order], count[order].astype(np.int32)
            some += zip(docs.tolist(), labels.tolist(), [len(cells)] * len(docs), (np.cumsum(sizes) - sizes).tolist(), np.cumsum(sizes).tolist())
            cells.append((term, count))
        df, at, rows, counts, self.place = np.zeros((2, size), np.int64), {}, [], [], {}
        for d, y, part, a, z in sorted(some):
            term, count = (c[a:z] for c in cells[part])
            df[y, term] += 1
            mark = blake2b(term.tobytes() + count.tobytes(), digest_size=16).digest()
            i = at.setdefault(mark, len(at)) if len(term) else -1
            if i == len(rows):
                rows.append((term, count))
                counts.append([0, 0, d])
            if i >= 0:
                counts[i][y] += 1
            self.place[d] = i
        labels = [x[1] for x in some]
        total = [labels.count(0), labels.count(1)]
        self.base = (total[1] + 0.5) / (sum(total) + 1)
        bare = [y for d, y, *_ in some if self.place[d] < 0]
        self.empty = (sum(bare) + self.base) / (len(bare) + 1)
        self.useful = bool(total[0] and total[1])
        self.n0, self.n1, self.doc = np.array(counts, np.int64).reshape(-1, 3).T
        self.idf = np.append(contrast(df[0], df[1], *total), 0.0) if self.useful else np.zeros(size + 1)  # the last: a term of no example
        self.term = np.concatenate([t for t, _ in rows] or [np.zeros(0, np.int32)])
        self.count = np.concatenate([c for _, c in rows] or [np.zeros(0, np.int32)])
        self.cuts = np.cumsum([0] + [len(t) for t, _ in rows])
        self.ready = False

    def __len__(self) -> int:
        return len(self.n0)

    def prepare(self) -> None:
        """The lists and the range maxima: made where they are needed and not sent."""
        self.ready, n, size = True, len(self), len(self.names)
        self.full = np.zeros(size)
        row = np.repeat(np.arange(n, dtype=np.int32), np.diff(self.cuts))
        self.norm, weight = np.ones(n), np.zeros(len(row), np.float32)
        for a in range(0, n, 1000):  # in steps, so that few long arrays stand beside each other
            b = min(n, a + 1000)
            own = slice(self.cuts[a], self.cuts[b])
            whole = (1 + np.log(self.count[own])) * self.idf[self.term[own]]
            norm = np.sqrt(np.bincount(row[own] - a, whole * whole, b - a))
            self.norm[a:b][norm > 0] = norm[norm > 0]
            weight[own] = whole / self.norm[row[own]]
        order = np.argsort(self.term, kind="stable")
        term, cell, row = self.term[order], weight[order], row[order]
        del weight, order
        # A posting is an example's number and its weight, rounded up to GRAIN, in one integer.
        self.lists = row.astype(np.uint32 if n <= 1 << 16 else np.int64) << 16
        self.lists |= np.minimum(np.ceil(cell * np.float32(GRAIN - 1)), GRAIN - 1).astype(self.lists.dtype)
        self.starts = np.searchsorted(term, np.arange(size + 1))
        often = np.diff(self.starts)
        self.most = np.zeros(size)
        self.most[often > 0] = np.maximum.reduceat(cell, self.starts[:-1][often > 0]) if len(cell) else 0
        # 0 and above: the dense column; below -1: that of the range maxima; -1: lists only.
        columns = np.flatnonzero(often > max(BLOCK, n // DENSE))
        ranged = np.flatnonzero((often > max(BLOCK, n // FREQUENT)) & (often <= max(BLOCK, n // DENSE)))
        self.column = np.full(size, -1, np.int32)
        self.column[columns], self.column[ranged] = np.arange(len(columns)), -2 - np.arange(len(ranged))
        column = self.column[term]
        self.dense = np.zeros((len(columns), n), np.float32)
        self.dense[column[column >= 0], row[column >= 0]] = cell[column >= 0]
        self.ranges = np.arange(0, n, BLOCK)
        self.maxima = np.zeros((len(ranged), len(self.ranges)), np.float32)
        some = np.flatnonzero(column < -1)
        np.maximum.at(self.maxima, (-2 - column[some], row[some] // BLOCK), np.nextafter(cell[some], np.float32(2)))

    def vectors(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each text the terms of its unit vector in rising order, and their weights."""
        names, row, word, count = _words(texts)
        term = pc.fill_null(pc.index_in(names, self.names), len(self.names)).to_numpy(zero_copy_only=False).astype(np.int64)[word]
        order = np.argsort(row * (len(self.names) + 1) + term, kind="stable")
        row, term, count = row[order], term[order], count[order]
        weight = (1 + np.log(count)) * self.idf[term]
        norm = np.sqrt(np.bincount(row, weight * weight, len(texts)))
        weight /= np.where(norm > 0, norm, 1)[row]
        row, term, weight = row[weight > 0], term[weight > 0], weight[weight > 0]
        cuts = np.searchsorted(row, np.arange(len(texts) + 1))
        return [(term[a:b], weight[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int = K) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the k examples with the largest cosine over 0, ties by position, and their cosines."""
        if not self.ready:
            self.prepare()
        out = []
        for at in range(0, len(vectors), TOGETHER):
            some = vectors[at : at + TOGETHER]
            left = np.zeros((len(some), len(self.dense)), np.float32)
            for q, (term, weight) in enumerate(some):
                column = self.column[term]
                left[q, column[column >= 0]] = weight[column >= 0]
            out += [self._nearest(term, weight, near, k) for near, (term, weight) in zip(left @ self.dense, some)]
        return out

    def _add(self, sums: np.ndarray, term: np.ndarray, weight: np.ndarray) -> None:
        """Add what the lists of some terms hold for each example, with weights rounded up."""
        a, z = self.starts[term], self.starts[term + 1]
        cells = np.concatenate([self.lists[i:j] for i, j in zip(a.tolist(), z.tolist())] or [self.lists[:0]])
        share = np.repeat((weight / (GRAIN - 1)).astype(np.float32), z - a)
        share *= cells & cells.dtype.type(GRAIN - 1)
        cells >>= cells.dtype.type(16)
        np.add(sums, np.bincount(cells, share, len(sums)), out=sums, casting="unsafe")

    def _nearest(self, term: np.ndarray, weight: np.ndarray, sums: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """``sums``: what the terms with dense columns add."""
        n = len(self)
        if not n or not len(term):
            return np.zeros(0, np.int64), np.zeros(0)
        # Sums are too large by the rounding up of weights, and off by some units of single precision.
        off = weight.sum() / (GRAIN - 1) + (len(term) + 16) * 2.0**-23
        # The k-th largest of the range maxima is at most the k-th largest of all.
        floor = lambda tops: float(np.partition(tops, -k)[-k]) - off if len(tops) >= k else 0.0
        column = self.column[term]
        self._add(sums, term[column == -1], weight[column == -1])
        tops = np.maximum.reduceat(sums, self.ranges)
        ranged = np.flatnonzero(column < -1)
        share = weight[ranged] * self.most[term[ranged]]
        order = np.argsort(-share, kind="stable")
        ranged, share = ranged[order], share[order]
        left = np.append(np.cumsum(share[::-1])[::-1], 0.0)  # what the terms from each on can add at most
        take = int(np.argmax(left <= max(0.0, floor(tops) / 8)))
        if take:
            self._add(sums, term[ranged[:take]], weight[ranged[:take]])
            tops = np.maximum.reduceat(sums, self.ranges)
        rest, least = ranged[take:], floor(tops)
        bound = tops + weight[rest].astype(np.float32) @ self.maxima[-2 - column[rest]] + off
        far = np.flatnonzero(bound >= least) if least > 0 else np.flatnonzero(bound > off)
        rows = (self.ranges[far][:, None] + np.arange(BLOCK)).ravel()
        rows = rows[rows < n]
        rows = rows[sums[rows] + left[take] + off >= least]
        m = self.cuts[rows + 1] - self.cuts[rows]
        cell = np.repeat(self.cuts[rows + 1] - np.cumsum(m), m) + np.arange(m.sum())
        self.full[term] = weight * self.idf[term]
        part = self.full[self.term[cell]]
        own = np.flatnonzero(part)
        sims = np.bincount(np.repeat(np.arange(len(rows)), m)[own], part[own] * (1 + np.log(self.count[cell[own]])), len(rows)) / self.norm[rows]
        self.full[term] = 0
        rows, sims = rows[sims > 0], sims[sims > 0]
        order = np.lexsort((rows, -np.round(sims, 12)))[:k]
        return rows[order], sims[order]

    def vote(self, rows: np.ndarray, sims: np.ndarray, own: int = -1, label: int = 0) -> float:
        """The share of label 1 among K + 1 or fewer examples; without one labelled row of the example ``own``, if given."""
        n0, n1 = self.n0[rows] - (rows == own) * (1 - label), self.n1[rows] - (rows == own) * label
        near = np.flatnonzero(n0 + n1 > 0)[:K]
        n0, n1, sims = n0[near], n1[near], sims[near]
        w = np.sqrt(n0 + n1) / (1.02 - np.minimum(1, sims)) ** 2
        return float(((w * n1 / (n0 + n1)).sum() + self.base) / (w.sum() + 1))


def logit(v: float) -> float:
    v = min(max(v, 1e-3), 1 - 1e-3)
    return float(np.log(v / (1 - v)))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and constant of a logistic curve, drawn slightly to 1 and 0; these too where the labels are of one kind or speak against the vote."""
    aim = np.array([1.0, 0.0])
    if len(set(y.tolist())) < 2:
        return 1.0, 0.0
    z, c = np.column_stack([x, np.ones(len(y))]), aim.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
        move = np.linalg.solve((z.T * (p * (1 - p))) @ z + 1e-2 * np.eye(2), z.T @ (p - y) + 1e-2 * (c - aim))
        c = c - move
        if np.abs(move).max() < 1e-9:
            break
    return (float(c[0]), float(c[1])) if c[0] > 0 else (1.0, 0.0)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        names, row, term, count = _words(batch.column("text"))
        ids, labels = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "label"))
        body = pack(ids, labels, np.bincount(row, minlength=batch.num_rows), b" ".join(names.cast(pa.large_binary()).to_pylist()), term.astype(np.int32), count.astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], ["body"])


def part_of(body: bytes) -> Part:
    ids, labels, sizes, names, term, count = unpack(body)
    return ids, labels, sizes, pc.split_pattern(pa.array([names.decode()], pa.large_string()), " ").flatten() if names else pa.array([], pa.large_string()), term, count


def build(sample: DataFrame) -> Index:
    """The index of a sample (doc_id, text, label), put together on the driver."""
    return Index([part_of(r[0]) for r in sample.mapInArrow(_packed, "body binary").collect()])


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN_DOCS) -> tuple[Broadcast, tuple[float, float]]:
    """The index over at most ``most`` labelled rows outside the held-out fold, and the curve over its votes."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, "toxic", fold(F.col("doc_id"), 3) != 1, most)
    index = build(sample)
    shared = spark.sparkContext.broadcast(index)
    if not index.useful:
        return shared, (1.0, 0.0)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in slices(batches):
            docs, y = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist()
            vectors = index.vectors(batch.column("text"))
            some = [i for i, v in enumerate(vectors) if len(v[0])]
            near = index.nearest([vectors[i] for i in some], K + 1)
            votes = [logit(index.vote(*x, index.place[docs[i]], y[i])) for x, i in zip(near, some)]
            columns = [pa.array([docs[i] for i in some], pa.int64()), pa.array(votes, pa.float64()), pa.array([y[i] for i in some], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["d", "v", "y"])

    rows = sorted(tuple(r) for r in sample.mapInArrow(left_out, "d long, v double, y int").collect())
    return shared, logistic(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))


def score(docs: DataFrame, model: tuple[Broadcast, tuple[float, float]]) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) for each row of ``docs``; evidence is the ids of up to three examples with their cosines."""
    bounded_batches(docs.sparkSession)
    shared, (slope, constant) = model

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple[float, str]] = {}
        index = shared.value

        def judged(rows: np.ndarray, sims: np.ndarray) -> tuple[float, str]:
            if not len(rows):
                return index.base, ""
            s = float(1 / (1 + np.exp(-np.clip(slope * logit(index.vote(rows, sims)) + constant, -40, 40))))
            return s, ",".join(f"{d}:{c:.4f}" for d, c in zip(index.doc[rows[:3]].tolist(), sims[:3].tolist()))

        for batch in slices(batches, most=TEXTS):
            column = batch.column("text")
            marks = [blake2b(t.as_buffer(), digest_size=16).digest() for t in column]
            if len(known) >= CACHE:
                known.clear()
            fresh = {m: i for i, m in enumerate(marks) if m not in known}
            if fresh:
                new = column.take(pa.array(list(fresh.values()), pa.int64()))
                words = word_count(*raw(translated(new, LOWER_ALNUM))).tolist()
                for m, n, near in zip(fresh, words, index.nearest(index.vectors(new))):
                    known[m] = judged(*near) if n else (index.empty, "")
            out = [known[m] for m in marks]
            s = np.array([x[0] for x in out])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)), pa.array([x[1] for x in out], pa.string())], ["doc_id", "held_out", "score", "predicted", "evidence"])

    return id_text(docs, (fold(F.col("doc_id"), 3) == 1).alias("held_out")).mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int, evidence string")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Index the labelled examples, then score every row of ``docs``.

    Null and empty texts, and texts without a word, get the smoothed share of
    label 1 among such examples; texts that share no weighted word with any
    example get that of the whole sample.  Equal texts get equal scores; without
    labels of both kinds every score is a smoothed share of label 1; no rows give
    no rows.
    """
    return score(docs, fit(docs, labels))
