"""Quality classifier: random-indexing word vectors, mean-pooled, and a small network.

A term is a word or the shape of a word (letters, capitals, digits and runs of one
sign each folded to one character).  Every term has a sparse ternary index vector
that follows from its 64-bit hash, so no table of them is needed.  The vector of a
term is the sum of the index vectors of the words, and their shapes, within two
words of its occurrences in the sample, made unit length.  Terms of a single text
of the sample have none: a text that is scored could not know them either.  A
document is the mean of its words' vectors, the mean of its shapes' vectors and
four figures about its length, its variety and its unknown words.  A network of one
hidden and one output layer reads that, and a temperature fitted on a fifth of the
sample held back from training turns its logit into a probability.

The sample is bounded by ``MAX_TRAIN_DOCS`` labelled rows, and it bounds the table
of vectors; everything that is scored is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sample import labelled_sample
from .textops import bounded_batches, fold, id_text, pack, raw, slices, split, strings, unpack

MAX_TRAIN_DOCS = 6000
THRESHOLD = 0.3
DIM, HIDDEN, REACH, NONZERO = 48, 32, 2, 6
LEAST_DOCS = 2
FEATURES = 2 * DIM + 4
POOL_WORDS, TEXTS = 1 << 15, 2 << 20  # words pooled, and bytes of texts cut into words, at a time
WORD_SEED, SHAPE_SEED = 0, 1

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[65:91], _SHAPE[97:123], _SHAPE[128:], _SHAPE[48:58] = ord("X"), ord("x"), ord("x"), ord("9")
_SHAPE[[9, 10, 11, 12, 13]] = 32
_BLANK = np.arange(256, dtype=np.uint8)
_BLANK[[9, 10, 11, 12, 13]] = 32


def index_vectors(hashes: np.ndarray) -> np.ndarray:
    """The sparse ternary vector of each term: one entry of 1 or -1 in each of ``NONZERO`` equal stretches."""
    width = DIM // NONZERO
    out = np.zeros((len(hashes), DIM), np.int16)
    rest = hashes.astype(np.uint64)
    for stretch in range(NONZERO):
        sign, place = rest & np.uint64(1), (rest >> np.uint64(1)) % np.uint64(width)
        out[np.arange(len(hashes)), stretch * width + place.astype(np.int64)] = np.where(sign, 1, -1)
        rest = rest >> np.uint64(8)
    return out


@dataclass
class Terms:
    """One kind of terms of some texts: the hashes of distinct ones, and each occurrence's place among them."""

    hashes: np.ndarray
    code: np.ndarray


def _terms_of(words: pa.Array, seed: int) -> Terms:
    coded = words.dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in coded.dictionary.to_pylist()], np.uint64)
    return Terms(hashes, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64))


def terms(texts: pa.Array) -> tuple[Terms, Terms, np.ndarray]:
    """The words and the shapes of texts, in step, and the number of words of each text."""
    data, offs = raw(texts)
    words, n = split(strings(_BLANK[data], offs))
    sign = _SHAPE[data]
    keep = np.ones(len(sign), bool)
    keep[1:] = sign[1:] != sign[:-1]
    keep[offs[:-1][offs[:-1] < offs[1:]]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    shapes, _ = split(strings(sign[keep], kept[offs]))
    return _terms_of(words, WORD_SEED), _terms_of(shapes, SHAPE_SEED), n


def _place(hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each hash in sorted ``keys``, or -1."""
    at = np.minimum(np.searchsorted(keys, hashes), max(0, len(keys) - 1))
    return np.where(keys[at] == hashes, at, -1) if len(keys) else np.full(len(hashes), -1)


def add_contexts(texts: pa.Array, keys: np.ndarray, total: np.ndarray) -> None:
    """Add to ``total``, for each of the sorted ``keys``, hashes of terms, the index vectors around its occurrences."""
    word, shape, n = terms(texts)
    row = np.repeat(np.arange(len(n)), n)
    own = index_vectors(word.hashes)[word.code] + index_vectors(shape.hashes)[shape.code]
    around = np.zeros_like(own)
    for step in range(1, REACH + 1):
        if len(row) > step:
            same = (row[step:] == row[:-step])[:, None]
            around[step:] += own[:-step] * same
            around[:-step] += own[step:] * same
    for kind in (word, shape):
        place = _place(kind.hashes, keys)[kind.code]
        order = np.argsort(place, kind="stable")
        order = order[np.searchsorted(place[order], 0) :]  # unknown terms come first
        present, first = np.unique(place[order], return_index=True)
        if len(present):
            total[present] += np.add.reduceat(around[order], first, axis=0, dtype=np.int32)


def _groups(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Texts first..past of some ``POOL_WORDS`` words together; a longer text goes alone."""
    ends, at = np.cumsum(n), 0
    while at < len(n):
        past = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + POOL_WORDS, "right")))
        yield at, past
        at = past


def pooled(texts: pa.Array, keys: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The features of each text; a text without words has zeros only.

    ``vectors`` are those of the sorted ``keys``, and one of zeros for unknown terms.
    A text's sums do not depend on the texts beside it.
    """
    word, shape, n = terms(texts)
    ends = np.concatenate([[0], np.cumsum(n)])
    out = np.zeros((len(n), FEATURES))
    row = np.repeat(np.arange(len(n)), n)
    for part, kind in enumerate((word, shape)):
        place = _place(kind.hashes, keys)[kind.code]
        for a, b in _groups(n):
            for at in range(ends[a], ends[b], POOL_WORDS):
                to = min(at + POOL_WORDS, ends[b])
                here, first = np.unique(row[at:to], return_index=True)
                out[here, part * DIM : (part + 1) * DIM] += np.add.reduceat(vectors[place[at:to]], first, axis=0, dtype=np.float64)
        distinct = np.unique(row * max(1, len(kind.hashes)) + kind.code) // max(1, len(kind.hashes))
        out[:, 2 * DIM + 1 + part] = np.bincount(distinct, minlength=len(n))
        if part == 0:
            out[:, 2 * DIM + 3] = np.bincount(row[place < 0], minlength=len(n))
    out /= np.maximum(1, n)[:, None]
    out[:, 2 * DIM] = np.log1p(n) / 5
    return out


@dataclass
class Model:
    keys: np.ndarray
    vectors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float
    constant: float | None = None

    def of_texts(self, texts: pa.Array) -> np.ndarray:
        return self.score(pooled(texts, self.keys, self.vectors))

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        h = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return 1 / (1 + np.exp(-np.clip((h @ self.w2 + self.b2) / self.temperature, -40, 40)))


def train(keys: np.ndarray, vectors: np.ndarray, x: np.ndarray, y: np.ndarray, epochs: int = 60, rate: float = 0.01, decay: float = 1e-3, seed: int = 3) -> Model:
    """Adam on minibatches of the log loss; then the temperature on every fifth row."""
    size = FEATURES
    rng = np.random.default_rng(seed)
    if len(set(y.tolist())) < 2 or len(y) < 10:
        return Model(keys, vectors, np.zeros(size), np.ones(size), np.zeros((size, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0, 1.0, float((y.sum() + 1) / (len(y) + 2)))
    x = x.astype(np.float64)
    held = np.arange(len(y)) % 5 == 4
    mean, scale = x[~held].mean(0), x[~held].std(0) + 1e-3
    z, t = (x - mean) / scale, y.astype(np.float64)
    p = [rng.normal(0, size**-0.5, (size, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    rows = np.flatnonzero(~held)
    for _ in range(epochs):
        rng.shuffle(rows)
        for at in range(0, len(rows), 64):
            i = rows[at : at + 64]
            h = np.tanh(z[i] @ p[0] + p[1])
            e = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -40, 40))) - t[i]) / len(i)
            back = e[:, None] * p[2] * (1 - h * h)
            grads = [z[i].T @ back + decay * p[0], back.sum(0), h.T @ e + decay * p[2], np.array([e.sum()])]
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    logit = np.tanh(z[held] @ p[0] + p[1]) @ p[2] + p[3]
    heat = np.geomspace(0.25, 8, 121)
    loss = [np.logaddexp(0, np.where(t[held] > 0.5, -1, 1) * logit / c).mean() for c in heat]
    return Model(keys, vectors, mean, scale, p[0], p[1], p[2], float(p[3][0]), float(heat[int(np.argmin(loss))]))


def vocabulary(sample: DataFrame) -> np.ndarray:
    """The sorted hashes of the terms that stand in ``LEAST_DOCS`` or more texts of the sample."""

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=TEXTS):
            word, shape, n = terms(batch.column("text"))
            row = np.repeat(np.arange(len(n)), n)
            for kind in (word, shape):
                size = max(1, len(kind.hashes))
                times = np.bincount(np.unique(row * size + kind.code) % size, minlength=len(kind.hashes))
                yield pa.RecordBatch.from_arrays([pa.array(kind.hashes.view(np.int64)), pa.array(times[: len(kind.hashes)], pa.int64())], ["h", "n"])

    rows = sample.mapInArrow(held, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_DOCS)
    return np.sort(np.array([r[0] for r in rows.select("h").collect()], np.int64).view(np.uint64))


def term_vectors(sample: DataFrame, keys: np.ndarray) -> np.ndarray:
    """The unit vectors of ``keys``, and one of zeros.  Sums are whole numbers, so no order of rows changes them."""

    shared = sample.sparkSession.sparkContext.broadcast(keys)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(keys), DIM), np.int64)
        for batch in slices(batches, most=1 << 19):
            add_contexts(batch.column("text"), shared.value, total)
        for d in range(DIM):  # a column at a time, so that a packed table never stands beside the table
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.int32()), pa.array([pack(total[:, d].copy())], pa.binary())], ["d", "sums"])

    total = np.zeros((len(keys), DIM), np.int64)
    for part in sample.mapInArrow(sums, "d int, sums binary").collect():  # DIM columns for each of at most 8 partitions, packed
        total[:, part["d"]] += unpack(part["sums"])[0]
    norm = np.sqrt(np.einsum("ij,ij->i", total, total, dtype=np.float64))
    vectors = np.zeros((len(keys) + 1, DIM), np.float32)
    for d in range(DIM):
        vectors[:-1, d] = total[:, d] / np.maximum(1e-9, norm)
    return vectors


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAIN_DOCS) -> Model:
    """Learn from at most ``most`` labelled rows outside the held-out fold."""
    sample = labelled_sample(docs, labels, "quality", fold(F.col("doc_id"), 5) != 0, most)
    keys = vocabulary(sample)
    vectors = term_vectors(sample, keys)
    shared = docs.sparkSession.sparkContext.broadcast((keys, vectors))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=TEXTS):
            x = pooled(batch.column("text"), *shared.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    rows = sorted(sample.mapInArrow(features, "doc_id long, label int, x array<double>").collect(), key=lambda r: r[0])
    x = np.array([r[2] for r in rows]).reshape(len(rows), FEATURES)
    return train(keys, vectors, x, np.array([r[1] for r in rows], np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, most=TEXTS):
            s = m.of_texts(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return id_text(docs, (fold(F.col("doc_id"), 5) == 0).alias("held_out")).mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text is accepted (score at least ``THRESHOLD``), columns as they are."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in slices(batches, most=TEXTS):
            yield batch.filter(pa.array(m.of_texts(batch.column("text")) >= THRESHOLD))

    return docs.mapInArrow(kept, docs.schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit on ``labels``, then score every row of ``docs``.

    Null and empty texts get the score of a text without words; equal texts get
    equal scores; without labels of both kinds every score is the smoothed share
    of label 1; no rows give no rows.
    """
    return score(docs, fit(docs, labels))
