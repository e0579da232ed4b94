"""Byte-level BPE encoding and decoding with a two-tier lookup.

A pre-token that is in the vocabulary as a whole is found by a minimal perfect
hash: one displacement a bucket, one slot a token, and the token's bytes to
verify the hit.  Any other pre-token is merged over a doubly linked list of
byte spans, with a heap that always gives the leftmost pair of the lowest rank.
What a worker has resolved it keeps in a bounded two-generation table.

The ranks come from a file named by the caller; nothing is trained and no file
is copied.  Texts are encoded whole, without special tokens.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from .textops import bounded_batches, id_text, slices

GENERATION = 300_000


class PerfectHash:
    """Minimal perfect hash over distinct byte strings: hash, then displace."""

    def __init__(self, keys: list[bytes], per_bucket: int = 4) -> None:
        self.n = max(1, len(keys))
        self.buckets = max(1, len(keys) // per_bucket)
        self.keys = [b""] * self.n
        self.value = [-1] * self.n
        self.shift = [0] * self.buckets
        groups: list[list[tuple[int, int]]] = [[] for _ in range(self.buckets)]
        for i, key in enumerate(keys):
            h = xxhash.xxh3_64_intdigest(key)
            groups[h % self.buckets].append((h, i))
        free = np.ones(self.n, bool)
        order = sorted(range(self.buckets), key=lambda b: -len(groups[b]))
        spare = None
        for b in order:
            group = groups[b]
            if not group:
                break
            if len(group) == 1:  # the rest has one key each: any free slot, kept as -1 - slot
                if spare is None:
                    spare = iter(np.flatnonzero(free).tolist())
                slot = next(spare)
                self.shift[b] = -1 - slot
                self._put(slot, keys[group[0][1]], group[0][1], free)
                continue
            d = 0
            while True:
                slots = [self._slot(h, d) for h, _ in group]
                if len(set(slots)) == len(slots) and all(free[s] for s in slots):
                    break
                d += 1
                if d > 50 * self.n:
                    raise ValueError("no displacement separates a bucket; are the keys distinct?")
            self.shift[b] = d
            for s, (_, i) in zip(slots, group):
                self._put(s, keys[i], i, free)

    def _put(self, slot: int, key: bytes, value: int, free: np.ndarray) -> None:
        free[slot] = False
        self.keys[slot], self.value[slot] = key, value

    def _slot(self, h: int, d: int) -> int:
        x = (h ^ d * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ x >> 31) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        return (x >> 32) % self.n

    def get(self, key: bytes) -> int:
        """The position of ``key`` among the keys, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        slot = -1 - d if d < 0 else self._slot(h, d)
        return self.value[slot] if self.keys[slot] == key else -1


class Codec:
    """Ranks, pattern and tables of one vocabulary; equal for equal inputs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.pattern = pattern
        self.ranks = ranks
        order = sorted(ranks, key=ranks.__getitem__)
        self.ids = [ranks[k] for k in order]
        self.whole = PerfectHash(order)
        self.bytes_of = dict(zip(self.ids, order))
        self.text_of = {i: str(i) for i in self.ids}
        self._ready()

    def _ready(self) -> None:
        self.find = regex.compile(self.pattern).findall
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("find", "young", "old")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._ready()

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Token ids of a piece, by merging its bytes."""
        n, rank = len(piece), self.ranks.get
        heap = []
        for i in range(n - 1):
            r = rank(piece[i : i + 2])
            if r is not None:
                heap.append((r, i, i + 2))
        heapify(heap)
        end = list(range(1, n + 2))  # end[i]: where the span that starts at i ends; 0: merged away
        before = list(range(-1, n))
        while heap:
            _, i, stop = heappop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the two spans has changed since
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                far = end[stop]
                r = rank(piece[i:far])
                if r is not None:
                    heappush(heap, (r, i, far))
            h = before[i]
            if h >= 0:
                r = rank(piece[h:stop])
                if r is not None:
                    heappush(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def resolve(self, word: str) -> tuple[int, ...]:
        got = self.old.get(word)
        if got is None:
            piece = word.encode("utf-8")
            at = self.whole.get(piece)
            got = (self.ids[at],) if at >= 0 else self.merge(piece)
        if len(self.young) >= GENERATION:
            self.old, self.young = self.young, {}
        self.young[word] = got
        return got

    def encode(self, text: str) -> list[int]:
        words = self.find(text)
        # Resolved in runs: a run's words are looked up only after the last table turned over.
        out: list[int] = []
        get, resolve = self.young.get, self.resolve
        for at in range(0, len(words), 4096):
            run = words[at : at + 4096]
            found = [get(w) or resolve(w) for w in run]
            out.extend(chain.from_iterable(found))
            get = self.young.get
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def load(path: str, pattern: str) -> Codec:
    """The codec of a file of base64 tokens and ranks; read once, on the driver."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return Codec(ranks, pattern)


def encode(docs: DataFrame, codec: Codec) -> DataFrame:
    """(doc_id, ids array<int>) for each row of ``docs``; null and empty texts have no ids."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            ids = [np.array(shared.value.encode(t), np.int32) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return id_text(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, codec: Codec) -> DataFrame:
    """(doc_id, bytes) for each row of (doc_id, ids); null ids decode to nothing."""
    shared = encoded.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [shared.value.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, codec: Codec) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode each text, decode the ids, digest both.

    One row for each row of ``docs``; null counts as the empty text, whose ids
    and bytes are empty; repeated rows get equal results.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        for batch in slices(batches):
            n, ids_sha, text_sha = [], [], []
            for text in batch.column("text").to_pylist():
                ids = c.encode(text)
                n.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(c.text_of.__getitem__, ids)).encode()).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
