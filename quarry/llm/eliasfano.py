"""Elias-Fano sequences and a two-level n-gram trie over them, queried in numpy.

A monotone sequence of n numbers below u keeps floor(log2(u / n)) low bits of
each number in a packed array and the rest in unary, about two bits a number.
The trie's first level holds contexts, its pointers hold where each context's
successors begin, and its second level holds the successors, made monotone by
adding the last value of the context before.  So a successor is searched relative
to its context: next number at or after base + word, within the context's range.
Each successor has one byte, an index into a codebook of log probabilities.

The levels are laid end to end in one file that is unlinked once it is mapped,
so pages belong to the page cache and nothing is left behind.
"""

from __future__ import annotations

import mmap
import tempfile

import numpy as np

U64 = np.uint64


class EliasFano:
    """A monotone sequence of non-negative integers."""

    def __init__(self, values: np.ndarray) -> None:
        v = np.asarray(values, np.int64)
        self.n = len(v)
        if self.n and (v[0] < 0 or (np.diff(v) < 0).any()):
            raise ValueError("the sequence must be monotone and not negative")
        self.u = int(v[-1]) + 1 if self.n else 1
        self.l = max(0, (self.u // max(1, self.n)).bit_length() - 1)
        low = (v & ((1 << self.l) - 1)).astype(U64)
        self.low = np.zeros(self.n * self.l // 64 + 2, U64)
        if self.l and self.n:
            at = np.arange(self.n, dtype=np.int64) * self.l
            word, off = at >> 6, (at & 63).astype(U64)
            np.bitwise_or.at(self.low, word, low << off)
            over = off + U64(self.l) > U64(64)
            np.bitwise_or.at(self.low, word[over] + 1, low[over] >> (U64(64) - off[over]))
        top = (v >> self.l) + np.arange(self.n)
        size = (int(top[-1]) if self.n else 0) + 2
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[top] = 1
        self.high = np.packbits(bits, bitorder="little").view(U64)
        ones = np.bitwise_count(self.high).astype(np.int64)
        self.ones = np.concatenate([[0], np.cumsum(ones)]).astype(np.uint32 if self.n < 1 << 31 else np.int64)

    def arrays(self) -> list[str]:
        return ["low", "high", "ones"]

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.l:
            return np.zeros(len(i), np.int64)
        at = i * self.l
        word, off = at >> 6, (at & 63).astype(U64)
        got = self.low[word] >> off
        spill = off + U64(self.l) > U64(64)
        got[spill] |= self.low[word[spill] + 1] << (U64(64) - off[spill])
        return (got & U64((1 << self.l) - 1)).astype(np.int64)

    @staticmethod
    def _in_word(word: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The place of the k-th (from 0) one of each word."""
        place, k = np.zeros(len(word), np.int64), k.copy()
        for width in (32, 16, 8, 4, 2, 1):
            half = word >> place.astype(U64) & U64((1 << width) - 1)
            c = np.bitwise_count(half).astype(np.int64)
            right = k >= c
            k -= np.where(right, c, 0)
            place += np.where(right, width, 0)
        return place

    def _one(self, i: np.ndarray) -> np.ndarray:
        """The place of the i-th one of the unary part."""
        w = np.searchsorted(self.ones, i, "right") - 1
        return (w << 6) + self._in_word(self.high[w], i - self.ones[w].astype(np.int64))

    def _before(self, h: np.ndarray) -> np.ndarray:
        """How many numbers have a high part below h: the ones before the h-th zero."""
        out = np.zeros(len(h), np.int64)
        some = h > 0
        k = h[some] - 1
        zeros = (np.arange(len(self.ones), dtype=np.int64) << 6) - self.ones
        beyond = k >= zeros[-1]
        w = np.minimum(np.searchsorted(zeros, k, "right") - 1, len(self.high) - 1)
        place = (w << 6) + self._in_word(~self.high[w], k - zeros[w])
        out[some] = np.where(beyond, self.n, place - k)
        return out

    def access(self, i: np.ndarray) -> np.ndarray:
        i = np.asarray(i, np.int64)
        return (self._one(i) - i) << self.l | self._low(i)

    def next_geq(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the first number at or after each x (n: none), and whether it equals x."""
        x = np.asarray(x, np.int64)
        h, low = x >> self.l, x & ((1 << self.l) - 1)
        a, end = self._before(h), self._before(h + 1)
        b = end.copy()
        while True:
            going = np.flatnonzero(a < b)
            if not len(going):
                break
            mid = (a[going] + b[going]) >> 1
            less = self._low(mid) < low[going]
            a[going[less]] = mid[less] + 1
            b[going[~less]] = mid[~less]
        inside = np.flatnonzero(a < end)
        same = np.zeros(len(x), bool)
        same[inside] = self._low(a[inside]) == low[inside]
        return a, same

    def bits(self) -> int:
        return 8 * (self.low.nbytes + self.high.nbytes + self.ones.nbytes)


class Trie:
    """Contexts, pointers and successors with one-byte codes, in a mapped file.

    ``context`` and ``word`` are sorted by context and then word, without
    repeats; ``code`` is a byte each and ``codebook`` what the bytes stand for.
    """

    def __init__(self, context: np.ndarray, word: np.ndarray, code: np.ndarray, codebook: np.ndarray) -> None:
        first = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]])) if len(context) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(context)) if len(context) else first
        last = word[ends - 1] if len(context) else np.zeros(0, np.int64)
        # The base of a context is the largest monotone value of the one before it, plus one.
        base = np.concatenate([[0], np.cumsum(last + 1)[:-1]]) if len(context) else first
        values = word + np.repeat(base, ends - first) if len(context) else word
        self.contexts = EliasFano(context[first])
        self.pointers = EliasFano(np.append(first, len(context)))
        self.successors = EliasFano(values)
        self.code, self.codebook = np.ascontiguousarray(code, np.uint8), np.asarray(codebook, np.float32)
        self._map()

    def _map(self) -> None:
        parts = [(o, name) for o in (self.contexts, self.pointers, self.successors) for name in o.arrays()] + [(self, "code")]
        with tempfile.TemporaryFile() as f:
            places = []
            for o, name in parts:
                a = getattr(o, name)
                f.seek(-(-f.tell() // 8) * 8)
                places.append((f.tell(), a.dtype, len(a)))
                f.write(a.tobytes())
            f.write(bytes(8))
            f.flush()
            self.mapped = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        for (o, name), (at, dtype, n) in zip(parts, places):
            setattr(o, name, np.frombuffer(self.mapped, dtype, n, at))

    def lookup(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The code of each (context, word), or 0 where the trie has none."""
        out = np.zeros(len(context), np.uint8)
        if not self.contexts.n or not len(context):
            return out
        own, inverse = np.unique(context, return_inverse=True)
        at, known = self.contexts.next_geq(own)
        at = np.minimum(at, self.contexts.n - 1)
        begin, end = self.pointers.access(at), self.pointers.access(at + 1)
        base = np.where(begin > 0, self.successors.access(np.maximum(0, begin - 1)) + 1, 0)
        # A word past the context's last would fall among the next context's: its index is out of range.
        i, same = self.successors.next_geq(base[inverse] + word)
        ok = known[inverse] & same & (i >= begin[inverse]) & (i < end[inverse])
        out[ok] = self.code[i[ok]]
        return out

    def bits_a_gram(self) -> float:
        """Bits for each successor, its context's share and its code included."""
        return (self.contexts.bits() + self.pointers.bits() + self.successors.bits() + 8 * len(self.code)) / max(1, self.successors.n)


def quantised(values: np.ndarray, most: int = 255) -> tuple[np.ndarray, np.ndarray]:
    """Codes from 1 and a codebook; each bin stands for its mean.

    Half of the bin edges part the values into equal counts and half their range
    into equal widths, so no value is far from its bin's mean, however rare.
    """
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.float32)
    n = (most - 1) // 2
    inner = np.linspace(0, 1, n + 2)[1:-1]
    edges = np.unique(np.concatenate([np.quantile(values, inner, method="lower"), values.min() + inner * np.ptp(values)]))
    code = np.searchsorted(edges, values, "left")
    n = np.bincount(code, minlength=len(edges) + 1)
    mean = np.bincount(code, values, len(edges) + 1) / np.maximum(1, n)
    return (code + 1).astype(np.uint8), np.concatenate([[0], mean]).astype(np.float32)
