"""Personal data: exact base patterns, and a semi-Markov conditional random field.

A text is cut into words.  A segment of one to ``MOST_WORDS`` words that holds an
anchor (a digit, an at-sign, or "at" in brackets) may be an entity; every other
word is outside.  Whole-span features (the shape of the trimmed span, its
digits, check sums, octets, at-signs and dots, edges, words just before) score a
segment for each kind, and a dynamic programme over segment ends picks the
boundaries and kinds of a stretch together.  Where no segment can reach, only
"outside" is possible, so stretches around anchors can be solved on their own and
the result is that of the whole text.

The field is trained here by its exact conditional likelihood (forward and
backward sums over segmentations) on ``TRAIN_LINES`` seeded synthetic lines; it
needs no table and is the same in every run.  Base matches enter as features and
always stay; the field adds the spans that overlap none of them.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from random import Random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .textops import bounded_batches, id_text, slices

KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = 4  # those that fixed patterns find; secrets are the field's alone
MOST_WORDS, TRAIN_LINES, EPOCHS = 6, 700, 6

Span = tuple[int, int, int]  # start, end, number of its kind

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is entered at its first digit only: no match can begin inside
# one where none begins at its start, and long runs stay linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _octets(s: str) -> bool:
    """Whether all parts are at most 255, however long they are written."""
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in s.split("."))


def base_spans(text: str) -> list[Span]:
    """The spans of the four fixed patterns, by start and then kind."""
    found: list[Span] = []
    at, past = text.find("@"), 0
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            past = m.end()
            found.append((start, past, 0))
        at = text.find("@", max(at + 1, past))
    found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(d := _NO_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            found.append((m.start(), m.end(), 2))
    if "+" in text:
        found += [(m.start(), m.end(), 3) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return sorted(found, key=lambda s: (s[0], s[2]))


_ANCHOR = re.compile(r"[0-9@]|[\[(]at[\])]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_CLUES = {"tel": "tel", "phone": "tel", "call": "tel", "fax": "tel", "mobile": "tel", "ip": "ip", "host": "ip", "address": "ip", "card": "card", "visa": "card", "credit": "card", "mail": "mail", "email": "mail", "e-mail": "mail", "contact": "mail", "token": "key", "secret": "key", "password": "key", "passwd": "key", "api_key": "key", "apikey": "key", "key": "key", "version": "code", "=": "set", ":": "set"}
_EDGE = ".,;:!?\"'|<>[]{}*#&$%"


def _trim(start: int, end: int, text: str) -> tuple[int, int]:
    """A segment's span without the punctuation at its edges; unpaired brackets go too."""
    while start < end and text[start] in _EDGE + ")-":
        start += 1
    while start < end and text[end - 1] in _EDGE + "(+-":
        end -= 1
    if start < end and text[end - 1] == ")" and "(" not in text[start:end]:
        end -= 1
    return start, end


def _shape(s: str) -> str:
    """Digits to 9, letters to a, each kind of run with its length up to four."""
    out, last, run = [], "", 0
    for c in s[:80]:
        k = "9" if c in "0123456789" else "a" if c.isalpha() else c
        if k == last:
            run += 1
            if run <= 4 and k == "9":
                out.append(k)
            continue
        out.append(k)
        last, run = k, 1
    return "".join(out)


@cache
def _clue(word: str) -> str:
    return _CLUES.get(word.strip(_EDGE + "()").lower(), "")


def features(words: list[tuple[int, int]], i: int, j: int, text: str, base: dict[tuple[int, int], int]) -> tuple[tuple[int, int], list[str]]:
    """The trimmed span of words i..j-1 and the names of its features."""
    a, b = _trim(words[i][0], words[j - 1][1], text)
    if b - a > 200:  # no entity is that long; one feature says so, whatever the length
        return (a, b), ["long"]
    s = text[a:b]
    digits = _NO_DIGIT.sub("", s)
    letters = sum(c.isalpha() for c in s)
    marks = sorted({c for c in s if not c.isalnum() and c != " "})
    out = ["bias", f"n{j - i}", f"d{min(len(digits), 20)}", "l0" if not letters else "l1" if letters < 5 else "l5", "m" + "".join(marks)[:8], "s" + _shape(s)[:24]]
    before = [_clue(text[x:y]) for x, y in words[max(0, i - 2) : i]]
    out += [f"c{c}" for c in set(before) if c]
    if 12 <= len(digits) <= 19 and not letters:
        out.append("luhn" if luhn(digits) else "noluhn")
    parts = s.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        out.append("octets" if _octets(s) else "overflow")
    if "@" in s or "[at]" in s or "(at)" in s:
        out.append("at:dotted" if re.search(r"(?:@|[\[(]at[\])]) ?[A-Za-z0-9-]+(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]+)+$", s) else "at:bare")
    if letters and digits and not marks:
        out.append("mixed")
        out.append(f"mixed{min(len(s) // 8, 6)}" + ("key" if "key" in before else ""))
    if (a, b) in base:
        out.append(f"base{base[a, b]}")
    # Does a figure stand right before or after?
    if i and text[words[i - 1][1] - 1] in "0123456789":
        out.append("digit before")
    if j < len(words) and text[words[j][0]] in "0123456789":
        out.append("digit after")
    return (a, b), out


@dataclass
class Field:
    """Weights: one row a feature, one column a kind; and for kinds in a row."""

    index: dict[str, int]
    weights: np.ndarray
    follow: np.ndarray  # [kind before + 1, kind + 1], 0: outside
    outside: float

    def segments(self, words, j, anchored, text, base) -> Iterator[tuple[int, tuple[int, int], np.ndarray]]:
        """The candidate segments (i, span, score of each kind) that end before word j."""
        seen = False
        for i in range(j - 1, max(-1, j - 1 - MOST_WORDS), -1):
            seen = seen or anchored[i]
            if seen:
                span, names = features(words, i, j, text, base)
                if span[0] < span[1]:
                    yield i, span, self.weights[[self.index[f] for f in names if f in self.index]].sum(0)

    def decode(self, words: list[tuple[int, int]], text: str, base: dict[tuple[int, int], int]) -> list[Span]:
        """The best segmentation of a stretch of words, as spans.

        Candidates are scored as the programme reaches their ends; only the best
        way to each end and kind is kept, in arrays.
        """
        n, k = len(words), len(KINDS)
        anchored = [bool(_ANCHOR.search(text, x, y)) for x, y in words]
        best = np.full((n + 1, k + 1), -np.inf)
        best[0, 0] = 0.0
        start, before = np.zeros((n + 1, k + 1), np.int32), np.zeros((n + 1, k + 1), np.int8)
        spans = np.zeros((n + 1, k + 1, 2), np.int64)
        for j in range(1, n + 1):
            come = best[j - 1] + self.follow[:, 0]
            p = int(come.argmax())
            best[j, 0], start[j, 0], before[j, 0] = come[p] + self.outside, j - 1, p
            for i, span, score in self.segments(words, j, anchored, text, base):
                come = best[i][:, None] + self.follow[:, 1:]
                p = come.argmax(0)
                total = come[p, np.arange(k)] + score
                better = np.flatnonzero(total > best[j, 1:])
                if len(better):
                    best[j, better + 1], start[j, better + 1], before[j, better + 1], spans[j, better + 1] = total[better], i, p[better], span
        out, j, t = [], n, int(best[n].argmax())
        while j:
            if t:
                out.append((int(spans[j, t, 0]), int(spans[j, t, 1]), t - 1))
            j, t = int(start[j, t]), int(before[j, t])
        return out[::-1]


def stretches(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of words that segments with an anchor can reach, with a word of context each side."""
    flat = text
    for c in "\t\n\x0b\x0c\r":
        flat = flat.replace(c, " ")
    reach = MOST_WORDS
    m = _ANCHOR.search(flat)
    while m:
        words: list[tuple[int, int]] = []
        at = flat.rfind(" ", 0, m.start()) + 1
        left = at
        for _ in range(reach):  # words before the first anchor
            end = left
            while end > 0 and flat[end - 1] == " ":
                end -= 1
            if end == 0:
                break
            left = flat.rfind(" ", 0, end) + 1
            words.append((left, end))
        words.reverse()
        since = 0
        while since <= reach:  # to as many words after the last anchor
            w = _WORD.match(flat, at) or _WORD.search(flat, at)
            if not w:
                break
            words.append(w.span())
            since = 0 if _ANCHOR.search(flat, *w.span()) else since + 1
            at = w.end()
        yield words
        m = _ANCHOR.search(flat, at)


_LOW = "abcdefghijklmnopqrstuvwxyz"


def _line(r: Random) -> tuple[str, list[Span]]:
    """A synthetic line with labelled entities among words, figures, codes and dates."""
    word = lambda: "".join(r.choice(_LOW) for _ in range(r.randint(2, 9)))
    num = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def card() -> str:
        d = r.choice("3456") + num(r.choice((11, 13, 14, 14, 14, 17)))
        d += next(c for c in "0123456789" if luhn(d + c))
        sep = r.choice(("", "", " ", "-", "."))
        return sep.join(d[i : i + 4] for i in range(0, len(d), 4))

    def entity() -> tuple[int, str]:
        t = r.randrange(5)
        if t == 4:
            mark, letters = r.choice(("", "", '"', "'")), r.choice(("0123456789abcdef", "0123456789abcdef", "0123456789" + _LOW, "0123456789" + _LOW + _LOW.upper()))
            body = "".join(r.choice(letters) for _ in range(r.choice((20, 24, 32, 40, 40, 48, 64)) - 1)) + r.choice("0123456789")
            return 4, f"{mark}{body}{mark}"
        if t == 0:
            at, dot = r.choice((("@", "."), ("@", "."), (" [at] ", "."), ("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]")))
            return 0, word() + r.choice(("", ".", "_", num(2))) + word() + at + word() + num(r.randint(0, 1)) + dot + r.choice(("com", "org", "net", "example.com" if dot == "." else "io"))
        if t == 1:
            return 1, ".".join(str(r.randint(0, 255)) for _ in range(4))
        if t == 2:
            return 2, card()
        a, b, c = num(3), num(3), num(4)
        return 3, r.choice((f"+1 ({a}) {b}-{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{num(2)} {num(3)} {num(4)} {num(3)}", f"({a}) {b} {c}"))

    def figure() -> str:
        return r.choice((num(r.randint(1, 8)), f"{num(1)}.{num(1)}", f"{num(1)}.{num(1)}.{num(2)}", f"20{num(2)}-0{r.randint(1, 9)}-{r.randint(10, 28)}", f"{num(2)}:{num(2)}", f"{num(2)},{num(3)}", "".join(r.choice("0123456789abcdef") for _ in range(r.choice((12, 32, 40)))),
            f"@{word()}", word() + num(2), f"v{num(1)}.{num(1)}", f"{num(3)}.{num(3)}.{num(3)}.{num(3)}" if r.random() < 0.3 else f"${num(2)}.{num(2)}", num(r.choice((10, 12, 16, 20))), f"{num(4)} {num(4)}", f"{num(2)} {num(2)} {num(2)}"))

    text, spans = "", []
    for _ in range(r.randint(2, 4)):
        for _ in range(r.randint(1, 4)):
            text += word() + r.choice((" ", " ", ", ", ". "))
        if r.random() < 0.5:
            t, s = entity()
            if t == 1 and not _octets(s):
                continue
            if t == 4 or r.random() < 0.3:
                text += r.choice(([" e-mail: ", "contact "], ["ip ", "host "], ["card ", "visa "], ["tel ", "call "], ["token = ", "token: ", "secret = ", "api_key = ", "password: ", "key = ", "secret: "])[t])
            quoted = t == 4 and not s[0].isalnum()
            spans.append((len(text) + quoted, len(text) + len(s) - quoted, t))
            text += s + r.choice((" ", " ", ". ", ", "))
        else:
            if r.random() < 0.3:
                text += r.choice(("version ", "count = ", "page "))
            text += figure() + r.choice((" ", " ", ". "))
    return text + word(), spans


@cache
def trained(seed: int = 11) -> Field:
    """Fit the field: AdaGrad on the conditional log likelihood of the synthetic lines."""
    r = Random(seed)
    lines = [_line(r) for _ in range(TRAIN_LINES)]
    index: dict[str, int] = {}
    k, data = len(KINDS), []
    for text, spans in lines:
        words = [m.span() for m in _WORD.finditer(text)]
        base = {(a, b): t for a, b, t in base_spans(text)}
        anchored = [bool(_ANCHOR.search(text, x, y)) for x, y in words]
        truth, segments = {(a, b): t for a, b, t in spans}, []
        for j in range(1, len(words) + 1):
            for i in range(max(0, j - MOST_WORDS), j):
                if any(anchored[i:j]):
                    span, names = features(words, i, j, text, base)
                    if span[0] < span[1]:
                        segments.append((i, j, np.array([index.setdefault(f, len(index)) for f in names]), truth.get(span, -1)))
        gold, covered = [], set()
        for s in segments:
            # The shortest segment that trims to a labelled span is the right one.
            if s[3] >= 0 and not any(x in covered for x in range(s[0], s[1])) and not any(o[3] == s[3] and o[0] >= s[0] and o[1] <= s[1] and o is not s and o[3] >= 0 for o in segments):
                gold.append(s)
                covered |= set(range(s[0], s[1]))
        data.append((len(words), segments, gold))
    w, f, o = np.zeros((len(index), k)), np.zeros((k + 1, k + 1)), np.zeros(1)
    gw, gf, go = np.full_like(w, 1e-8), np.full_like(f, 1e-8), np.full_like(o, 1e-8)
    for _ in range(EPOCHS):
        r.shuffle(data)
        for n, segments, gold in data:
            score = [w[s[2]].sum(0) for s in segments]
            ends: list[list[int]] = [[] for _ in range(n + 1)]
            starts: list[list[int]] = [[] for _ in range(n + 1)]
            for x, s in enumerate(segments):
                ends[s[1]].append(x)
                starts[s[0]].append(x)
            e = np.exp(f)
            fwd, bwd = np.zeros((n + 1, k + 1)), np.zeros((n + 1, k + 1))
            fwd[0, 0], shift = 1.0, math.exp(o[0])
            up = [np.exp(np.minimum(x, 30)) for x in score]
            for j in range(1, n + 1):
                fwd[j, 0] = fwd[j - 1] @ e[:, 0] * shift
                for x in ends[j]:
                    fwd[j, 1:] += fwd[segments[x][0]] @ e[:, 1:] * up[x]
            bwd[n] = 1.0
            for i in range(n - 1, -1, -1):
                bwd[i] = e[:, 0] * shift * bwd[i + 1, 0]
                for x in starts[i]:
                    bwd[i] += e[:, 1:] @ (up[x] * bwd[segments[x][1], 1:])
            z = fwd[n].sum()
            if not np.isfinite(z) or z <= 0:
                continue
            dw: dict[int, np.ndarray] = {}
            df, do = np.zeros_like(f), 0.0
            for x, (i, j, numbers, _) in enumerate(segments):
                pair = fwd[i][:, None] * e[:, 1:] * up[x] * bwd[j, 1:] / z
                df[:, 1:] -= pair
                p = pair.sum(0)
                for c in numbers:
                    dw[c] = dw.get(c, 0) - p
            for j in range(1, n + 1):
                pair = fwd[j - 1] * e[:, 0] * shift * bwd[j, 0] / z
                df[:, 0] -= pair
                do -= pair.sum()
            last, at = 0, 0
            for i, j, numbers, t in sorted(gold, key=lambda s: s[0]):
                for _ in range(i - at):
                    df[last, 0] += 1
                    do += 1
                    last = 0
                df[last, t + 1] += 1
                one = np.eye(k)[t]
                for c in numbers:
                    dw[c] = dw.get(c, 0) + one
                last, at = t + 1, j
            for _ in range(n - at):
                df[last, 0] += 1
                do += 1
                last = 0
            for c, g in dw.items():
                g = g - 1e-3 * w[c]
                gw[c] += g * g
                w[c] += 0.3 * g / np.sqrt(gw[c])
            gf += df * df
            f += 0.3 * df / np.sqrt(gf)
            go += do * do
            o += 0.3 * do / np.sqrt(go)
    return Field(index, w, f, float(o[0]))


def all_spans(text: str, field: Field) -> tuple[list[Span], list[Span]]:
    """(base spans, base and added spans), each by start and then kind."""
    base = base_spans(text)
    known = {(a, b): t for a, b, t in base}
    added: list[Span] = []
    for words in stretches(text):
        added += field.decode(words, text, known)
    starts = sorted((a, b) for a, b, _ in base)
    most = np.maximum.accumulate([b for _, b in starts]).tolist() if base else []
    fresh = []
    for a, b, t in added:
        before = bisect_left(starts, (b,))  # base spans that start before this one ends
        if not before or most[before - 1] <= a:
            fresh.append((a, b, t))
    return base, sorted(base + fresh, key=lambda s: (s[0], s[2]))


def _named(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[t]}:{a}:{b}" for a, b, t in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its first kind."""
    out, at = [], 0
    for a, b, t in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[t].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def _found(texts: pa.Array, field: Field) -> Iterator[tuple[str, list[Span], list[Span]]]:
    hit = pc.match_substring_regex(texts, r"[0-9@]|[\[(]at[\])]").to_pylist()
    for text, any_anchor in zip(texts.to_pylist(), hit):
        yield (text, *(all_spans(text, field) if any_anchor else ([], [])))


_OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for each row of ``docs``.

    ``spans`` may name a fifth kind, secret: keys and tokens after a word that says so.

    Counts and digest are those of the base spans; ``spans`` has all.  Null and
    empty texts have none; repeated rows get equal results.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for _, base, both in _found(batch.column("text"), shared.value):
                n = [0] * BASE_KINDS
                for s in base:
                    n[s[2]] += 1
                rows.append((*n, hashlib.sha256(_named(base).encode()).hexdigest(), _named(both)))
            types = [pa.int64()] * BASE_KINDS + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(zip(*rows), types))], [c.split()[0] for c in _OUT.split(", ")])

    return id_text(docs).mapInArrow(run, _OUT)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans of ``text`` replaced, and ``n_chars`` made to fit.

    Every other column stays as it is; a null text stays null.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            at = names.index("text")
            texts = batch.column(at)
            out = [redacted(t, spans) for t, _, spans in _found(pc.fill_null(texts, ""), shared.value)]
            columns = list(batch.columns)
            columns[at] = pc.if_else(pc.is_null(texts), pa.scalar(None, texts.type), pa.array(out, texts.type))
            if "n_chars" in names:
                c = names.index("n_chars")
                columns[c] = pc.if_else(pc.is_null(texts), columns[c], pc.cast(pc.utf8_length(columns[at]), columns[c].type))
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, docs.schema)
