"""Baseline JPEG media columns: write, parse, Huffman-decode, thumbnail, hash.

Writing: a payload byte b becomes one flat 8 x 8 block whose quantised DC
coefficient is b - 128 under a DC quantiser of 8, so every sample of the block
is exactly b and any baseline decoder gets the payload back.  The DC code gives
category s a code of 9 - s bits; with s bits of difference and one bit for the
end of the block each block takes 10 bits, so a row of blocks (one restart
interval) is written by table look-up.

Reading: markers are parsed for any baseline file (tables, sampling factors,
restart intervals); scans are decoded in step, one symbol of every restart
segment at a time, in numpy.  Only DC coefficients are kept; AC symbols are
stepped over.  The DC coefficients of the luminance, dequantised, are the
picture at an eighth of its size: the thumbnail.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .textops import bounded_batches, id_text, raw, slices

UNIT = 576
ACROSS = 24  # blocks in a row, or a multiple of it for tall pictures
MOST_ROWS = 65528 // 8
FRAME = UNIT * 8000  # bytes in one picture; a longer payload is a run of pictures
LANES = 1 << 15

# Fixed values of the format: the order of coefficients in a block is irrelevant
# here, but not these marker codes.
SOI, EOI, SOF0, DHT, DQT, DRI, SOS, COM = 0xD8, 0xD9, 0xC0, 0xC4, 0xDB, 0xDD, 0xDA, 0xFE


@cache
def _words() -> np.ndarray:
    """The 10 bits of a block for each DC difference from -255 to 255."""
    out = np.zeros(511, np.uint64)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        code = (1 << (9 - s)) - 2  # as many ones as the length less one, then a zero
        bits = d if d >= 0 else d + (1 << s) - 1
        out[d + 255] = (code << s | bits) << 1
    return out


def _segment(marker: int, body: bytes) -> bytes:
    return bytes((0xFF, marker)) + (len(body) + 2).to_bytes(2, "big") + body


def _header(rows: int, across: int, comment: bytes) -> bytes:
    quant = bytes([0, 8] + [1] * 63)
    frame = bytes([8]) + (rows * 8).to_bytes(2, "big") + (across * 8).to_bytes(2, "big") + bytes([1, 1, 0x11, 0])
    dc = bytes([0x00] + [1] * 9 + [0] * 7 + list(range(8, -1, -1)))
    ac = bytes([0x10, 1] + [0] * 15 + [0])
    return bytes((0xFF, SOI)) + (_segment(COM, comment) if comment else b"") + _segment(DQT, quant) + _segment(SOF0, frame) + _segment(DHT, dc) + _segment(DHT, ac) + _segment(DRI, across.to_bytes(2, "big")) + _segment(SOS, bytes([1, 1, 0x00, 0, 63, 0]))


def encode(payload: bytes | np.ndarray) -> bytes:
    """A payload (a positive multiple of 576 bytes) as one or more baseline JPEGs."""
    data = np.frombuffer(payload, np.uint8) if isinstance(payload, bytes) else payload
    if not len(data) or len(data) % UNIT:
        raise ValueError(f"a payload is a positive multiple of {UNIT} bytes, not {len(data)}")
    n = -(-len(data) // FRAME)
    return b"".join(_picture(data[i * FRAME : (i + 1) * FRAME], b"part %d of %d" % (i + 1, n) if n > 1 else b"") for i in range(n))


def _picture(data: np.ndarray, comment: bytes) -> bytes:
    across = ACROSS * next(m for m in (1, 2, 3, 4, 6, 8, 12, 24) if len(data) // (ACROSS * m) <= MOST_ROWS)
    q = data.reshape(-1, across).astype(np.int16) - 128
    diff = q.copy()
    diff[:, 1:] -= q[:, :-1]
    word = _words()[diff + 255].reshape(len(q), -1, 4)
    five = word[..., 0] << np.uint64(30) | word[..., 1] << np.uint64(20) | word[..., 2] << np.uint64(10) | word[..., 3]
    packed = five.astype(">u8").view(np.uint8).reshape(len(q), -1, 8)[..., 3:].reshape(len(q), -1)
    scan = np.empty((len(q), packed.shape[1] + 2), np.uint8)
    scan[:, :-2] = packed
    scan[:, -2] = 0xFF
    scan[:, -1] = 0xD0 + np.arange(len(q)) % 8
    stuffed = scan == 0xFF
    stuffed[:, -2] = False
    flat = scan.ravel()[:-2]  # no restart marker after the last row
    at = np.flatnonzero(stuffed.ravel()[:-2]) + 1
    return _header(len(q), across, comment) + (np.insert(flat, at, 0) if len(at) else flat).tobytes() + bytes((0xFF, EOI))


@dataclass
class Frame:
    """One parsed picture: what decoding its luminance DC needs."""

    width: int
    height: int
    components: list[tuple[int, int, int, int]]  # id, horizontal and vertical sampling, quantiser
    quant: dict[int, int]
    huffman: dict[int, bytes]
    interval: int = 0
    scan: list[tuple[int, int, int]] = field(default_factory=list)  # component, DC table, AC table
    segments: list[bytes] = field(default_factory=list)
    luma: np.ndarray | None = None  # the thumbnail

    def plan(self) -> tuple:
        """What pictures must share to be decoded in step."""
        seq = []
        for c, dc, ac in self.scan:
            _, h, v, _ = self.components[c]
            seq += [(c, dc, ac)] * (1 if len(self.scan) == 1 else h * v)
        return tuple(seq), tuple(sorted(self.huffman.items()))

    def mcus(self) -> tuple[int, int]:
        """MCUs down and across."""
        hs, vs = max(c[1] for c in self.components), max(c[2] for c in self.components)
        if len(self.scan) == 1:
            _, h, v, _ = self.components[self.scan[0][0]]
            return -(-(-(-self.height * v // vs)) // 8), -(-(-(-self.width * h // hs)) // 8)
        return -(-self.height // (8 * vs)), -(-self.width // (8 * hs))


_SCAN_END = re.compile(rb"\xff[^\x00\xd0-\xd7\xff]", re.S)
_RESTART = re.compile(rb"\xff+([\xd0-\xd7])", re.S)
_PART = re.compile(rb"part ([0-9]+) of ([0-9]+)")


def _segments(scan: bytes) -> list[bytes]:
    """The restart segments of a scan, unstuffed, without fill bytes; ValueError if their markers are out of turn."""
    parts = _RESTART.split(scan)
    if any(m[0] != 0xD0 + i % 8 for i, m in enumerate(parts[1::2])):
        raise ValueError("a restart marker is missing or out of turn")
    return [s.rstrip(b"\xff").replace(b"\xff\x00", b"\xff") for s in parts[::2]]


def parse(media: bytes) -> list[Frame]:
    """The pictures of a stream of baseline JPEGs.  ValueError says what is wrong.

    A stream that ends inside a picture is wrong, and so is one with fewer or more
    pictures than their comments say.
    """
    frames, at, frame, quant, huffman, interval, begun, run = [], 0, None, {}, {}, 0, False, []
    while at < len(media):
        if media[at] != 0xFF or at + 1 >= len(media):
            raise ValueError(f"no marker at byte {at}")
        marker = media[at + 1]
        at += 2
        if marker == 0xFF:
            at -= 1
            continue
        if (marker == SOI) == begun:
            raise ValueError("a picture begins inside another" if begun else "a marker outside of a picture")
        if marker == SOI:
            frame, quant, huffman, interval, begun = None, {}, {}, 0, True
            continue
        if marker == EOI:
            if frame is None or not frame.segments:
                raise ValueError("a picture ends before its scan")
            frames.append(frame)
            begun = False
            continue
        size = int.from_bytes(media[at : at + 2], "big")
        body = media[at + 2 : at + size]
        if size < 2 or len(body) != size - 2:
            raise ValueError("a segment is cut short")
        at += size
        if marker == DQT:
            while body:
                wide = body[0] >> 4
                if len(body) < 1 + 64 * (1 + wide):
                    raise ValueError("a quantiser is cut short")
                quant[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                body = body[1 + 64 * (1 + wide) :]
        elif marker == DHT:
            while body:
                n = sum(body[1:17])
                if len(body) < 17 + n:
                    raise ValueError("a code table is cut short")
                huffman[body[0]] = body[1 : 17 + n]
                body = body[17 + n :]
        elif marker == COM and (m := _PART.fullmatch(body)):
            run.append((int(m[1]), int(m[2])))
        elif marker == DRI:
            interval = int.from_bytes(body[:2], "big")
        elif marker == SOF0:
            if body[0] != 8:
                raise ValueError("samples of 8 bits only")
            parts = [(body[i], body[i + 1] >> 4, body[i + 1] & 15, body[i + 2]) for i in range(6, 6 + 3 * body[5], 3)]
            frame = Frame(int.from_bytes(body[3:5], "big"), int.from_bytes(body[1:3], "big"), parts, quant, huffman)
        elif 0xC1 <= marker <= 0xCF and marker not in (0xC8, 0xCC):
            raise ValueError("baseline pictures only")
        elif marker == SOS:
            if frame is None:
                raise ValueError("a scan before its frame")
            end = _SCAN_END.search(media, at)
            stop = end.start() if end else len(media)
            ids = [c[0] for c in frame.components]
            scan = [(ids.index(body[i]), body[i + 1] >> 4, 0x10 | body[i + 1] & 15) for i in range(1, 1 + 2 * body[0], 2)]
            if not frame.segments or any(c == 0 for c, _, _ in scan) and all(c != 0 for c, _, _ in frame.scan):
                frame.scan, frame.interval, frame.huffman = scan, interval, dict(huffman)
                frame.segments = _segments(media[at:stop])
            at = stop
    if begun:
        raise ValueError("the stream ends inside a picture")
    if run and run != [(i + 1, len(frames)) for i in range(len(frames))]:
        raise ValueError("a picture of the run is missing")
    return frames


@cache
def _lookup(table: bytes) -> np.ndarray:
    """Length << 8 | symbol for each 16 bits that begin with a code; 0 where none does."""
    out, code, at = np.zeros(1 << 16, np.uint16), 0, 16
    for length in range(1, 17):
        for _ in range(table[length - 1]):
            out[code << (16 - length) : (code + 1) << (16 - length)] = length << 8 | table[at]
            code, at = code + 1, at + 1
        code <<= 1
    return out


_FULL = np.array([(1 << s) - 1 for s in range(17)], np.int32)
_HALF = np.array([0] + [1 << (s - 1) for s in range(1, 17)], np.int32)


def _lockstep(data: np.ndarray, start: np.ndarray, size: np.ndarray, blocks: np.ndarray, plan: tuple) -> np.ndarray:
    """DC values of every block of every segment, one row a segment.

    A segment whose blocks do not end in its last byte is damaged: ValueError.
    """
    seq, tables = plan
    tables = dict(tables)
    names = sorted(tables)
    look = np.stack([_lookup(tables[t]) for t in names])
    dc_of = np.array([names.index(dc) for _, dc, _ in seq])
    ac_of = np.array([names.index(ac) for _, _, ac in seq])
    comp_of = np.array([c for c, _, _ in seq])
    d = data.astype(np.uint32)
    window = d[:-3] << np.uint32(24) | d[1:-2] << np.uint32(16) | d[2:-1] << np.uint32(8) | d[3:]
    last = len(window) - 1
    n = len(start)
    out = np.zeros((n, int(blocks.max(initial=0))), np.int32)
    pos, k, done, stop = start * 8, np.zeros(n, np.int64), np.zeros(n, np.int64), (start + size) * 8
    pred = np.zeros((n, int(comp_of.max()) + 1), np.int32)
    lane = np.arange(n)
    single = len(seq) == 1

    def bits(p: np.ndarray) -> np.ndarray:
        return window[np.minimum(p >> 3, last)] << (p & 7).astype(np.uint32) >> np.uint32(16)

    def coded(p: np.ndarray, table: np.ndarray) -> np.ndarray:
        return look[table[0], bits(p)] if single else look[table, bits(p)]

    while len(lane):
        fresh = slice(None) if not k.any() else np.flatnonzero(k == 0)
        b = done[fresh] % len(seq)
        e = coded(pos[fresh], dc_of if single else dc_of[b])
        if (e == 0).any():
            raise ValueError("a scan holds a code that no table has")
        s = (e & 255).astype(np.int64)
        p = pos[fresh] + (e >> 8)
        raw_bits = (bits(p) >> (16 - s).astype(np.uint32)).astype(np.int32)
        value = raw_bits - np.where(raw_bits < _HALF[s], _FULL[s], 0)
        who = lane[fresh]
        value += pred[who, comp_of[b]]
        pred[who, comp_of[b]] = value
        out[who, done[fresh]] = value
        pos[fresh] = p + s
        k[fresh] = 1
        # One AC symbol for every lane; for a flat block it is the end of the block.
        e = coded(pos, ac_of if single else ac_of[done % len(seq)])
        if (e == 0).any():
            raise ValueError("a scan holds a code that no table has")
        symbol = (e & 255).astype(np.int64)
        pos += (e >> 8) + (symbol & 15)
        k = np.where(symbol == 0, 64, k + (symbol >> 4) + 1)
        over = k > 63
        done += over
        k[over] = 0
        going = done < blocks[lane]
        if not going.all():
            spare = stop[lane[~going]] - pos[~going]
            if ((spare < 0) | (spare > 7)).any():
                raise ValueError("a restart segment does not end with its blocks")
            pos, k, done, lane = pos[going], k[going], done[going], lane[going]
    return out


def decode(frames: list[Frame]) -> None:
    """Give every frame its luminance thumbnail; frames with equal tables go in step."""
    groups: dict[tuple, list[Frame]] = {}
    for f in frames:
        groups.setdefault(f.plan(), []).append(f)
    for plan, group in groups.items():
        seq, segments, blocks = plan[0], [], []
        for f in group:
            down, over = f.mcus()
            step = f.interval or down * over
            if len(f.segments) != -(-down * over // step):
                raise ValueError("a picture has too few or too many restart segments")
            left = down * over - step * np.arange(len(f.segments))
            segments += f.segments
            blocks.append(np.clip(left, 0, step) * len(seq))
        size = np.array([len(s) for s in segments], np.int64)
        data = np.frombuffer(b"".join(segments) + bytes(8), np.uint8)
        start, blocks = np.concatenate([[0], np.cumsum(size)[:-1]]), np.concatenate(blocks)
        rows = []
        for at in range(0, len(start), LANES):
            to = min(len(start), at + LANES)
            end = start[to - 1] + size[to - 1]
            got = _lockstep(data[start[at] : end + 8], start[at:to] - start[at], size[at:to], blocks[at:to], plan)
            rows.append((at, to, got))
        luma = np.array([c == 0 for c, _, _ in seq])
        at = 0
        for f in group:
            n = len(f.segments)
            values = []
            for first, past, got in rows:
                a, b = max(at, first), min(at + n, past)
                if a < b:
                    mine = got[a - first : b - first]
                    values.append(mine[np.arange(mine.shape[1]) < blocks[a:b, None]])
            values = np.concatenate(values)
            at += n
            down, over = f.mcus()
            _, h, v, table = f.components[0]
            y = values.reshape(-1, len(seq))[:, luma]
            if len(f.scan) > 1:
                y = y.reshape(down, over, v, h).transpose(0, 2, 1, 3).reshape(down * v, over * h)
            else:
                y = y.reshape(down, over)
            hs, vs = max(c[1] for c in f.components), max(c[2] for c in f.components)
            tall, wide = -(-(-(-f.height * v // vs)) // 8), -(-(-(-f.width * h // hs)) // 8)
            f.luma = np.clip((y[:tall, :wide] * f.quant[table] + 4 >> 3) + 128, 0, 255).astype(np.uint8)


def thumbnail_hash(luma: np.ndarray) -> str:
    """Average hash and difference hash (64 bits each, hex) of a thumbnail's area means."""

    def shrunk(rows: int, cols: int) -> np.ndarray:
        r = np.arange(rows) * luma.shape[0] // rows
        c = np.arange(cols) * luma.shape[1] // cols
        r1, c1 = np.append(r[1:], luma.shape[0]), np.append(c[1:], luma.shape[1])
        total = np.zeros((luma.shape[0] + 1, luma.shape[1] + 1), np.int64)
        total[1:, 1:] = luma.cumsum(0, dtype=np.int64).cumsum(1)
        r1, c1 = np.maximum(r1, r + 1), np.maximum(c1, c + 1)
        area = (r1 - r)[:, None] * (c1 - c)[None, :]
        return (total[r1][:, c1] - total[r][:, c1] - total[r1][:, c] + total[r][:, c]) / area

    small, wide = shrunk(8, 8), shrunk(8, 9)
    both = np.packbits(np.stack([(small > small.mean()).ravel(), (wide[:, 1:] > wide[:, :-1]).ravel()]), axis=1)
    return both[0].tobytes().hex() + ":" + both[1].tobytes().hex()


def media_column(docs: DataFrame) -> DataFrame:
    """(doc_id, media): each text as UTF-8, padded with bytes 255, as baseline JPEG.

    Null counts as the empty text, which is stored as 576 bytes of padding.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=2 << 20):
            data, offs = raw(batch.column("text"))
            media = []
            for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
                padded = np.full(max(UNIT, -(-(b - a) // UNIT) * UNIT), 255, np.uint8)
                padded[: b - a] = data[a:b]
                media.append(encode(padded))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(media, pa.binary())], ["doc_id", "media"])

    return id_text(docs).mapInArrow(run, "doc_id long, media binary")


_FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_pictures int, error string"


def media_features(media: DataFrame) -> DataFrame:
    """What the stored bytes of each row of (doc_id, media) hold, read back from them.

    ``feature`` is, for each picture, width x height, average hash and difference
    hash.  A null or damaged medium gives a row with ``error`` set and no payload.
    """

    def features(doc_id, blob, frames):
        data = np.concatenate([f.luma.ravel() for f in frames])
        payload = data.tobytes()
        text = len(payload.rstrip(b"\xff"))
        feature = ";".join(f"{f.width}x{f.height}:{thumbnail_hash(f.luma)}" for f in frames)
        return (doc_id, text, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(blob), hashlib.sha256(blob).hexdigest(), feature, len(frames), None)

    def failed(doc_id, blob, error):
        return (doc_id, None, None, None, None, None if blob is None else len(blob), None if blob is None else hashlib.sha256(blob).hexdigest(), None, None, str(error))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", 4 << 20):
            parsed, rows = [], []
            for doc_id, blob in zip(batch.column("doc_id").to_pylist(), batch.column("media").to_pylist()):
                try:
                    if not (frames := parse(blob or b"")):
                        raise ValueError("no picture")
                    parsed.append((doc_id, blob, frames))
                except (ValueError, IndexError, KeyError) as e:
                    rows.append(failed(doc_id, blob, e))
            try:
                decode([f for _, _, frames in parsed for f in frames])
                rows += [features(*x) for x in parsed]
            except (ValueError, IndexError, KeyError):  # find out which one is damaged
                for doc_id, blob, frames in parsed:
                    try:
                        decode(frames)
                        rows.append(features(doc_id, blob, frames))
                    except (ValueError, IndexError, KeyError) as e:
                        rows.append(failed(doc_id, blob, e))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [x.split()[0] for x in _FEATURES.split(", ")])

    bounded_batches(media.sparkSession)
    return media.select("doc_id", "media").mapInArrow(run, _FEATURES)
