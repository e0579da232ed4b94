"""Whole-batch text primitives shared by the training-data operators.

Everything here works on Arrow string columns, one record batch at a time, so
memory is bounded by the batch and not by the partition.  Texts are never cut:
a text longer than the slice bound travels alone in its slice.  A null text
counts as the empty text.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 6 << 20
BATCH_BYTES = 16 << 20


def _lut(words_only: bool) -> np.ndarray:
    lut = np.arange(256, dtype=np.uint8)
    lut[65:91] += 32
    for b in range(128):
        c = chr(b)
        if b in (9, 10, 11, 12, 13) or words_only and not (c.isalnum()):
            lut[b] = 32
    return lut


#: A-Z lowered and ASCII white space as blanks: words are ``[^\x20\x09-\x0D]+``.
LOWER_SPACE = _lut(False)
#: A-Z lowered and every other ASCII byte but a-z and 0-9 as a blank.
LOWER_ALNUM = _lut(True)


def bounded_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch, unless the session has a bound of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    digits = re.sub(r"\D", "", spark.conf.get(key)) or "0"
    if not 0 < int(digits) <= 64 << 20:
        spark.conf.set(key, str(BATCH_BYTES))


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of doc_id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def id_text(docs: DataFrame, *more: Column) -> DataFrame:
    """Only the columns that an operator needs, so that no other name can clash."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut by rows so that the texts of each stay within ``most`` bytes."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def raw(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and the n + 1 offsets of its rows."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    arr = pc.fill_null(arr, b"" if pa.types.is_binary(arr.type) or pa.types.is_large_binary(arr.type) else "")
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = arr.buffers()
    offs = np.frombuffer(bufs[1], np.int64 if wide else np.int32)[arr.offset : arr.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offs[0] : offs[-1]] if bufs[2] is not None else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def strings(data: np.ndarray, offs: np.ndarray) -> pa.Array:
    """A string column over bytes and offsets."""
    return pa.LargeStringArray.from_buffers(len(offs) - 1, pa.py_buffer(np.ascontiguousarray(offs, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def translated(arr: pa.Array, lut: np.ndarray) -> pa.Array:
    data, offs = raw(arr)
    return strings(lut[data], offs)


def split(arr: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All blank-separated words of a column, and the number of words of each row."""
    lists = pc.ascii_split_whitespace(arr)
    flat = lists.flatten()
    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    keep = pc.greater(pc.binary_length(flat), 0)
    row = np.repeat(np.arange(len(n)), n)[keep.to_numpy(zero_copy_only=False)] if len(flat) else np.zeros(0, np.int64)
    return flat.filter(keep), np.bincount(row, minlength=len(n)).astype(np.int64)


def word_count(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Words in each row of blank-separated bytes."""
    n = len(offs) - 1
    if not len(data):
        return np.zeros(n, np.int64)
    word = data != 32
    start = word.copy()
    start[1:] &= ~word[:-1]
    begin = offs[:-1][offs[:-1] < offs[1:]]
    start[begin] = word[begin]
    total = np.concatenate([[0], np.cumsum(start, dtype=np.int64)])
    return total[offs[1:]] - total[offs[:-1]]


def pack(*parts) -> bytes:
    """Arrays and bytes as one compressed value; integers by byte planes."""
    flat = []
    for p in parts:
        if isinstance(p, np.ndarray) and len(p) and p.dtype.itemsize > 1 and p.dtype.kind in "iu":
            flat.append((p.dtype.str, len(p), p.view(np.uint8).reshape(len(p), -1).T.tobytes()))
        elif isinstance(p, np.ndarray):
            flat.append((p.dtype.str, -1, p.tobytes()))
        else:
            flat.append((None, 0, p))
    return zstandard.compress(pickle.dumps(flat), 3)


def unpack(data: bytes) -> list:
    out = []
    for kind, n, body in pickle.loads(zstandard.decompress(data)):
        if kind is None:
            out.append(body)
        elif n < 0:
            out.append(np.frombuffer(body, kind))
        else:
            size = np.dtype(kind).itemsize
            out.append(np.ascontiguousarray(np.frombuffer(body, np.uint8).reshape(size, n).T).view(kind).ravel())
    return out
