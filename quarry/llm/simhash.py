"""SimHash near-duplicates through Golay-code fuzzy hashing.

A 64-bit fingerprint is four segments of 16 bits.  Three wrong bits leave one
segment whole, and, going round, a whole segment whose successor has at most one
wrong bit.  So each of four tables keys a row by a segment as it is (16 bits)
and by codeword indices of the next segment in the perfect [23, 12, 7] Golay
code (12 bits).  A word within 2 of a codeword has that index alone; one at
distance 3 also gets the 5 codewords at distance 4.  If two words differ in at
most one bit, the nearest codeword of either is within 4 of the other, so one
side of the join needs a single key a table and the other at most six.

Candidates are verified inside the join.  Before it, every row is compared with
the least row of its bucket, and what that links is merged; the join then looks
for links between different merged groups only, so that a dense cluster of
fingerprints costs rows in proportion to its size and not to its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.lineage import cut

from .components import components
from .textops import bounded_batches, id_text, slices

SHINGLE = 3
DISTANCE = 3
SEED = 42
HOT = 10_000
_GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the Golay code


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The unsigned SimHash of one text; 0 for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        prints = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp long) for each row of ``docs``; null text: fingerprint 0."""
    bounded_batches(docs.sparkSession)
    return id_text(docs).mapInArrow(_fingerprints, "doc_id long, fp long")


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each 16-bit word: the index of the nearest codeword, and five more or -1."""
    syn_of_bit = []
    for bit in range(23):
        r = 1 << bit
        for top in range(22, 10, -1):
            if r >> top & 1:
                r ^= _GENERATOR << (top - 11)
        syn_of_bit.append(r)

    def syndrome(bits) -> int:
        s = 0
        for b in bits:
            s ^= syn_of_bit[b]
        return s

    leader, more = np.full(2048, -1, np.int64), [[] for _ in range(2048)]
    for weight in range(4):
        for bits in combinations(range(23), weight):
            leader[syndrome(bits)] = sum(1 << b for b in bits)
    for bits in combinations(range(23), 4):
        more[syndrome(bits)].append(sum(1 << b for b in bits))
    words = np.arange(1 << 16, dtype=np.int64)
    syn = np.zeros(1 << 16, np.int64)
    for b in range(16):
        syn ^= np.where(words >> b & 1, syn_of_bit[b], 0)
    heavy = np.bitwise_count(leader[syn].astype(np.uint64)) == 3
    extra = np.array([m if len(m) == 5 else [0] * 5 for m in more], np.int64)[syn]
    others = np.where(heavy[:, None], (words[:, None] ^ extra) >> 11, -1)
    return (words ^ leader[syn]) >> 11, others, syn


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.view(np.uint64)
    return [(u >> np.uint64(16 * s) & np.uint64(0xFFFF)).astype(np.int64) for s in range(4)]


def _rows(batches: Iterator[pa.RecordBatch], all_keys: bool) -> Iterator[pa.RecordBatch]:
    near, others, _ = _golay()
    for batch in batches:
        fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        group = batch.column("grp").to_numpy(zero_copy_only=False).astype(np.int64)
        seg = _segments(fp)
        for t in range(4):
            exact, fuzzy = seg[t], seg[(t + 1) % 4]
            base = (t << 16 | exact) << 12
            keys, rows = [base | near[fuzzy]], [np.arange(len(fp))]
            if all_keys:
                index, col = np.nonzero(others[fuzzy] >= 0)
                keys.append(base[index] | others[fuzzy[index], col])
                rows.append(index)
            row = np.concatenate(rows)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(fp[row]), pa.array(group[row])], ["key", "fp", "grp"])


def _one_key(batches):
    return _rows(batches, False)


def _six_keys(batches):
    return _rows(batches, True)


_KEYED = "key long, fp long, grp long"


def _near(a, b):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= DISTANCE


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of distinct ``fp``
    within ``DISTANCE`` bits.  ``prints`` has one row for each fingerprint.
    """
    own = prints.select("fp", F.col("fp").alias("grp"))
    probe = own.mapInArrow(_one_key, _KEYED)
    pivot = probe.groupBy("key").agg(F.min("fp").alias("p"), F.count("*").alias("n")).filter("n > 1")
    stars = cut(probe.join(pivot, "key").filter((F.col("fp") != F.col("p")) & _near("fp", "p")).select(F.col("p").alias("a"), F.col("fp").alias("b")).distinct())
    merged = components(stars)
    grouped = cut(own.select("fp").join(merged.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("grp")))
    left = grouped.mapInArrow(_one_key, _KEYED).alias("x")
    right = grouped.mapInArrow(_six_keys, _KEYED).alias("y")
    across = left.join(right, (F.col("x.key") == F.col("y.key")) & (F.col("x.fp") < F.col("y.fp")) & (F.col("x.grp") != F.col("y.grp")) & _near("x.fp", "y.fp"))
    return stars.unionByName(across.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")).distinct())


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Null and empty texts have fingerprint zero and link like any other; repeated
    rows stay repeated; a null doc_id stays null and is never a component's id
    unless its component has no other; no rows give no rows.
    """
    per_doc = cut(fingerprints(docs))
    prints = cut(per_doc.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    comps = components(links(prints.select("fp")))
    rooted = prints.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    roots = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    total = prints.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    of_print = cut(rooted.select("fp", "root", (F.col("n") * HOT >= total).alias("hot")).join(roots, "root").select("fp", "component_id", "hot"))
    # At most HOT fingerprints have that share of all rows; their rows stay where they are.
    hot = F.broadcast(of_print.filter("hot").select("fp", "component_id"))
    cold = per_doc.join(hot.select("fp"), "fp", "left_anti").join(of_print.filter(~F.col("hot")).select("fp", "component_id"), "fp")
    return per_doc.join(hot, "fp").unionByName(cold).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _print_column(docs: DataFrame) -> DataFrame:
    """``docs`` with the fingerprint of each text as ``__print``, as in ``near_duplicates``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            prints = [f"{fingerprint(t or ''):016x}" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], [*batch.schema.names, "__print"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("__print", T.StringType())]))


def representatives(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id is their component's id, columns as they are.

    Where a doc_id stands in several rows, one such row stays (the one with the
    least hashes); rows without a doc_id, in components that have none, keep one
    row for each fingerprint.
    """
    named = cut(near_duplicates(docs))
    wins = F.col("doc_id").eqNullSafe(F.col("component_id"))
    ids = named.groupBy("doc_id").agg(F.max(wins).alias("wins"), (F.count("*") > 1).alias("__many")).filter("wins").select(F.col("doc_id").alias("__id"), "__many")
    kept = docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__id")))
    once = kept.filter(~F.col("__many")).select(docs.columns)
    winners = named.filter(wins).select(F.col("doc_id").alias("__winner"), F.col("fingerprint").alias("__of")).distinct()
    again = _print_column(kept.filter("__many").select(docs.columns)).join(winners, F.col("doc_id").eqNullSafe(F.col("__winner")) & (F.col("__print") == F.col("__of")))
    row = F.struct(*(F.col(c) for c in docs.columns))
    group = F.when(F.col("doc_id").isNull(), F.col("__print"))
    one = again.groupBy("doc_id", group.alias("__group")).agg(F.min_by(row, F.struct(F.xxhash64("text"), F.xxhash64(*docs.columns))).alias("__row")).select("__row.*")
    return once.unionByName(one)
