"""Bigram language-model scores from Elias-Fano tries, sharded over the cluster.

Neither a vocabulary nor a model is ever sent to every task.  Texts are cut into
blocks of at most ``BLOCK_TEXT`` bytes (a longer text is a block of its own),
each with a dictionary of its own words, and written to the shared folder once.
Then two exchanges answer what blocks need to know:

1. words: every block sends its distinct words with their training counts to the
   shards of those words; a shard adds up, numbers its words and answers with
   numbers and counts.  Blocks now know c(w), so the base score is local.
2. bigrams: every block sends its distinct pairs of numbers with their training
   counts to the shards of those pairs (by a hash of the pair, so a frequent
   context spreads over all shards).  A shard adds up, builds its Elias-Fano
   trie of the pairs that training holds, with quantised smoothed probabilities,
   looks up the pairs of each block by context-relative successor search and
   answers with a byte a pair and its codebook.

A row of either exchange is one block's part of one shard, packed; there are
never more rows than distinct words or pairs.  The number of shards follows from
counted words and tokens, so a shard's size does not grow with the corpus.

The model is Dirichlet-smoothed, P(w | v) = (c(v, w) + MU P1(w)) / (c(v) + MU) with
P1 the add-half unigram of the base score; pairs that training lacks use the same
formula with c(v, w) = 0, exactly.  A text begins after a start context and ends
with one end token.  Word numbers that would reach 2**32 are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from quarry.lineage import cut
from .eliasfano import Trie, quantised
from .textops import LOWER_SPACE, bounded_batches, fold, id_text, pack, slices, split, translated, unpack

MU = 100.0
BLOCK_TEXT = 8 << 20
WORDS_A_SHARD, PAIRS_A_SHARD = 1_500_000, 3_000_000
MOST_PARTITIONS = 50_000  # of an exchange; beyond it a task gets several blocks or shards, one after the other
END, START, FIRST = 0, 1, 2  # numbers of the end token, the start context and the first word


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 24
    for batch in slices(batches, most=BLOCK_TEXT):
        words, n = split(translated(batch.column("text"), LOWER_SPACE))
        coded = words.dictionary_encode()
        local = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        size = len(coded.dictionary)
        # Frequent words get small numbers here and in the shards: small numbers pack well.
        order = np.argsort(-np.bincount(local, minlength=size), kind="stable")
        rank = np.empty(size, np.uint32)
        rank[order] = np.arange(size, dtype=np.uint32)
        local = rank[local]
        held = batch.column("held_out").to_numpy(zero_copy_only=False)
        train = np.repeat(~held, n)
        count = np.bincount(local[train], minlength=size).astype(np.int64)
        names = pack(b" ".join(coded.dictionary.take(pa.array(order)).cast(pa.large_binary()).to_pylist()))
        ids = batch.column("doc_id")
        lost = np.array(ids.is_null())
        body = pack(pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype(np.int64), lost, held, n.astype(np.int64), local)
        columns = [pa.array([number], pa.int64()), pa.array([body], pa.binary()), pa.array([names], pa.binary()), pa.array([pack(count)], pa.binary())]
        totals = [pa.array([x], pa.int64()) for x in (size, len(local) + len(n), int((~held).sum()))]
        yield pa.RecordBatch.from_arrays([*columns, *totals], ["block", "body", "names", "counts", "n_names", "n_tokens", "n_train"])
        number += 1


_BLOCKS = "block long, body binary, names binary, counts binary, n_names long, n_tokens long, n_train long"
_PART = "shard long, block long, part binary"


def _part_rows(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    shard, block, part = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(block, pa.int64()), pa.array(part, pa.binary())], ["shard", "block", "part"])


def _shard_of_words(names: bytes, shards: int) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) % shards for w in names.split(b" ")] if names else [], np.int64)


def _by_shard(shard: np.ndarray) -> tuple[np.ndarray, dict[int, slice]]:
    """An order by shard, and where in it each shard that occurs stands; no step for shards that do not."""
    order = np.argsort(shard, kind="stable")
    present, first = np.unique(shard[order], return_index=True)
    ends = np.append(first[1:], len(order))
    return order, {s: slice(a, z) for s, a, z in zip(present.tolist(), first.tolist(), ends.tolist())}


def _send_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, names, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "names", "counts"))):
                names = unpack(names)[0]
                shard, words, count = _shard_of_words(names, shards), names.split(b" "), unpack(counts)[0]
                order, cuts = _by_shard(shard)
                yield _part_rows([(s, block, pack(b" ".join([words[i] for i in order[cut].tolist()]), count[order[cut]])) for s, cut in cuts.items()])

    return run


def _answer_words(shards: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        shard, blocks = key[-1].as_py(), rows.column("block").to_pylist()
        parts = [unpack(p) for p in rows.column("part").to_pylist()]
        lists = [p[0].split(b" ") for p in parts]
        coded = pa.concat_arrays([pa.array(x, pa.large_binary()) for x in lists]).dictionary_encode()
        local = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.bincount(local, np.concatenate([p[1] for p in parts]), len(coded.dictionary)).astype(np.int64)
        # Numbered by falling count, ties by the word itself, so that any order of rows gives the same numbers.
        order = np.lexsort((pc.rank(coded.dictionary).to_numpy(zero_copy_only=False), -total))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        ends = np.cumsum([0] + [len(x) for x in lists])
        out = []
        for i, block in enumerate(blocks):
            mine = local[ends[i] : ends[i + 1]]
            number = (FIRST + rank[mine] * shards + shard).astype(np.int64)
            out.append((block, shard, pack(number, total[mine]), int((total > 0).sum()) if i == 0 else 0, int(total.sum()) if i == 0 else 0, int(number.max(initial=0))))
        types = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], ["block", "shard", "part", "types", "tokens", "top"])

    return run


class _Block:
    """A block with what the word shards answered: numbers and counts of all its tokens."""

    def __init__(self, rows: pa.Table, shards: int, n_train: int) -> None:
        by_kind: dict[int, dict[int, bytes]] = {0: {}, 1: {}, 2: {}}
        names = b""
        for kind, shard, part, extra in zip(*(rows.column(c).to_pylist() for c in ("kind", "shard", "part", "names"))):
            by_kind[kind][shard] = part
            names = unpack(extra)[0] if kind == 0 else names
        self.ids, self.lost, self.held, self.n, local = unpack(by_kind[0][0])
        shard = _shard_of_words(names, shards)
        number, count = np.zeros(len(shard), np.int64), np.zeros(len(shard), np.int64)
        order, cuts = _by_shard(shard)
        for s, part in by_kind[1].items():
            number[order[cuts[s]]], count[order[cuts[s]]] = unpack(part)
        self.codes = by_kind[2]
        # Tokens of all texts end to end, each text followed by its end token.
        self.size = self.n + 1
        self.ends = np.cumsum(self.size) - 1
        word = np.ones(int(self.size.sum()), bool)
        word[self.ends] = False
        self.token = np.full(len(word), END, np.int64)
        self.token[word] = number[local]
        self.count = np.full(len(word), n_train, np.int64)
        self.count[word] = count[local]
        self.context = np.concatenate([[START], self.token[:-1]])
        self.before = np.concatenate([[n_train], self.count[:-1]])
        begins = self.ends - self.n
        self.context[begins], self.before[begins] = START, n_train
        self.key = self.context << 32 | self.token

    def pairs(self, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, slice]]:
        """Distinct keys by shard and key, a place of each, each token's index, and where shards stand."""
        keys, place, inverse = np.unique(self.key, return_index=True, return_inverse=True)
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        shard = ((mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64) % shards
        order, cuts = _by_shard(shard)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return keys[order], place[order], back[inverse], cuts


def _send_pairs(shards: int, pair_shards: int, n_train: int):
    def run(rows: pa.Table) -> pa.Table:
        b = _Block(rows, shards, n_train)
        block = rows.column("block")[0].as_py()
        keys, place, index, cuts = b.pairs(pair_shards)
        seen = np.bincount(index, np.repeat(~b.held, b.size), len(keys)).astype(np.int64)
        out = []
        for s, mine in cuts.items():
            context, where = keys[mine] >> 32, place[mine]
            step = np.diff(context, prepend=0).astype(np.uint32)  # above 0 where a context begins
            word = keys[mine] & 0xFFFFFFFF
            _, first = np.unique(word, return_index=True)
            # Counts go once a context and once a word; sorted by number, words' counts hardly vary.
            ahead, behind = b.before[where][step > 0], b.count[where][first]
            out.append((s, block, pack(step, word.astype(np.uint32), ahead, behind, seen[mine].astype(np.uint32))))
        return pa.Table.from_batches([_part_rows(out)])

    return run


def log_unseen(before: np.ndarray, count: np.ndarray, total: int, types: int) -> np.ndarray:
    return np.log10(MU * (count + 0.5) / (total + 0.5 * (types + 1)) / (before + MU))


def _answer_pairs(total: int, types: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("block")
        shard, blocks = key[-1].as_py(), rows.column("block").to_pylist()
        keys, before, count, seen, sizes = [], [], [], [], []
        for p in rows.column("part").to_pylist():
            step, word, b, c, s = unpack(p)
            keys.append(np.cumsum(step, dtype=np.int64) << 32 | word.astype(np.int64))
            before.append(b[np.cumsum(step > 0) - 1])
            count.append(c[np.unique(word, return_inverse=True)[1]])
            seen.append(s)
            sizes.append(len(word))
        every, place, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        times = np.bincount(inverse, np.concatenate(seen), len(every)).astype(np.int64)
        kept = times > 0
        v, w = np.concatenate(before)[place][kept], np.concatenate(count)[place][kept]
        lp = np.log10((times[kept] + MU * (w + 0.5) / (total + 0.5 * (types + 1))) / (v + MU))
        code, book = quantised(lp)
        trie = Trie(every[kept] >> 32, every[kept] & 0xFFFFFFFF, code, book)
        out = []
        for block, k in zip(blocks, keys):
            out.append((block, shard, pack(trie.lookup(k >> 32, k & 0xFFFFFFFF), trie.codebook)))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary()))], ["block", "shard", "part"])

    return run


def _score_block(shards: int, pair_shards: int, n_train: int, total: int, types: int):
    def run(rows: pa.Table) -> pa.Table:
        b = _Block(rows, shards, n_train)
        keys, _, index, cuts = b.pairs(pair_shards)
        value = np.full(len(keys), np.nan)
        for s, part in b.codes.items():
            code, book = unpack(part)
            value[cuts[s]] = np.where(code > 0, book[code].astype(np.float64), np.nan)
        lp = value[index]
        none = np.isnan(lp)
        lp[none] = log_unseen(b.before[none], b.count[none], total, types)
        base = np.log10((b.count + 0.5) / (total + 0.5 * (types + 1)))
        begins = b.ends - b.n
        sums = [np.add.reduceat(x, begins) for x in (base, lp, (b.count > 0).astype(np.int64))]
        ids = pa.array(b.ids, mask=b.lost)
        columns = [ids, pa.array(b.held), pa.array(b.size), pa.array(sums[2]), pa.array(np.full(len(b.n), total, np.int64)), pa.array(sums[0]), pa.array(sums[1])]
        return pa.table(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


_SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``.

    Rows whose crc32 of doc_id modulo 5 is not 1 are learned from.  Null and empty
    texts are one end token; a null doc_id counts as the empty text in the hash;
    repeated rows are counted as often as they stand there; without training rows
    all counts are zero and N is 0; no rows give no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    blocks = cut(id_text(docs, (fold(F.col("doc_id"), 5) == 1).alias("held_out")).mapInArrow(_blocks, _BLOCKS))
    names, tokens, n_train, n_blocks = blocks.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_names", "n_tokens", "n_train")), F.count("*")).first()
    shards, pair_shards = max(1, -(-names // WORDS_A_SHARD)), max(1, -(-tokens // PAIRS_A_SHARD))
    # Blocks get numbers without gaps; the broadcast is a number for each input partition, which the driver has a task for.
    lots = blocks.groupBy(F.shiftright("block", 24).alias("lot")).agg(F.count("*").alias("n"))
    skips = lots.select("lot", F.coalesce(F.sum("n").over(Window.orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("skip"))
    low = F.col("block").bitwiseAND((1 << 24) - 1)
    blocks = blocks.join(F.broadcast(skips), F.shiftright("block", 24) == F.col("lot")).withColumn("block", F.col("skip") + low).drop("lot", "skip")

    def spread(df: DataFrame, key: str, n: int) -> GroupedData:
        """Groups by a number below n: a task has one, or n / MOST_PARTITIONS of them, one after the other."""
        width = max(1, min(n, MOST_PARTITIONS))
        return df.withColumn("task", F.pmod(F.col(key), F.lit(width)).cast("int")).repartitionById(width, F.col("task")).groupBy("task", key)

    sent = blocks.select("block", "names", "counts").mapInArrow(_send_words(shards), _PART)
    answers = cut(spread(sent, "shard", shards).applyInArrow(_answer_words(shards), "block long, shard long, part binary, types long, tokens long, top long"))
    types, total, top = answers.agg(*(F.coalesce(f, F.lit(0)) for f in (F.sum("types"), F.sum("tokens"), F.max("top")))).first()
    if top >= 1 << 32:
        raise ValueError(f"word numbers reach {top}, and pairs of them are kept in 64 bits: fewer than 2**32 distinct words, please")
    types, total = types + (n_train > 0), total + n_train
    none = F.lit(None).cast("binary")
    own = blocks.select("block", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("shard"), F.col("body").alias("part"), "names")
    known = own.unionByName(answers.select("block", F.lit(1).alias("kind"), "shard", "part", none.alias("names")))
    pairs = spread(known, "block", n_blocks).applyInArrow(_send_pairs(shards, pair_shards, n_train), _PART)
    codes = spread(pairs, "shard", pair_shards).applyInArrow(_answer_pairs(total, types), "block long, shard long, part binary")
    whole = known.unionByName(codes.select("block", F.lit(2).alias("kind"), "shard", "part", none.alias("names")))
    return spread(whole, "block", n_blocks).applyInArrow(_score_block(shards, pair_shards, n_train, total, types), _SCORES)
