"""Benchmark decontamination as a prefix-filtered set join, in DataFrame operations only.

A window of an item is ``WINDOW`` consecutive words of it, or all words of a
shorter item.  A document holds a window only if it holds every two-word shingle
of it, so one shingle of each window, its necessary prefix, is enough to find
candidates.  Shingles are ordered by the number of times that the whole corpus
has them, rarest first; a shingle that the corpus never has rules its window out.
Windows that overlap mostly share their prefix, so a join row stands for a
shared shingle (an anchor) and not for a window.  An anchor carries the words
that its windows can reach (``2 * WINDOW - 2`` at most) and never its item, and
items that agree in those words share it.  Length and positional bounds are part
of the join condition; what remains is verified word by word, left and right of
the anchor.

What a benchmark sends to all tasks is bounded by its counted words and bytes
(``BROADCAST_KEYS``, ``BROADCAST_BYTES``).  A larger benchmark is joined by
shuffles: word places without their texts first, by shingle, and then only the
places that are left, with the words around them.  Keys are salted, so that
a frequent shingle is spread over ``SALTS`` tasks.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
BROADCAST_KEYS, BROADCAST_BYTES = 500_000, 48 << 20
SALTS = 16
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column, lower: bool = True) -> Column:
    """Words of a text: null has none."""
    text = F.coalesce(text, F.lit(""))
    if lower:  # lower() would also change letters beyond ASCII
        text = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    else:
        return F.array_remove(F.split(text, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")
    return F.array_remove(F.split(text, SEPARATORS), "")



def _met(left: DataFrame, right: DataFrame, key: str, small: bool, how: str = "inner", near: Column | None = None) -> DataFrame:
    """``left`` joined to ``right`` by ``key``: all of a small ``right`` everywhere, else by salted keys."""
    if small:
        on = F.col(f"l.{key}") == F.col(f"r.{key}")
        right = F.broadcast(right)
    else:
        left = left.withColumn("salt", F.pmod(F.xxhash64("p"), F.lit(SALTS)))
        right = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        on = (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l.salt") == F.col("r.salt"))
    return left.alias("l").join(right.alias("r"), on if near is None else on & near, how)


def _worded(docs: DataFrame) -> DataFrame:
    hashed = F.xxhash64("text")
    return docs.select("doc_id", hashed.alias("text_hash"), F.xxhash64("doc_id", hashed).alias("d"), words_of(F.col("text")).alias("words"))


def _shingles(docs: DataFrame) -> DataFrame:
    """One row for each word of each text, with the hash of it and the next."""
    at = _worded(docs).select("doc_id", "text_hash", "d", "words", F.posexplode("words").alias("p", "word"))
    return at.withColumn("h", F.xxhash64("word", F.get("words", F.col("p") + 1)))


def _around(words: Column, at: Column, reach: int) -> tuple[Column, Column]:
    """The words that windows over places ``at`` and ``at + 1`` can reach, and where ``at`` is among them."""
    first = F.greatest(at - reach, F.lit(0))
    return F.slice(words, first + 1, F.least(F.size(words), at + 2 + reach) - first), at - first


def _run(step: int, words: Column, p: Column, item: Column, q: Column, most: int) -> Column:
    """How many words in a row agree, from p and q on, going by ``step``.  Plain
    conditionals: the join's row never has to carry the document's words.
    """
    n = F.lit(0)
    for i in range(most - 1, -1, -1):
        n = F.when(F.get(words, p + i * step) == F.get(item, q + i * step), n + 1).otherwise(0)
    return n


def _name(near: Column, q: Column) -> Column:
    """The name of an anchor: words hold no blanks, so equal names are equal words and places."""
    return F.md5(F.concat_ws(" ", q.cast("string"), near).cast("binary"))


class Benchmark:
    """The items' distinct texts as words, what they are called, and how much they could take in every task."""

    def __init__(self, benchmark: DataFrame, window: int) -> None:
        rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("id"), words_of(F.col("text")).alias("item")).filter(F.size("item") > 0)
        rows = rows.withColumn("gid", F.xxhash64("item"))
        self.window, self.reach = window, window - 2
        self.ids = rows.select("gid", "id").distinct()
        self.items = rows.groupBy("gid", "item").agg(F.lit(0)).select("gid", "item", F.size("item").alias("m"), F.least(F.size("item"), F.lit(window)).alias("k"))
        size = F.aggregate("item", F.lit(0).cast("long"), lambda n, w: n + F.octet_length(w))
        words, octets, self.shortest = self.items.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.sum(size), F.lit(0)), F.min("m")).first()
        # A row has at most ``around`` words: their bytes, 16 for the place and padding of each, and 160 for the rest.
        around = 2 * self.reach + 2
        self.few_keys = words <= BROADCAST_KEYS
        self.few_bytes = self.few_keys and words * (16 * around + 160) + around * octets <= BROADCAST_BYTES
        placed = self.items.filter("m > 1").select("*", F.explode(F.sequence(F.lit(0), F.col("m") - 2)).alias("q"))
        near, at = _around(F.col("item"), F.col("q"), self.reach)
        self.placed = placed.select("gid", "m", "k", "q", F.xxhash64(F.get("item", F.col("q")), F.get("item", F.col("q") + 1)).alias("h"), near.alias("near"), at.alias("at"))

    def seen(self, tokens: DataFrame) -> DataFrame:
        """(h, often) of the benchmark's shingles that the corpus has."""
        wanted = self.placed.select("h").distinct()
        if self.few_keys:
            return tokens.select("h").join(F.broadcast(wanted), "h", "left_semi").groupBy("h").agg(F.count("*").alias("often"))
        return tokens.groupBy("h").agg(F.count("*").alias("often")).join(wanted, "h", "left_semi")

    def anchors(self, seen: DataFrame) -> DataFrame:
        """(gid, h, near, at, k): around the rarest shingle of each window, where the corpus has it."""
        q, m, k = map(F.col, ("q", "m", "k"))
        starts = F.sequence(F.greatest(F.lit(0), q - k + 2), F.least(q, m - k))
        slim = self.placed.select("gid", "m", "k", "q", "h").join(seen, "h", "left")
        windows = slim.select("gid", "q", "h", F.coalesce("often", F.lit(0)).alias("often"), F.explode(starts).alias("s"))
        rarest = windows.groupBy("gid", "s").agg(F.min(F.struct("often", "h", "q")).alias("least")).filter("least.often > 0")
        return self.placed.join(rarest.select("gid", F.col("least.q").alias("q")).distinct(), ["gid", "q"], "left_semi").select("gid", "h", "near", "at", "k")


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, bool]:
    """(doc_id, text_hash, p, first, last, k, name), (name, id), and whether the latter is small.

    Words first..last of a document agree with those around the anchor ``name`` at
    p.  Where they are k or more, the window's size, they lie in occurring windows;
    other rows are to be left out.  ``id`` are the items that have the anchor, as
    strings; a null item_id is the empty string.
    """
    items = Benchmark(benchmark, window)
    # The two sides of the join have a text each; only what the plan needs is read.
    anchors = items.anchors(items.seen(_shingles(docs)))
    named = anchors.withColumn("name", _name(F.col("near"), F.col("at")))
    owners = named.select("name", "gid")
    keyed = named.groupBy("h", "near", "at", "k", "name").agg(F.lit(0)).select("h", "near", "at", "k", "name")
    reach, p, at, k, near, words = items.reach, F.col("p"), F.col("at"), F.col("k"), F.col("near"), F.col("words")
    tokens, place = _shingles(docs).select("doc_id", "text_hash", "words", "p", "h"), p
    if not items.few_bytes:
        held = _met(_shingles(docs).select("h", "d", "p"), keyed.select("h").distinct(), "h", items.few_keys, "left_semi").select("l.d", "l.p", "l.h")
        of_doc = held.groupBy("d").agg(F.collect_set(F.struct("p", "h")).alias("held"))
        whole = _worded(docs.dropDuplicates()).join(of_doc, "d").select("doc_id", "text_hash", "words", F.explode("held").alias("x"))
        around, place = _around(F.col("words"), F.col("x.p"), reach)
        tokens, place = whole.select("doc_id", "text_hash", around.alias("words"), F.col("x.p").alias("p"), F.col("x.h").alias("h"), place.alias("place")), F.col("place")
    room_left, room_right = F.least(place, at, k - 2), F.least(F.size(words) - place - 2, F.size(near) - at - 2, k - 2)
    same = (F.get(words, place) == F.get(near, at)) & (F.get(words, place + 1) == F.get(near, at + 1))
    left, right = _run(-1, words, place - 1, near, at - 1, reach), _run(1, words, place + 2, near, at + 2, reach)
    fits = (place + 1 < F.size(words)) & (room_left + room_right + 2 >= k) & same
    found = _met(tokens, keyed, "h", items.few_bytes, near=fits)
    # Not a filter: that would move into the join, whose code would then be too long to be compiled.
    found = found.select("doc_id", "text_hash", "p", (p - left).alias("first"), (p + 1 + right).alias("last"), "k", "name")
    if items.shortest == 1:  # an item of one word has no shingle of two
        only = F.get("item", F.lit(0))
        single = items.items.filter("m = 1").select(F.xxhash64(only).alias("h"), only.alias("only"), _name(F.array(only), F.lit(0)).alias("name"), "gid")
        owners = owners.unionByName(single.select("name", "gid"))
        places = _shingles(docs).select("doc_id", "text_hash", "p", F.xxhash64("word").alias("h"), "word")
        alone = _met(places, single.select("h", "only", "name"), "h", items.few_bytes, near=F.col("word") == F.col("only"))
        found = found.unionByName(alone.select("doc_id", "text_hash", "p", p.alias("first"), p.alias("last"), F.lit(1).alias("k"), "name"))
    return found, owners.join(items.ids, "gid").select("name", "id").distinct(), items.few_bytes


def _covered(spans: Column) -> Column:
    """Words in the union of (first, last) spans sorted by first."""
    start = F.struct(F.lit(-1).alias("end"), F.lit(0).cast("long").alias("n"))
    grow = lambda acc, s: F.struct(
        F.greatest(acc["end"], s["last"]).alias("end"),
        (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["end"], s["first"] - 1))).cast("long").alias("n"),
    )
    return F.aggregate(spans, start, grow, lambda acc: acc["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated.

    Null and empty texts have no words and are clean; items without words have no
    windows.  Rows that repeat a doc_id and a text get equal results; a doc_id with
    several texts has a row for each.  An empty benchmark leaves every document clean.
    """
    docs = docs.select("doc_id", "text")
    found, named, small = hits(docs, benchmark, window)
    whole = F.expr("last - first + 1 >= k")
    per_doc = found.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.when(whole, F.struct("first", "last")))).alias("spans"),
        F.collect_set(F.when(whole, F.struct("name", "p"))).alias("names"),
    )
    # One place of each anchor is enough, and that place is its salt.
    at = F.transform(F.array_distinct(F.col("names.name")), lambda n: F.struct(n.alias("name"), F.xxhash64("doc_id", "text_hash").alias("p")))
    per_doc = per_doc.filter(F.size("spans") > 0).select("doc_id", "text_hash", _covered(F.col("spans")).alias("hit"), at.alias("names"))
    each = per_doc.select("doc_id", "text_hash", "hit", F.explode("names").alias("x")).select("doc_id", "text_hash", "hit", "x.name", "x.p")
    per_doc = _met(each, named, "name", small).groupBy("doc_id", "text_hash", "hit").agg(F.sort_array(F.collect_set("id")).alias("items"))
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(words_of(F.col("text"), lower=False)).cast("long").alias("n_words"))
    joined = base.alias("b").join(per_doc.alias("h"), F.col("b.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("b.text_hash") == F.col("h.text_hash")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select("b.doc_id", "n_words", F.coalesce("hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (F.coalesce("hit", F.lit(0)) > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, columns as they are."""
    whole = F.expr("last - first + 1 >= k")
    found = hits(docs.select("doc_id", "text"), benchmark, window)[0].groupBy("doc_id", "text_hash").agg(F.max(whole).alias("hit")).filter("hit")
    bad = found.select(F.col("doc_id").alias("__bad"), F.col("text_hash").alias("__hash"))
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__bad")) & (F.xxhash64("text") == F.col("__hash")), "left_anti")


ORACLE = r"""
WITH lowered AS (
  SELECT doc_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM documents),
items AS (
  SELECT item_id, list_filter(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM lowered, sizes)),
found AS (SELECT doc_id, item_id, s, k FROM places JOIN windows USING (k, t)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n, string_agg(i, ',' ORDER BY i) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(x.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(i.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(i.l, '')) AS items_sha256, coalesce(x.n, 0) > 0 AS contaminated
FROM lowered d LEFT JOIN words x USING (doc_id) LEFT JOIN named i USING (doc_id)
"""
