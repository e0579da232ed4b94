"""Deterministic BM25 search with exact-term boosts, as two passes of one scan.

The query's terms are known on the driver, so no postings are built and no text is
cut into its tokens: one expression gives a record's length in tokens, and one the
few tokens that the query asks for.  The first pass adds up records, lengths and
document frequencies (one row, from partial sums); the second scores against that
row, keeps the best k per partition and merges those.  Nothing is shuffled but the
partial sums and the k.  For many queries over the same records, ``tokenized``
records that are cached, or ``postings``, save the text passes.

Statistics are those of the records passed in, so a filter on record types comes
first: as an argument of ``search``, not as a filter on its result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.functions.text import TOKEN, once, snippet, text_of, tokens
from quarry.lineage import cut

# The ranking's constants.
K1, B = 1.2, 0.75
WHOLE, PART, PHRASE = 8.0, 4.0, 2.0
# Bounds of memory only: pairs in an Arrow batch, repeated ids that are broadcast.
PAIRS, SENT = 100_000, 100_000


def query_terms(query: str) -> tuple[str, list[str]]:
    """The query as it is compared, and its tokens in order; ValueError if there is none."""
    q = query.strip().lower()
    if not q:
        raise ValueError("query must not be empty")
    terms = re.findall(TOKEN, q)
    if not terms:
        raise ValueError("query has no searchable token")
    return q, terms


def tokenized(records: DataFrame) -> DataFrame:
    """``records`` with their tokens; worth caching where many queries follow."""
    return records if "tokens" in records.columns else once(records, tokens=tokens(F.col("text")))


def counted(records: DataFrame, terms: list[str]) -> DataFrame:
    """``records`` with their length in tokens and, for each distinct term, its count, evaluated once a row."""
    distinct = list(dict.fromkeys(terms))
    if "tokens" in records.columns:
        length, held = F.size("tokens"), F.filter("tokens", lambda x: x.isin(*distinct))
    else:
        low = F.lower(text_of("text"))
        # A term is a run of token characters, so it stands for itself in a pattern.
        asked = rf"(?<![a-z0-9_])(?:{'|'.join(distinct)})(?![a-z0-9_])"
        length, held = F.regexp_count(low, F.lit(TOKEN)), F.regexp_extract_all(low, F.lit(asked), F.lit(0))
    first = once(records, length=length, held=held)
    tf = F.transform(F.array(*map(F.lit, distinct)), lambda t: F.size(F.filter("held", lambda x: x == t)))
    return once(first, tf=tf).drop("held")


def _sums(own: DataFrame, terms: list[str]) -> DataFrame:
    dfs = [F.sum(F.when(F.get("tf", F.lit(i)) > 0, 1).otherwise(0)).cast("double").alias(f"df_{i}") for i in range(len(dict.fromkeys(terms)))]
    return own.agg(F.count("*").cast("double").alias("n"), F.avg("length").alias("mean"), *dfs)


def statistics(records: DataFrame, terms: list[str]) -> DataFrame:
    """One row: n records, their mean length, and for each distinct term df_i."""
    return _sums(counted(records, terms), terms)


def _text_score(terms: list[str]) -> Column:
    total = F.lit(0.0)
    places = {t: i for i, t in enumerate(dict.fromkeys(terms))}
    for t in terms:
        df, tf = F.col(f"df_{places[t]}"), F.get("tf", F.lit(places[t])).cast("double")
        idf = F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5))
        total = total + F.when(tf > 0, idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("length") / F.col("mean")))).otherwise(0.0)
    return total


def _boost(query: str, terms: list[str]) -> Column:
    exact = F.transform("exact_terms", lambda x: F.lower(x))
    total = F.when(F.array_contains(exact, query), WHOLE).otherwise(0.0)
    for t in terms:
        total = total + F.when(F.array_contains(exact, t), PART).otherwise(0.0)
    return total + F.when(F.contains(F.lower(text_of("text")), F.lit(query)), PHRASE).otherwise(0.0)


def scores(records: DataFrame, query: str, boosts: bool = True) -> DataFrame:
    """``records`` that match, with ``score``: above 0 unrounded, then to 6 places."""
    q, terms = query_terms(query)
    own = counted(records, terms)
    scored = own.crossJoin(F.broadcast(_sums(own, terms))).filter((F.col("length") > 0) & (F.col("mean") > 0))
    score = _text_score(terms)
    if boosts:
        score = score + F.coalesce(_boost(q, terms), F.lit(0.0))
    kept = [c for c in records.columns if c != "tokens"]
    return once(scored, raw=score).filter("raw > 0").select(*kept, F.round("raw", 6).alias("score"))


def search(records: DataFrame, query: str, limit: int = 10, record_types: list[str] | None = None) -> DataFrame:
    """The best ``limit`` records: score down, record_type up, record_id up.

    Columns: record_id, record_type, title, dataset_id, score, snippet,
    source_url, source_document, page.  Snippets are cut after the limit.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    _, terms = query_terms(query)
    searched = records.filter(F.col("record_type").isin(*record_types)) if record_types else records
    order = [F.desc("score"), F.asc("record_type"), F.asc("record_id")]
    best = scores(searched, query).orderBy(*order).limit(limit)
    cut = snippet(F.col("text"), terms)
    return best.select("record_id", "record_type", "title", "dataset_id", "score", cut.alias("snippet"), "source_url", "source_document", "page").orderBy(*order)


def _merged_postings(records: DataFrame) -> DataFrame:
    """Postings of records whose ids may repeat: every pair of term and record is shuffled."""
    own = tokenized(records).select("record_id", F.size("tokens").alias("length"), F.explode("tokens").alias("term"))
    return own.groupBy("term", "record_id").agg(F.count("*").alias("tf"), F.max("length").alias("length"))


def _counted_terms(kind: pa.DataType):
    def batch(terms: list, rows: list[int], tfs: list[int], lengths: list[int], ids: pa.Array) -> pa.RecordBatch:
        own = ids.take(pa.array(rows, pa.int64())).cast(kind)
        return pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), own, pa.array(tfs, pa.int64()), pa.array(lengths, pa.int32())], ["term", "record_id", "tf", "length"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut_up = re.compile(TOKEN).findall
        for read in batches:
            ids, texts = read.column(0), read.column(1)
            terms, rows, tfs, lengths = [], [], [], []
            for i, text in enumerate(texts):
                own = cut_up(text.as_py())
                held = Counter(own)
                terms += held
                tfs += held.values()
                rows += [i] * len(held)
                lengths += [len(own)] * len(held)
                if len(terms) >= PAIRS:
                    yield batch(terms, rows, tfs, lengths, ids)
                    terms, rows, tfs, lengths = [], [], [], []
            if terms:
                yield batch(terms, rows, tfs, lengths, ids)

    return run


def _own_postings(records: DataFrame) -> DataFrame:
    """Postings of records with ids of their own: each is counted where it stands, nothing is shuffled."""
    text = F.array_join("tokens", " ") if "tokens" in records.columns else F.lower(text_of("text"))
    own = records.select("record_id", text.alias("text"))
    kind = own.schema["record_id"].dataType
    out = T.StructType([T.StructField("term", T.StringType()), T.StructField("record_id", kind), T.StructField("tf", T.LongType()), T.StructField("length", T.IntegerType())])
    return own.mapInArrow(_counted_terms(to_arrow_type(kind)), out)


def postings(records: DataFrame) -> DataFrame:
    """(term, record_id, tf, length): an index to keep, best written in buckets of ``term``.

    Ids that stand more than once are looked for first, by the ids alone; only their
    records, whose counts have to be added up, are shuffled.
    """
    ids = records.select(F.col("record_id").alias("_id"))
    twice = cut(ids.groupBy("_id").agg(F.count("*").alias("n")).filter("n > 1").select("_id"))
    repeated = twice.count()
    if not repeated:
        return _own_postings(records)
    if repeated > SENT:
        return _merged_postings(records)
    same = F.col("record_id").eqNullSafe(F.col("_id"))
    once_only, more = (records.join(F.broadcast(twice), same, how) for how in ("left_anti", "left_semi"))
    return _own_postings(once_only).unionByName(_merged_postings(more))


def document_frequency(records: DataFrame) -> DataFrame:
    """(term, df, tf) over all records: how many hold a term, and how often it stands."""
    own = tokenized(records)
    held = own.select(F.explode(F.array_distinct("tokens")).alias("term"), F.lit(1).alias("d"), F.lit(0).alias("t"))
    every = own.select(F.explode("tokens").alias("term"), F.lit(0).alias("d"), F.lit(1).alias("t"))
    return held.unionByName(every).groupBy("term").agg(F.sum("d").alias("df"), F.sum("t").alias("tf"))
