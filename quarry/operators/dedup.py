"""Which of several rows wins: first, last, longest.  All summed up before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.lineage import cut


def _winner(df: DataFrame, keys: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(pick(F.struct(*rest)).alias("_w")).select(*keys, "_w.*").select(df.columns)


def last_wins(df: DataFrame, keys: list[str], order: Column | str = "seq") -> DataFrame:
    return _winner(df, keys, lambda row: F.max_by(row, F.col(order) if isinstance(order, str) else order))


def first_wins(df: DataFrame, keys: list[str], order: Column | str = "seq") -> DataFrame:
    return _winner(df, keys, lambda row: F.min_by(row, F.col(order) if isinstance(order, str) else order))


def merged(df: DataFrame, key: str, fill: list[str], order: str = "seq") -> DataFrame:
    """One row for each key: of each column in ``fill`` the first value that is not blank
    (the empty text if there is none), the first place, and how often the key stood."""
    firsts = [F.coalesce(F.min_by(F.when(F.col(c) != "", F.col(c)), F.when(F.col(c) != "", F.col(order))), F.lit("")).alias(c) for c in fill]
    return df.groupBy(key).agg(*firsts, F.min(order).alias(order), F.count("*").alias("times"))


def ranked(df: DataFrame, order: str, name: str, first: int = 0) -> DataFrame:
    return counted_ranks(df, order, name, first)[0]


def counted_ranks(df: DataFrame, order: str, name: str, first: int = 0) -> tuple[DataFrame, int]:
    """``df`` with each row's place in ``order``, and how many rows it has, without a task that sees all rows.

    Rows are range-partitioned and sorted, then kept; a place is the rows of
    earlier partitions, one count each, and the place in its own.
    """
    kept = cut(df.orderBy(order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", 33)
    rows = {r["part"]: r["n"] for r in kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before = [0]
    for i in range(max(rows, default=0)):
        before.append(before[-1] + rows.get(i, 0))
    skip = F.element_at(F.expr(f"array({', '.join(f'{n}L' for n in before)})"), (part + 1).cast("int"))
    own = F.col("_id").bitwiseAND((1 << 33) - 1)
    return kept.withColumn(name, skip + own + F.lit(first)).drop("_id"), sum(rows.values())
