"""Connected components as rounds of star operations on an edge table.

Each round replaces every edge by an edge to the smallest node seen from either
end (a large star, then a small star); the edge table never grows, no node's
neighbours are gathered in one row, and nothing but two numbers a round reaches
the driver.  Lineage is cut by ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.lineage import cut


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(least, "a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest
    node reachable.  Loops and repeated edges do no harm; null ends are dropped;
    no edges give no rows.
    """
    now = cut(edges.filter("a <> b").select("a", "b").distinct())
    # A table of two-column edges can be told from the next by its size and a sum of hashes.
    mark = lambda e: e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()[:]
    last = mark(now)
    for _ in range(most_rounds):
        if not last[0]:
            break
        now = cut(_small(_large(now)))
        this = mark(now)
        if this == last:
            break
        last = this
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
