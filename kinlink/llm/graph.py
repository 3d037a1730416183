"""Connected components by alternating large-star and small-star rounds.

Every round is two joins and two aggregations over the edge table, written to
the shared folder; the driver sees only counts.  A hub is a skewed join key,
which adaptive execution splits; no neighbour list is ever gathered.

Defined results: repeated edges count once; an empty edge table gives an empty
result; nodes without an edge are not named; a and b are whole numbers, not null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinlink.llm.common import stored


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges: a, b (long, a <> b).  Returns node, root: the smallest node of each node's component, for nodes with edges."""
    now, before = stored(edges.select("a", "b").distinct(), "edges"), None
    for _ in range(max_rounds):
        mark = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == before or not mark[0]:
            break
        before = mark
        now = stored(_small(_large(now)), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
