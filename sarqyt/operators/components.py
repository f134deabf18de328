"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014).

Nothing is collected: each round is two aggregations and two joins, and each round's edges are checkpointed, so that the
lineage stays short and a lost executor costs one round. A node's stars are built from ``min`` aggregates, never from
lists of neighbours, so a hub with very many links needs no more memory than any other node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sarqyt.session import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 40) -> DataFrame:
    """Rows ``(node, component)`` for every node of ``edges``; the component is its smallest node.

    Null ends are ignored; a self-link alone yields its node; repeated links and an empty table are fine. If
    ``max_rounds`` (enough for any graph of 2**40 nodes) were passed, a ``RuntimeError`` is raised, never a wrong result.
    """
    clean = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    clean = cut(clean.distinct())
    loops = clean.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    star = clean.where("u <> v")
    before = None
    for _ in range(max_rounds):
        star = cut(_small_star(_large_star(star)))
        now = star.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected_components did not settle")
    found = star.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = star.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return found.unionAll(roots).unionAll(loops).groupBy("node").agg(F.min("component").alias("component"))
