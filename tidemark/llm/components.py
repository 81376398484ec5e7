"""Connected components of a link table, as repeated DataFrame jobs.

Alternating large-star and small-star steps: every node ends linked to the
smallest id of its component. All steps are groupings and joins on node ids, so
no component is ever gathered in one task; a hub with many links is split by
the skew handling of the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import scratch, stash


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lower = both if large else both.where("v < u")
    least = lower.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.where("v > u" if large else "v < u").join(least, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return moved.where("u <> v").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each linked node.

    Nodes without links, links to oneself and null ends are not in the result.
    """
    with scratch(edges.sparkSession, "components"):
        now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
            F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
        ).distinct()
        now, seen = stash(now, "links"), None
        while True:
            state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if state == seen or not state[0]:
                break
            seen = state
            now = stash(_star(_star(now, True), False), "links")
        now = stash(now, "components", keep=True)
    # now a star: every u points to the least node of its component
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
