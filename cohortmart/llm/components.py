"""Connected components of a graph in tables, by alternating stars.

Each round points every vertex's larger neighbours at its least neighbour
(large star), then its smaller ones at the least of them (small star).  All
grouping is a minimum combined before the shuffle and all joins are plain
equi-joins, so a vertex with a third of all edges is no single task's work.
Rounds are written tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component) of every vertex of ``edges`` (u long, v long), the
    component being its least vertex; in any direction, loops allowed."""
    now = common.materialize(
        edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # Every edge now has u > v.
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(lowest, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(lowest.select("u", F.col("m").alias("v"))).distinct())
        now = common.materialize(small, "edges")
        before, state = state, _state(now)
        if state == before:
            break
    # Stars: every vertex points at its component.
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("component")).unionAll(
        now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct())
