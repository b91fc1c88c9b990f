"""Connected components of an edge table in Spark by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, scratch: Scratch, rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (u long, v long); root is the component's smallest node.

    Each round reads and writes the edge table only, aggregates before it shuffles and sends to the driver one row
    (a count and a checksum), so neither a hub nor a long chain meets in one task.  Self-loops give no row; an
    empty table gives an empty result.
    """
    current = scratch.table(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc-0"
    )
    mark = None
    for step in range(1, rounds + 1):
        current = scratch.table(_small_star(_large_star(current)), f"cc-{step}")
        scratch.drop(f"cc-{step - 1}")
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
    raise RuntimeError(f"the components have not settled after {rounds} rounds")
