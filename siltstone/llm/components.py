"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.common import stored


def components(links: DataFrame, folder: str) -> DataFrame:
    """``k, c``: every linked node with the smallest node of its component.

    ``links`` has node numbers ``a`` and ``b``. Large-star and small-star steps take
    turns until nothing changes; what they link to is found by aggregation, so a
    node with very many links is not gathered in one task. Each step's links are
    written to ``folder``. Nulls, loops and repeated links do not matter.
    """
    spark = links.sparkSession
    edges = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        f"{folder}/links-0",
    )
    step, before = 0, None
    while True:
        state = edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if state == before or not state[0]:
            break
        step, before = step + 1, state
        edges = stored(_small_star(_large_star(edges)), f"{folder}/links-{step}")
    if not before:
        return spark.createDataFrame([], "k long, c long")
    ends = edges.select(F.col("u").alias("k"), F.col("v").alias("c"))
    return ends.union(ends.select(F.col("c").alias("k"), "c").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of a node move to its smallest neighbour or itself."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
