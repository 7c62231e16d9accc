"""Connected components of a table of links, by turns of large-star and small-star.

Each turn joins every node with the least one among its neighbours; the number of rows
never grows and the number of turns is about the logarithm of the longest path. Each turn
is cut off its lineage. A node with very many neighbours is summed up before it is moved,
and the join that follows may be split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newslens.llm.common import materialise


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    linked = both.join(_least(both), "a").where("b > a")
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down)
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b")))


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).head()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in (a, b): the least node that it is connected with."""
    links = materialise(links.select("a", "b").where("a <> b").distinct())
    state = _state(links)
    while state[0]:
        turned = _small_star(_large_star(links)).where("a <> b").distinct()
        links = materialise(turned)
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
