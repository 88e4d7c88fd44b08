"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import dealt, left_join_hot, store, store_counted


def _with_least(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v) with ``least``, the smallest of u and its neighbours v; a hub's rows may part."""
    edges, total = store_counted(edges, "cc_edges")
    least = store(dealt(edges, total, "u").groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"),
                                         F.count(F.lit(1)).alias("n")), "cc_least")
    return left_join_hot(edges, least, ["u"], "n", total)


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u long, v long); the root is its component's smallest node."""
    def stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
        """The edges written, with their number and the sum of their hashes."""
        observed = Observation()
        state = F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")
        out = store(edges.observe(observed, *state), "cc_stars")
        return out, (observed.get["n"], observed.get["sum"])

    links, total = store_counted(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v"), "cc_links")
    edges, state = stored(dealt(links, total, "u").distinct())
    seen = None
    while state != seen and state[0]:
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = dealt(large, state[0], "u").distinct()
        small = _with_least(large)
        edges = small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(small.select("u", F.col("least").alias("v")))
        edges, state = stored(dealt(edges.filter("u <> v"), 2 * state[0], "u").distinct())
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
