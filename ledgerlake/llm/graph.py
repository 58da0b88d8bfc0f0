"""Connected components by alternating star steps, each a join and an aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.tables import written


def _mark(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r["n"], r["x"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an undirected graph, root the smallest node of its
    component.

    ``edges``: longs u and v.  The large-star step links the larger neighbours of each
    node to its smallest neighbour, the small-star step the smaller ones; when nothing
    changes, every component is a star around its root.  A step's smallest neighbours
    are written before they are joined with the edges, so that both sides of the join
    are dealt anew and Spark can split a node with very many edges.
    """
    now = written(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m")), "stars")
        large = both.join(low, F.col("u") == F.col("k")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "edges")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k"), "stars")
        joined = large.join(low, F.col("u") == F.col("k"))
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()
        after = written(small, "edges")
        before, mark, now = mark, _mark(after), after
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
