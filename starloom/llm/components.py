"""Connected components of an edge list, by stars, without any component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starloom.llm.tables import stored
from starloom.operators.join import lookup


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least node around it."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return lookup(both.where("b > a"), least, "a", "inner", right_grouped=True).select(
        F.col("b").alias("a"), F.col("least").alias("b")
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node, and its smaller neighbours, on the least of these."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    hung = lookup(down, least, "a", "inner", right_grouped=True).where("b <> least")
    return least.select("a", F.col("least").alias("b")).unionByName(
        hung.select(F.col("b").alias("a"), F.col("least").alias("b"))
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root``: for every node with an edge to another one, the least node it reaches.

    Alternates large and small stars (Kiveris et al. 2014) until nothing changes, in about log n
    rounds. A round joins edges with one row per node, and Spark can split that join where a node
    has very many edges. The edges and each round are stored in the shared folder.
    """
    edges = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b"), "edges")
    state = None
    while True:
        seen = Observation()
        marks = F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("all")
        edges = stored(_small_star(_large_star(edges)).distinct().observe(seen, *marks), "stars")
        if seen.get["n"] == 0 or seen.get == state:
            break
        state = seen.get
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
