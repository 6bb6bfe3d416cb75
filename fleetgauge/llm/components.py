"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.session import new_scratch_path


def _stars(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    linked = both.join(least, "a").select("a", "b", F.least("a", "least").alias("least"))
    return linked.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _trees(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them; ``a`` is above ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    below = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return below.union(least.select("a", F.col("least").alias("b")))


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b): the smallest node that it is connected with.

    Nodes are of any ordered type; loops and repeated edges do no harm, edges with a NULL end are
    dropped, no edges give no rows. Each round is written to the shared folder, so lineage stays
    short; rounds go on until none changes an edge, a logarithmic number. Only two sums come to the driver.
    """
    spark = edges.sparkSession
    edges = edges.where("a is not null and b is not null and a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state = None
    while True:
        path = new_scratch_path(spark, "edges")
        edges.where("a <> b").distinct().write.parquet(path)
        edges = spark.read.parquet(path)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
        if not now[0]:
            break
        edges = _trees(_stars(edges).distinct())
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
