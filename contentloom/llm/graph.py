"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on the smallest of them.

    A large star moves the larger neighbours, a small star the node itself and the smaller ones.
    Minima combine before the shuffle; the join back on a hot node is split by adaptive execution.
    """
    turned = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    if large:
        near = turned.unionByName(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    else:
        near = turned
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = near.join(least, "u")
    if large:
        moved = moved.where(F.col("v") > F.col("u")).select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        moved = moved.select(F.col("m").alias("a"), F.col("v").alias("b")).unionByName(
            least.select(F.col("m").alias("a"), F.col("u").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node reachable.

    Rounds of a large and a small star repeat until the links no longer change, which takes
    about log2 of the longest chain. NULL ends and loops are ignored. No links give no rows.
    """
    edges = cut_lineage(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a != b")
        .distinct()
    )

    def state(df: DataFrame):
        return df.select(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.count_if(F.xxhash64("a", "b") > 0)
        ).first()

    now = state(edges)
    while now[0]:
        edges = cut_lineage(_star(_star(edges, large=True), large=False))
        before, now = now, state(edges)
        if now == before:
            break
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
        edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    )
