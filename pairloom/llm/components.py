"""Connected components of a table of links, without collecting any of it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.sources.storage import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for the nodes of ``links(a, b)``; the root is the smallest node reached.

    Alternates two steps until nothing changes: every node hands its larger neighbours its smallest
    one, then its smaller ones. Each star gets flatter, so chains need rounds like the logarithm of their
    length. Every round is written to the shared folder.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(edges.where(F.col("u") != F.col("v")).distinct(), "links")
    total = _check(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where(F.col("u") != F.col("v")).distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = materialize(small.where(F.col("u") != F.col("v")).distinct(), "links")
        now = _check(edges)
        if now == total:
            break
        total = now
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _check(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", "u"))).first()
    return tuple(row)
