"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabspark.llm.scratch import cut, drop


def _stars(edges: DataFrame) -> bool:
    """True if every node has one larger-to-smaller edge or only smaller-to-larger ones: nothing is left to contract."""
    role = edges.select(F.explode(F.array(F.struct(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")),
                                          F.struct(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))).alias("r"))
    return role.groupBy("r.n").agg(F.sum("r.up").alias("up"), F.max("r.down").alias("down")).filter("up > 1 or up + down > 1").isEmpty()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) of every node with an edge; component is the smallest node.

    Each round contracts larger neighbours to the smallest one (large star), then
    smaller ones (small star); stars double their reach, so rounds grow with the
    logarithm of a component's diameter, until stars are all there is. Minima combine before the shuffle, and
    the join back has one row per node on one side, so a hub is a skewed join
    that Spark splits. Every round is a written table. Loops and edges with a
    null end are ignored; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).filter(
        F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col(src) != F.col(dst))).distinct()
    e = cut(e, "edges")
    while not _stars(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("s"))
        after = cut(small.select("s.*").filter("u != v").distinct(), "edges")
        drop(spark, e)
        e = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
