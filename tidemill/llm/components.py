"""Connected components of a link table by alternating large and small stars.

Every round replaces links by links to the least node known; the number of links never
grows, and rounds grow with the logarithm of a component's diameter.  Each round is
written to the shared folder, so a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.session import new_folder, shuffles_freed


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there."""
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    with shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.parquet(path)


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (u, v) with u > v, each end moved to the least neighbour of the node between."""
    turned = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = links.unionByName(turned) if large else links
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    moved = around.join(least, "u")
    if large:
        moved = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own)
    return moved.where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, least): the least node of each linked node's component, from links (a, b)."""
    links = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links, mark = written(links, "links"), None
    while True:
        links = written(_star(_star(links, True), False), "links")
        now = links.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == mark or not now["n"]:
            break
        mark = now
    # All links lead to the least node now.
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("least")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("least")).unionByName(roots)
