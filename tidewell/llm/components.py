"""Connected components of a graph given as links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.storage import write_once


def _stars(links: DataFrame, small: bool) -> DataFrame:
    """Link each node's larger (or, if `small`, not larger) neighbours to the smallest node around it."""
    if small:
        around = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("other"))
    else:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).toDF("node", "other")
    least = around.groupBy("node").agg(F.min("other").alias("least"))
    least = least.withColumn("least", F.least("node", "least"))
    met = around.join(least, "node")
    if small:
        # The node itself also moves to the smallest.
        out = met.select(F.col("other").alias("a"), F.col("least").alias("b")).unionByName(
            least.select(F.col("node").alias("a"), F.col("least").alias("b"))
        )
    else:
        out = met.filter("other > node").select(F.col("other").alias("a"), F.col("least").alias("b"))
    return out.filter("a <> b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root, the smallest node that links reach from it, for every node of `links` (a, b).

    Each round contracts neighbourhoods to stars and is written to the shared folder, so the lineage stays
    short; a round's number of links is all the driver sees. Ends when a round changes nothing.
    """
    links = write_once(links.filter("a <> b").select("a", "b").distinct(), "links")
    while True:
        large = write_once(_stars(links, small=False), "links")
        after = write_once(_stars(large, small=True), "links")
        # A forest of stars: every node on the left side once, and none of them on the right.
        same = after.count() == links.count() and after.join(links, ["a", "b"], "left_anti").isEmpty()
        links = after
        if same:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
