"""Connected components of a table of links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselens.storage import settle


def components(links: DataFrame) -> DataFrame:
    """node, label: the least node that links (columns ``a``, ``b``, longs) reach from each node that has one.

    Every round hangs the neighbours of a node on the least of them, first the larger ones, then the smaller; the
    longest way to a least node shrinks to a part of itself.  Rounds are written, so none rests on another's shuffle.
    """
    edges = settle(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u")
        edges = settle(
            hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct(),
            "links",
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )
