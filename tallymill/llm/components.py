"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymill.session import written


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(``node``, ``component``): each linked node and the smallest node it reaches.

    Links may repeat or join a node with itself; nulls are left out. Each round
    hangs the larger neighbours of every node on its smallest neighbour, then the
    smaller ones, and writes the links that remain to the shared folder. A node
    with very many neighbours is only ever aggregated, with partial results per
    task. Rounds end when the links no longer change.
    """
    pair = [F.greatest(left, right).alias("u"), F.least(left, right).alias("v")]
    edges = written(links.select(*pair).filter("u > v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u > v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = written(small.filter("u > v").distinct(), "links")
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
