"""Shortest paths by number of steps, from some nodes of a graph to all that they reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallymill.session import written


def hops(edges: DataFrame, left: str, right: str, starts: DataFrame, most: int | None = None) -> DataFrame:
    """(``node``, ``hops``): the least number of edges from a node of ``starts`` (column ``node``) to each node reached.

    Edges are taken in both directions; repeated ones, loops and those with a null end
    change nothing. Each round follows the edges of the nodes reached in the last one, and
    keeps the nodes that are new; both tables are written to the shared folder, so that a
    lost executor costs one round's work and plans stay short. A node of very many edges
    is expanded by as many tasks as adaptive execution cuts it into, and the nodes found
    are made distinct in every task before they are shuffled. Rounds end when nothing new
    is found, or after ``most`` of them.
    """
    one_way = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a <> b").distinct()
    both = written(one_way.unionByName(one_way.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    frontier = written(starts.select("node").filter("node IS NOT NULL").distinct(), "frontier")
    rounds = [frontier.withColumn("hops", F.lit(0).cast("long"))]
    known = frontier
    while most is None or len(rounds) <= most:
        met = both.join(frontier.withColumnRenamed("node", "a"), "a").select(F.col("b").alias("node")).distinct()
        frontier = written(met.join(known, "node", "left_anti"), "frontier")
        if frontier.isEmpty():
            break
        rounds.append(frontier.withColumn("hops", F.lit(len(rounds)).cast("long")))
        # A node of the last two rounds can be met again, one of an earlier round cannot.
        known = rounds[-2].select("node").unionByName(frontier)
    found = rounds[0]
    for nodes in rounds[1:]:
        found = found.unionByName(nodes)
    return found
