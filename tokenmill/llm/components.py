"""Connected components of a link table by contraction, entirely as Spark jobs.

Each round every node takes the smallest node among itself and its neighbours as parent,
chains of parents are shortened by self-joins, and the links are rewritten to parents. Links
inside one tree disappear, so the table shrinks by a large factor a round; nothing is
collected. Every table is written once to the shared folder, which also cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.plans.prefix import materialize


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for each node that has a link.

    Links are undirected; null ends and self links are ignored; an empty table gives none.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    total = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = materialize(
            both.groupBy("a").agg(F.min("b").alias("m"))
            .select(F.col("a").alias("node"), F.least("a", "m").alias("p")), "parent")
        for _ in range(2):  # shorten: the parent of the parent
            up = parent.select(F.col("node").alias("p"), F.col("p").alias("pp"))
            parent = parent.join(up, "p", "left").select(
                "node", F.coalesce("pp", "p").alias("p"))
        parent = materialize(parent, "parent")
        if total is None:
            total = parent.select("node", F.col("p").alias("component"))
        else:
            up = parent.select(F.col("node").alias("component"), F.col("p").alias("up"))
            total = total.join(up, "component", "left").select(
                "node", F.coalesce("up", "component").alias("component"))
        total = materialize(total, "components")
        pa_ = parent.select(F.col("node").alias("a"), F.col("p").alias("pa"))
        pb_ = parent.select(F.col("node").alias("b"), F.col("p").alias("pb"))
        links = materialize(
            links.join(pa_, "a").join(pb_, "b").where("pa <> pb")
            .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b"))
            .distinct(), "links")
    if total is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    return total
