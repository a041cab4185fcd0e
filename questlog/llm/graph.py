"""Connected components of a link table, by rounds of contraction."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from questlog.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root names the component.

    Each round every node joins its neighbour of least priority, a hash that
    changes from round to round, so a chain shrinks by a constant factor
    whatever its ids are. Only the links between what is left go on. Loops,
    repeats and null ends are allowed and link nothing.
    """
    edges = materialise(
        links.select("a", "b").where("a <> b").distinct(), "links"
    )
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        turn = F.lit(len(maps))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ranked = F.struct(F.xxhash64("b", turn).alias("p"), F.col("b").alias("node"))
        own = F.struct(F.xxhash64("a", turn).alias("p"), F.col("a").alias("node"))
        parents = materialise(
            both.groupBy("a").agg(F.min(F.least(ranked, own)).alias("least"))
            .select(F.col("a").alias("node"), F.col("least.node").alias("parent")),
            "parents",
        )
        maps.append(parents)
        ends = edges.join(parents.select(F.col("node").alias("a"), F.col("parent").alias("pa")), "a")
        ends = ends.join(parents.select(F.col("node").alias("b"), F.col("parent").alias("pb")), "b")
        low, high = F.least("pa", "pb"), F.greatest("pa", "pb")
        edges = materialise(
            ends.where("pa <> pb").select(low.alias("a"), high.alias("b")).distinct(), "links"
        )

    def onward(found: DataFrame, parents: DataFrame) -> DataFrame:
        step = parents.select(F.col("node").alias("root"), "parent")
        joined = found.join(step, "root", "left")
        return materialise(
            joined.select("node", F.coalesce("parent", "root").alias("root")), "roots"
        )

    if not maps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    first = maps[0].select("node", F.col("parent").alias("root"))
    return reduce(onward, maps[1:], first)
