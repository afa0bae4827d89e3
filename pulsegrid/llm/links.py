"""Connected components of links, as Spark jobs over shrinking tables of contracted links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import Stored


def components(links: DataFrame, store: Stored, name: str) -> DataFrame:
    """node and component (the smallest node reachable) of every node with a link; ``links`` has a and b.

    Each round every node hangs itself under its smallest neighbour, the parents' parents are looked up once,
    and links between different parents go to the next round, so chains halve and stars vanish at once.
    Rounds are written to the shared folder; nothing is gathered on the driver but whether links are left.
    """
    rest = store.save(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                      f"{name}-links-0")
    found, turn = None, 0
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("up"))
        above = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
        jumped = store.save(parent.join(above, "up").select("node", F.col("top").alias("up")), f"{name}-jump-{turn}")
        if found is None:
            found = jumped.select("node", F.col("up").alias("component"))
        else:
            step = jumped.select(F.col("node").alias("component"), "up")
            found = store.save(found.join(step, "component", "left").select(
                "node", F.coalesce("up", "component").alias("component")), f"{name}-found-{turn}")
        a, b = (jumped.select(F.col("node").alias(c), F.col("up").alias(f"up_{c}")) for c in "ab")
        rest = store.save(rest.join(a, "a").join(b, "b").where("up_a <> up_b").select(
            F.greatest("up_a", "up_b").alias("a"), F.least("up_a", "up_b").alias("b")).distinct(), f"{name}-links-{turn + 1}")
        turn += 1
    if found is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found
