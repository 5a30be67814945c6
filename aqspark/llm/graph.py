"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from aqspark.llm.common import stage


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node that it reaches, for every node in ``pairs`` (``a``, ``b``).

    Rounds contract the graph. In each, a node with a smaller neighbour is hooked to its smallest one; chains of hooks are shortened by
    doubling, and the links between the nodes that are left go on. A node that stays has taken over a neighbour or gets a smaller one by the next
    round, so two rounds leave half of the nodes at most: rounds grow with the logarithm of a component's size, and so do the doublings of
    each. At the end the hooks are followed back, from the last round to the first. Each step is a written table. Null ends are dropped; repeated
    links and links of a node with itself change nothing. The links of a hub are split by adaptive execution.
    """
    known = pairs.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    nodes = known.select(F.col("a").alias("node")).union(known.select("b")).distinct()
    found = None
    for hooks in reversed(contract(known)):
        if found is not None:
            then = found.select(F.col("node").alias("to"), "component")
            hooks = hooks.join(then, "to", "left").select("node", F.coalesce("component", "to").alias("component")).unionByName(found)
        else:
            hooks = hooks.select("node", F.col("to").alias("component"))
        found = stage(hooks, "hooked")
    if found is None:
        return nodes.select("node", F.col("node").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def contract(pairs: DataFrame) -> list[DataFrame]:
    """The hooks of each round: ``node`` and ``to``, a smaller node that isn't itself hooked in that round."""
    rounds: list[DataFrame] = []
    links = stage(pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while not links.isEmpty():
        hooks = stage(links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to")), "hooks")
        while True:
            further = hooks.select(F.col("node").alias("to"), F.col("to").alias("end"))
            doubled = stage(hooks.join(further, "to", "left").select("node", F.coalesce("end", "to").alias("to"), F.col("end").isNotNull().alias("moved")), "hooks")
            hooks = doubled.select("node", "to")
            if doubled.where("moved").isEmpty():
                break
        rounds.append(hooks)
        for end in ("a", "b"):
            links = links.join(hooks.select(F.col("node").alias(end), F.col("to").alias("root")), end, "left").withColumn(end, F.coalesce("root", end)).drop("root")
        links = stage(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return rounds
