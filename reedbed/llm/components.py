"""Connected components of links between numbers, as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reedbed.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(``a``, ``b``) to (``node``, ``root``): each linked node and the smallest node it reaches.

    Every node hooks on its smallest neighbour, the chains so made are halved until they are stars, and
    the links between stars are the next round's. All but the smallest of its neighbourhood vanish in a
    round, so rounds are few; no node's neighbours are ever gathered. Each step is written, which keeps the plans short.
    """
    links = materialize(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    found = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("root")), "parents")
        while True:
            above = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            jumped = parents.join(above, "root").select("node", "higher", (F.col("higher") != F.col("root")).alias("moved"))
            jumped = materialize(jumped, "parents")
            parents = jumped.select("node", F.col("higher").alias("root"))
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = parents
        else:
            step = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            found = materialize(found.join(step, "root", "left").select("node", F.coalesce("higher", "root").alias("root")), "found")
        at_a, at_b = (parents.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
        moved = links.join(at_a, "a").join(at_b, "b").where("root_a <> root_b")
        links = materialize(moved.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b")).distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")) if found is None else found
