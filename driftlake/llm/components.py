"""Connected components of a link table, by repeated contraction.

In each round every node points to its neighbour (or itself) of least priority, a hash that is new in
each round; links then join the nodes pointed to. Pointers go to strictly lesser priorities, so they form trees, and
a round leaves a fraction of the nodes, whatever the shape of the links: a chain takes logarithmically
many rounds. Rounds are checkpointed. Minima are combined on the map side, so a node with very many
links sends one row from each task; links are joined to pointers by equal keys, which Spark can
split where a node is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlake.llm.common import durable


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``: equal roots mean one component."""
    rest = durable(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    rounds: list[DataFrame] = []
    while rest.limit(1).count():
        seed = F.lit(len(rounds))

        def priority(name: str, seed=seed):
            return F.struct(F.xxhash64(F.col(name), seed).alias("p"), F.col(name).alias("v"))

        both = rest.union(rest.select("b", "a"))
        least = both.groupBy("a").agg(F.min(priority("b")).alias("n"))
        pointers = durable(least.select(F.col("a").alias("node"), F.least(F.col("n"), priority("a")).getField("v").alias("root")))
        rounds.append(pointers)
        at_a = pointers.withColumnsRenamed({"node": "a", "root": "ra"})
        at_b = pointers.withColumnsRenamed({"node": "b", "root": "rb"})
        moved = rest.join(at_a, "a").join(at_b, "b").where("ra <> rb")
        rest = durable(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if not rounds:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds[0]
    for pointers in rounds[1:]:
        step = pointers.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        out = out.join(step, "root", "left").select("node", F.coalesce("_next", "root").alias("root"))
    return out
