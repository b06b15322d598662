"""Connected components of an edge table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.config import keep, shared_dir


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge: columns ``node``, ``component``.

    ``edges``: a bigint, b bigint, no nulls.  Each round sends every node to its least neighbour and
    contracts the graph; stars vanish in one round, paths shrink by half at least.  Rounds are written
    to the shared folder, so a lost executor costs one step, and nothing is collected but a count.
    An empty table gives an empty table.
    """
    spark = edges.sparkSession
    folder = shared_dir(spark)
    current = keep(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(),
                   f"{folder}/edges-0")
    steps: list[DataFrame] = []
    while not current.isEmpty():
        n = len(steps)
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.least("a", F.min("b")).alias("to"))
        step = keep(step.withColumnRenamed("a", "node"), f"{folder}/step-{n}")
        steps.append(step)
        moved = current.join(step, current["a"] == step["node"]).select(F.col("to").alias("x"), "b")
        moved = moved.join(step, moved["b"] == step["node"]).select("x", F.col("to").alias("y"))
        # where every node ends at a least neighbour that points at itself, nothing is left
        links = moved.unionAll(step.select(F.col("node").alias("x"), F.col("to").alias("y"))
                               .join(step.select(F.col("node").alias("y"), F.col("to").alias("z")), "y")
                               .where("y <> z").select(F.col("y").alias("x"), F.col("z").alias("y")))
        links = links.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).where("a < b").distinct()
        current = keep(links, f"{folder}/edges-{n + 1}")
    if not steps:
        return spark.createDataFrame([], "node bigint, component bigint")
    found = steps[-1].select("node", F.col("to").alias("component"))
    for step in reversed(steps[:-1]):
        later = found.select(F.col("node").alias("to"), "component")
        found = step.join(later, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
    return found
