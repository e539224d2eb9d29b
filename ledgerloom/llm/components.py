"""Connected components of a graph held as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.tables import saved


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every vertex of an edge; the component is the smallest id that links reach.

    Each round a vertex takes the smallest label of its neighbours and then the label of that label, so labels
    jump and a chain of n vertices needs about log n rounds. All steps are aggregates that combine before the shuffle,
    and joins to a side with one row per key, which adaptive execution splits when a vertex is hot. Labels are
    written each round; only the number of labels that changed comes to the driver. NULL ends of edges are ignored.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").distinct()
    both = saved(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    label = saved(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("id")).alias("component")), "labels")
    while True:
        near = both.join(label, both.b == label.id).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        step = label.join(near, "id").select("id", "component", F.least("component", "near").alias("lower"))
        jump = label.select(F.col("id").alias("lower"), F.col("component").alias("below"))
        after = saved(
            step.join(jump, "lower").select("id", F.col("component").alias("was"), F.least("lower", "below").alias("component")),
            "labels",
        )
        label = after.select("id", "component")
        if after.where("was <> component").isEmpty():
            return label
