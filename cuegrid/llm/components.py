"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuegrid.llm.common import stash


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of bigint ids -> ``(id, component)``: the smallest id reachable by edges.

    Only ids with an edge are returned; no edges give an empty table; self loops and repeated
    edges are harmless; rows with a null end are ignored.  Each round every vertex takes the
    smallest label among itself and its neighbours and then its label's label; both steps are
    joins on ids followed by a partially aggregated ``min``, so that a hub with many edges meets
    no group in one task.  The lineage is cut after each round by a table in the shared folder.
    """
    e = edges.select("a", "b").where("a is not null and b is not null")
    both = stash(e.union(e.select("b", "a")).where("a <> b").distinct())
    labels = stash(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "id"))
    while True:
        near = (
            both.join(labels, both["b"] == labels["id"])
            .groupBy(both["a"].alias("id"))
            .agg(F.min("component").alias("other"))
        )
        step = labels.join(near, "id", "left").select(
            "id", F.col("component").alias("was"), F.least("component", "other").alias("component")
        )
        up = labels.select(F.col("id").alias("component"), F.col("component").alias("up"))
        step = stash(step.join(up, "component", "left").select("id", "was", F.least("component", "up").alias("component")))
        labels = step.select("id", "component")
        if not step.where("was <> component").limit(1).count():
            return labels
