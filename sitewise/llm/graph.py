"""Connected components by least labels, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.llm.common import saved


def components(edges: DataFrame) -> DataFrame:
    """edges has a and b. Gives vertex and component, the least vertex reachable, for every vertex with an edge.

    Each round takes the least label among neighbours and then the label of that label, so that rounds grow with the
    logarithm of a component's width. Minima are aggregated before the shuffle, and joins read saved tables, so
    that adaptive execution splits a vertex with very many edges.
    """
    both = edges.select("a", "b").where("a <> b").union(edges.select("b", "a").where("a <> b")).distinct()
    both = saved(both, "graph-edges")
    labels = saved(both.groupBy(F.col("a").alias("vertex")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "graph-labels")
    while True:
        near = both.join(labels.select(F.col("vertex").alias("b"), "component"), "b").groupBy(F.col("a").alias("vertex")).agg(F.min("component").alias("near"))
        step = saved(labels.join(near, "vertex").select("vertex", F.col("component").alias("old"), F.least("component", "near").alias("label")), "graph-step")
        above = step.select(F.col("vertex").alias("label"), F.col("label").alias("above"))
        jumped = step.join(above, "label", "left").select("vertex", "old", F.least("label", F.coalesce("above", "label")).alias("component"))
        jumped = saved(jumped, "graph-labels")
        labels = jumped.select("vertex", "component")
        if not jumped.where("component <> old").limit(1).count():
            return labels
