"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from icuqm.session import write_stage


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(id, component)`` for every end of ``edges (a, b)``; component is the smallest id reachable.

    Each round takes the smallest label among the neighbours and then follows the label of
    that label, so chains shorten by half. A node's neighbours are reduced by partial
    aggregates, and a hub's edges sit on the splittable side of the joins. Null ends and
    loops link nothing.
    """
    edges = edges.where("a is not null and b is not null and a <> b").select("a", "b")
    both = write_stage(edges.union(edges.select("b", "a")).distinct(), f"{name}-edges")
    label = write_stage(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("component")), f"{name}-labels")
    while True:
        heard = both.join(label.select(F.col("id").alias("b"), "component"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("heard"))
        nearer = label.join(heard, "id").select("id", F.col("component").alias("before"), F.least("component", "heard").alias("via"))
        jump = label.select(F.col("id").alias("via"), F.col("component").alias("beyond"))
        moved = nearer.join(jump, "via", "left").select("id", "before", F.least("via", F.coalesce("beyond", "via")).alias("component"))
        moved = write_stage(moved, f"{name}-labels")
        changed = moved.where("before <> component").limit(1).count()
        label = moved.select("id", "component")
        if not changed:
            return label
