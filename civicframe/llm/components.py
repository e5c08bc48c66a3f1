"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicframe.session import materialise, materialise_observed


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (src, dst) between bigint ids to (id, root), root the smallest id of the component; edgeless ids are absent.

    Each round hooks every vertex to its smallest neighbour, follows two hooks, and contracts the graph; rows for a vertex
    are combined before they are shuffled. The rounds end when no edge between different vertices is left.
    """
    def cleaned(e: DataFrame) -> DataFrame:
        e = e.where("src <> dst")
        return e.select("src", "dst").unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()

    live, seen = materialise_observed(cleaned(edges), n=F.count(F.lit(1)))
    mapping = None
    while True:
        hooks = live.groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("low"))
        hooks = materialise(hooks.select("id", F.least("id", "low").alias("to")))
        upper = hooks.select(F.col("id").alias("to"), F.col("to").alias("top"))
        jumped = materialise(hooks.join(upper, "to").select("id", F.col("top").alias("to")))
        if mapping is None:
            mapping = jumped.withColumnRenamed("to", "root")
        else:
            step = jumped.select(F.col("id").alias("root"), "to")
            mapping = materialise(mapping.join(step, "root", "left").select("id", F.coalesce("to", "root").alias("root")))
        if not seen["n"]:
            return mapping
        a = jumped.select(F.col("id").alias("src"), F.col("to").alias("a"))
        b = jumped.select(F.col("id").alias("dst"), F.col("to").alias("b"))
        contracted = live.join(a, "src").join(b, "dst").select(F.col("a").alias("src"), F.col("b").alias("dst"))
        live, seen = materialise_observed(cleaned(contracted), n=F.count(F.lit(1)))
