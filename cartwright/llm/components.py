"""Connected components as joins and grouped minima over stored tables.

Every node carries a label, at first the smallest node it touches. A round takes the
smallest label among the neighbours, hands it to the node that the old label names,
and then follows labels once (so chains shrink by half). Rounds stop when no edge joins
two labels. Tables are written between the steps, so both sides of each join come
straight from a scan and a shuffle and Spark can split a hub.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, store


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every end of an edge (a, b); component is its smallest node.

    Null ends are ignored; repeated edges and loops do no harm.
    """
    known = edges.select("a", "b").where("a is not null and b is not null")
    both = known.union(known.select("b", "a")).distinct()
    links = store(both.toDF("node", "other"), "links")
    labels = store(
        links.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels"
    )
    while True:
        seen = (
            links.join(labels.select(F.col("node").alias("other"), "label"), "other")
            .select("node", "label", F.lit(None).cast("long").alias("old"))
            .union(labels.select("node", "label", F.col("label").alias("old")))
            .groupBy("node")
            .agg(F.min("label").alias("label"), F.max("old").alias("old"))
        )
        seen = store(seen, "seen")
        if seen.where("label < old").isEmpty():
            discard(links)
            discard(seen)
            return labels.withColumnRenamed("label", "component")
        hooked = store(
            seen.select("node", "label")
            .union(seen.where("label < old").select("old", "label"))
            .groupBy("node")
            .agg(F.min("label").alias("label")),
            "hooked",
        )
        after = hooked.select(F.col("node").alias("label"), F.col("label").alias("further"))
        discard(labels)
        labels = store(
            hooked.join(after, "label").select("node", F.col("further").alias("label")), "labels"
        )
        discard(seen)
        discard(hooked)
