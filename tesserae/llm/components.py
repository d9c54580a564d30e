"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import durable


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest reachable id) for every end of the links ``a``, ``b``.

    In every round the ends of a link and their components take the smaller component of the two, and every node the
    component of its component, until nothing changes; rounds grow with the logarithm of a component's diameter.  Each
    round is written to the checkpoint folder.
    """
    edges = durable(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).union(edges.select("b", "a"))
    labels = durable(ends.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("component")))
    while True:
        at = lambda end: labels.select(F.col("node").alias(end), F.col("component").alias(f"c{end}"))  # noqa: B023, E731
        met = edges.join(at("a"), "a").join(at("b"), "b").where("ca <> cb")
        told = met.select(F.explode(F.array("a", "b", "ca", "cb")).alias("node"), F.least("ca", "cb").alias("component"))
        up = labels.join(labels.select(F.col("node").alias("component"), F.col("component").alias("above")), "component").where("above < component").select("node", F.col("above").alias("component"))
        own = labels.select("node", "component", F.col("component").alias("old"))
        no = F.lit(None).cast("long").alias("old")
        every = own.union(told.select("node", "component", no)).union(up.select("node", "component", no))
        new = every.groupBy("node").agg(F.min("component").alias("component"), F.max("old").alias("old"))
        new = durable(new.select("node", "component", (F.col("component") < F.col("old")).alias("changed")))
        labels = new.select("node", "component")
        if new.where("changed").isEmpty():
            return labels
