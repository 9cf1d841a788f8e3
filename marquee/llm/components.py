"""Connected components of a link table by joins (no link, component or label reaches the driver)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.scratch import written


def components(links: DataFrame) -> DataFrame:
    """(node, comp) of every node of the links (a, b); ``comp`` is the smallest node of its component.

    Each round takes the smallest label among neighbours (an aggregate with
    partial sums, so a node with very many links is no hot key) and then the
    label of that label (pointer jumping), so chains shorten by powers. A round
    is written to the shared folder; it ends when no label changed.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = written(both, "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("beyond"))
        labels = written(step.join(jump, "next", "left").select(
            "node", "was", F.least("next", F.coalesce("beyond", "next")).alias("comp")), "labels")
        if labels.where("was <> comp").limit(1).count() == 0:
            return labels.select("node", "comp")
