"""Connected components by the smallest label around and shortcuts over labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapgraph.operators.skew import skew_join
from lapgraph.session import ensure_checkpoint_dir


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each end of a link (src, dst) can reach.

    In a round every vertex takes the smallest label of its neighbours and then the label of
    that label, so a chain shortens by half; minima combine in the map tasks. Labels are
    written to the checkpoint folder each round.
    """
    ensure_checkpoint_dir(links.sparkSession)
    both = links.select("src", "dst").union(links.select("dst", "src")).filter("src <> dst").distinct().checkpoint()
    labels = both.groupBy(F.col("src").alias("id")).agg(F.min(F.least("src", "dst")).alias("component")).checkpoint()
    while True:
        near = skew_join(both, labels.withColumnsRenamed({"id": "dst", "component": "_near"}), ["dst"])
        least = near.groupBy(F.col("src").alias("id")).agg(F.min("_near").alias("_near"))
        lower = labels.join(least, "id").select("id", F.least("component", "_near").alias("component"), F.col("component").alias("_old"))
        lower = lower.checkpoint()
        jump = lower.select(F.col("id").alias("component"), F.col("component").alias("_next"))
        moved = skew_join(lower, jump, ["component"], "left").select(
            "id", F.least("component", F.coalesce("_next", "component")).alias("component"), "_old"
        ).checkpoint()
        labels = moved.drop("_old")
        if moved.filter("component <> _old").isEmpty():
            return labels
