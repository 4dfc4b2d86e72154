"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """node, label (least node of its component) for each end of the links (a, b); both are longs.

    Every round takes the least label among the neighbours and then the label's own label, until nothing changes, so
    the number of rounds grows with the logarithm of the longest path. Each round is a written table. Neighbours
    are met by joins and counted by aggregates, which split or combine a node with very many links.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .filter("a <> b").distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                    .select("node", F.least("node", "least").alias("label")), "labels")
    while True:
        around = (both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("of"))
                  .agg(F.min("label").alias("least")))
        lower = (labels.join(around, F.col("node") == F.col("of"))
                 .select("node", "label", F.least("label", "least").alias("next")))
        lower = stored(lower, "labels-near")
        up = lower.select(F.col("node").alias("top"), F.col("next").alias("above"))
        moved = stored(lower.join(up, F.col("next") == F.col("top"))
                       .select("node", "label", F.least("next", "above").alias("next")), "labels-up")
        still = moved.filter("label <> next").isEmpty()
        labels = moved.select("node", F.col("next").alias("label"))
        if still:
            return labels
