"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """node, comp (the smallest node it reaches) for links a, b (bigint).

    Each round a node takes the least label among its own and its neighbours', then
    the label of that label, so chains shrink by doubling. Empty links give no rows.
    """
    both = cut(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "links")
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        new = labels.join(near, labels["node"] == near["a"]).select("node", "comp", F.least("comp", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("far"))
        new = cut(new.join(jump, "next").select("node", F.col("comp").alias("was"), "far"), "labels")
        labels = new.select("node", F.col("far").alias("comp"))
        if new.where("far <> was").isEmpty():
            return labels
