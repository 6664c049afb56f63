"""Connected components of a link table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitaelake.llm.native import staged


def connected_components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """node, component for the ends of ``links`` (a, b); component is its smallest node.

    Each round gives every node the smallest label among its neighbours' labels, then follows
    labels to their own labels. Minima are combined before each shuffle and every join has one
    row per node on one side, so a node with very many links is no burden to one task. Each round
    is written to the shared folder, so a lost executor repeats one round at most.
    """
    both = staged(
        spark,
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = staged(
        spark,
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")),
        "labels",
    )
    while True:
        own = labels.select(F.col("node").alias("b"), F.col("component").alias("offered"))
        best = both.join(own, "b").groupBy(F.col("a").alias("node")).agg(F.min("offered").alias("offered"))
        lower = labels.join(best, "node").select(
            "node", "component", F.least("component", "offered").alias("next")
        )
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("further"))
        after = staged(
            spark,
            lower.join(jump, "next", "left").select(
                "node",
                F.least("next", "further").alias("component"),
                (F.least("next", "further") != F.col("component")).alias("moved"),
            ),
            "labels",
        )
        labels = after.select("node", "component")
        if after.where("moved").isEmpty():
            return labels
