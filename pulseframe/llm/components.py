"""Connected components of links between nodes, by the smallest node each can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulseframe.session import scratch_path


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b): the smallest node of its component.

    Each round takes the smallest label among a node's neighbours, then the label of that label,
    so chains shorten by half. Rounds are written to the shared folder, which cuts the lineage.
    Null ends and loops link nothing; repeated links count once.
    """
    spark = links.sparkSession
    pairs = links.filter("a is not null and b is not null and a <> b")
    both = pairs.select("a", "b").union(pairs.select("b", "a")).distinct()
    edges_path = scratch_path(spark, "edges")
    both.write.parquet(edges_path)
    edges = spark.read.parquet(edges_path)
    found = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
    labels = found.select("node", F.least("node", "low").alias("label"))
    changed = True
    while changed:
        path = scratch_path(spark, "labels")
        labels.write.parquet(path)
        now = spark.read.parquet(path)
        near = edges.join(now.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
        near = near.agg(F.min("label").alias("low"))
        step = now.join(near, "node").select("node", "label", F.least("label", "low").alias("next"))
        far = now.select(F.col("node").alias("next"), F.col("label").alias("far"))
        step = step.join(far, "next").select("node", "label", F.least("next", "far").alias("next"))
        path = scratch_path(spark, "labels")
        step.write.parquet(path)
        step = spark.read.parquet(path)
        changed = step.filter("label <> next").limit(1).count() > 0
        labels = step.select("node", F.col("next").alias("label"))
    return labels
