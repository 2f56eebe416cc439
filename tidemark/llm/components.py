"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import workspace


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each end of the edges (a, b): label is the smallest node of its component.

    Each round gives every node the smallest label among itself and its neighbours, then follows
    labels to their own labels. Rounds are written to the shared folder, which cuts the lineage.
    """
    spark = edges.sparkSession
    root = workspace(spark, "components")
    both = edges.filter("a <> b").select("a", "b").union(edges.filter("a <> b").select(F.col("b"), F.col("a")))
    both.distinct().write.parquet(f"{root}/edges")
    links = spark.read.parquet(f"{root}/edges")
    links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")).write.parquet(
        f"{root}/labels0"
    )
    step = 0
    while True:
        labels = spark.read.parquet(f"{root}/labels{step}")
        near = (
            links.join(labels.select(F.col("node").alias("b"), F.col("label").alias("theirs")), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        )
        lowered = labels.join(near, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "theirs").alias("label")
        )
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        step += 1
        lowered.join(jump, "label", "left").select(
            "node", F.least("label", F.coalesce("further", "label")).alias("label"), "was"
        ).write.parquet(f"{root}/labels{step}")
        done = spark.read.parquet(f"{root}/labels{step}")
        if done.filter("label <> was").limit(1).count() == 0:
            return done.select("node", "label")
