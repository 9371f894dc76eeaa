"""Connected components of an undirected graph by smallest label, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from staylens.session import scratch_path


def stored(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.parquet(path)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label is the smallest node it reaches.

    Each round takes the smallest label around a node, then the label of that
    label, so paths halve; rounds end when no label changes.
    """
    both = stored(spark, edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = stored(spark, both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        other = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        around = both.join(other, "b").groupBy("a").agg(F.min("near").alias("near"))
        step = labels.join(around, F.col("node") == F.col("a")).select("node", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("far"))
        labels = stored(spark, step.join(jump, "low").select("node", F.least("low", "far").alias("label"), (F.least("low", "far") < F.col("label")).alias("moved")), "labels")
        if labels.where("moved").isEmpty():
            return labels.select("node", "label")
