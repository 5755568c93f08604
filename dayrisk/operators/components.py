"""Connected components of a graph whose nodes have few neighbours each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dayrisk.session import ensure_checkpoint_dir

SALTS = 16


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, label)`` with the smallest node of its component as label.

    ``edges(a, b)`` holds every edge once. In each round a node and the node its label names both take
    the smallest label seen among the node's neighbours, then labels are followed once. Whole regions
    merge at a time, so long chains close in logarithmically many rounds. Many nodes share one
    label: proposals to it are combined before the shuffle, and the join that follows it is salted.
    In the first round every node names itself, so the edges alone tell its neighbours' labels.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    turned = F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = edges.select(F.explode(F.array(F.struct("a", "b"), turned)).alias("_edge")).select("_edge.*").checkpoint()
    nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    named = nodes.join(nearest, "node", "left").select("node", F.least("node", F.coalesce("near", "node")).alias("new")).checkpoint()
    labels = followed(named).select("node", F.col("new").alias("label")).checkpoint()
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        told = F.explode(F.array("node", "label")).alias("node")
        proposals = labels.join(near, "node").select(told, "near").groupBy("node").agg(F.min("near").alias("near"))
        hooked = labels.join(proposals, "node", "left").select(
            "node", "label", F.least("label", F.coalesce("near", "label")).alias("new")
        ).checkpoint()
        if hooked.where(F.col("new") != F.col("label")).isEmpty():
            return labels
        labels = followed(hooked).select("node", F.col("new").alias("label")).checkpoint()


def followed(state: DataFrame) -> DataFrame:
    """Replace each new label by the new label of the node it names."""
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    named = state.select(F.col("new").alias("node")).distinct()
    # a node that names itself leads nowhere further
    moved = state.where(F.col("new") != F.col("node")).join(named, "node", "left_semi")
    jump = moved.select(
        F.col("node").alias("new"), F.col("new").alias("further"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    )
    return (
        state.withColumn("_salt", salt)
        .join(jump, ["new", "_salt"], "left")
        .select("node", F.least("new", F.coalesce("further", "new")).alias("new"))
    )
