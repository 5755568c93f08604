"""Metrics of runs as an append-only table ``(run_id, model, fold, metric, value)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def long_metrics(scores: DataFrame, run_id: str, fold: str, metrics: Sequence[str], model: str = "model") -> DataFrame:
    """One row per model and metric; undefined metrics are left out."""
    entries = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return (
        scores.select(F.lit(run_id).alias("run_id"), F.col(model).alias("model"), F.lit(fold).alias("fold"), F.explode(entries).alias("e"))
        .select("run_id", "model", "fold", "e.metric", "e.value")
        .where(F.col("value").isNotNull())
    )


def append_metrics(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("run_id").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
