"""The two forecasts any model has to beat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def persistence(days: DataFrame, labels: DataFrame, label: str, keys: Sequence[str] = ()) -> DataFrame:
    """Forecast for the day after ``date``: the label of ``date`` itself; 0 where it has none."""
    known = labels.select(*keys, "date", F.col(label).cast("int").alias("_known"))
    return days.join(known, [*keys, "date"], "left").select(
        *days.columns, F.coalesce("_known", F.lit(0)).alias("predicted")
    )


def climatology(days: DataFrame, train: DataFrame, label: str) -> DataFrame:
    """The positive rate of the training rows as a constant probability."""
    rate = train.agg(F.avg(F.col(label).cast("double")).alias("rate")).first()["rate"]
    if rate is None:
        raise ValueError("no training rows")
    return days.withColumn("p", F.lit(float(rate)))
