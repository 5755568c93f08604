"""The daily collapse and the decision on a stream of hourly records.

Row-based lags need complete days, so they stay with the batch panel: ``score_closed_days`` runs it on
the days each micro-batch has closed.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_daily(
    hourly: DataFrame, statistics: Mapping[str, Column], ts: str = "ts", late: str = "2 hours", keys=()
) -> DataFrame:
    """One row per series and day, emitted once no more hours of the day can arrive."""
    clocked = hourly.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    daily = clocked.groupBy(*keys, F.window(ts, "1 day").alias("_day")).agg(*[c.alias(n) for n, c in statistics.items()])
    return daily.select(*keys, F.to_date("_day.start").alias("date"), *statistics)


def score_closed_days(
    daily: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Score the closed days of each micro-batch and append them to a table.

    ``score`` gets the ``date`` rows of the batch and returns their scores (``score_dates`` with a
    loaded bundle, for instance). A batch that is run again replaces its own files only.
    """

    def write(batch: DataFrame, number: int) -> None:
        score(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return daily.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
