"""Streams replayed from the given tables: increments arrive in a folder, a run takes what is new, state goes on from run to run."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayrisk.session import ensure_checkpoint_dir, settled
from dayrisk.streaming.daily import stream_daily
from dayrisk.streaming.features import stream_features
from registry.core import query
from registry.features import PHASE_NAMES, TEXT_TS, lag_roll_names, lag_roll_sql, phase_sql
from registry.inputs import HOURLY_DRIVERS, HOURLY_SQL, SERIES_SQL, hourly_drivers, rounded, rounded_sql

INCREMENTS = 3


def replayed(spark: SparkSession, hourly: DataFrame, made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``made`` gives out while the hours arrive in INCREMENTS stretches of time, each followed by a run that takes all there is."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    rows = settled(hourly)
    first, last = rows.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    number = F.least(F.floor((F.unix_seconds("ts") - F.lit(first)) * INCREMENTS / F.lit(max(1, (last or 0) - (first or 0)))), F.lit(INCREMENTS - 1))
    source = spark.readStream.schema(rows.schema)
    for k in range(INCREMENTS):
        rows.where(number == k).write.mode("append").parquet(f"{folder}/in")
        out = made(source.parquet(f"{folder}/in"))
        run = out.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        run.awaitTermination()
        if run.exception():
            raise run.exception()
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


_PART = "PARTITION BY user_id"


@query(
    "stream_features",
    rounded_sql(f"""FROM (SELECT user_id, ts, {', '.join(lag_roll_sql(['Bz_gsm', 'Dst'], _PART))}, {', '.join(phase_sql(_PART))} FROM hourly)
      WHERE ts <= (SELECT max(ts) FROM hourly) - INTERVAL 2 HOURS""",
                " ".join(lag_roll_names(["Bz_gsm", "Dst"])), f"user_id {PHASE_NAMES}", "ts", ctes=SERIES_SQL).replace(*TEXT_TS),
)
def features_of_a_stream(spark, folder):
    """Lags, rolling statistics and phase of every user's hours, from state; hours that the watermark has not passed are still open."""
    hourly = hourly_drivers(spark, folder, ["user_id"])
    return rounded(replayed(spark, hourly, lambda s: stream_features(s, ["Bz_gsm", "Dst"], keys=["user_id"])))


@query(
    "stream_daily",
    rounded_sql(f"""FROM (SELECT CAST(ts AS DATE) AS date, {', '.join(f'avg({d}) AS {d}' for d in HOURLY_DRIVERS)}, count(*) AS hours FROM hourly GROUP BY 1)
      WHERE date + INTERVAL 1 DAY <= (SELECT max(ts) FROM hourly) - INTERVAL 2 HOURS""", " ".join(HOURLY_DRIVERS), "hours", "date", ctes=HOURLY_SQL),
)
def days_of_a_stream(spark, folder):
    """The daily collapse of a stream: days that are closed."""
    statistics = {d: F.avg(d) for d in HOURLY_DRIVERS} | {"hours": F.count(F.lit(1))}
    return rounded(replayed(spark, hourly_drivers(spark, folder), lambda s: stream_daily(s, statistics)))
