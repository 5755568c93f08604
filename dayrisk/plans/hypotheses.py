"""The three hypothesis tests of the study, on training rows only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from dayrisk.constants import ENVIRONMENTAL, REGIME_DRIVERS, SEED
from dayrisk.functions.cleaning import complete_cases
from dayrisk.operators.clusters import assign
from dayrisk.operators.columns import one_hot
from dayrisk.operators.daily import dominant_phase, to_daily
from dayrisk.operators.linear import fit_logit
from dayrisk.operators.many_means import many_means
from dayrisk.operators.metrics import log_loss, null_log_loss
from dayrisk.operators.significance import chi_square_independence, likelihood_ratio
from dayrisk.operators.windows import BLOCK, hourly_features
from dayrisk.session import settled, side_by_side


def next_day_odds(
    hourly: DataFrame, labels: DataFrame, drivers: Sequence[str] = ("Bz_gsm", "flow_speed"), label: str = "any_environmental"
) -> DataFrame:
    """Do daily mean drivers shift the odds of the next row's label?

    Incomplete days are dropped before the label moves up, so the next row may be some days later.
    One row: coefficient per driver, likelihood ratio against the base rate, its p-value.
    """
    daily = to_daily(hourly, {d: F.avg(d) for d in drivers}, fill=False)
    rows = complete_cases(labels.select("date", label).join(daily, "date"), [label, *drivers])
    ahead = F.lead(F.col(label).cast("int")).over(Window.orderBy("date"))  # one row per calendar day
    rows = rows.withColumn("y", ahead).where("y IS NOT NULL").persist()
    try:
        fit = fit_logit(rows, list(drivers))
        loss = rows.agg(
            F.count(F.lit(1)).alias("n"), log_loss(F.col("y"), fit.probability()).alias("full"), null_log_loss(F.col("y")).alias("null")
        ).first()
    finally:
        rows.unpersist()
    statistic, p = likelihood_ratio(loss["n"], loss["null"], loss["full"], len(drivers))
    schema = ", ".join([*[f"coef_{d} double" for d in drivers], "n bigint", "statistic double", "p_value double"])
    return hourly.sparkSession.createDataFrame([(*fit.weights, loss["n"], statistic, p)], schema)


def events_with_phase(events: DataFrame, hourly: DataFrame, block_days: int = 366) -> DataFrame:
    """Events of the environmental classes with the dominant storm phase of their day; no phase, no row."""
    rows = hourly_features(hourly, (), (), (), block_days=block_days)
    flags = ("phase_quiet", "phase_main", "phase_recovery")
    phases = to_daily(rows, {p: F.max(p) for p in flags}, also_by=[BLOCK], fill=False).select(
        F.col("date").alias("anomaly_date"), dominant_phase(*[F.col(p) for p in flags]).alias("phase")
    )
    kept = events.where(F.col("ADIAG").isin(*ENVIRONMENTAL))
    return kept.join(phases, "anomaly_date", "left").where(F.col("phase").isNotNull())


def phase_by_class(events: DataFrame, hourly: DataFrame, block_days: int = 366) -> DataFrame:
    """Are diagnosis and storm phase independent? One row ``(chi2, dof, p_value)``."""
    return chi_square_independence(events_with_phase(events, hourly, block_days), "ADIAG", "phase")


def regimes_beyond_index(
    hourly: DataFrame,
    labels: DataFrame,
    drivers: Sequence[str] = REGIME_DRIVERS,
    index: str = "Kp_real",
    ks: Sequence[int] = (3, 4, 5, 6),
    starts: int = 20,
    label: str = "any_environmental",
) -> DataFrame:
    """Do cluster dummies improve a logit on the daily maximum index? One row per number of clusters."""
    drivers = list(drivers)
    statistics = {d: F.avg(d) for d in drivers} | {"index_max": F.max(index)}
    daily = settled(complete_cases(to_daily(hourly, statistics, fill=False), drivers))
    moments = daily.agg(*[F.struct(F.avg(d), F.stddev_pop(d)).alias(d) for d in drivers]).first()
    scaled = settled(daily.select(
        "date", "index_max", *[((F.col(d) - F.lit(moments[d][0])) / F.lit(moments[d][1] or 1.0)).alias(d) for d in drivers]
    ))
    rows = scaled
    for k, model in zip(ks, many_means(scaled, drivers, ks, starts, SEED)):
        rows = assign(rows, model, drivers, f"regime_of_{k}")
    rows = rows.join(labels.select("date", F.col(label).cast("int").alias("y")), "date")
    rows = rows.where(F.col("index_max").isNotNull() & F.col("y").isNotNull())
    dummies = [d for k in ks for d in one_hot(F.col(f"regime_of_{k}"), range(k), f"regime_{k}_")]
    rows = settled(rows.select("y", "index_max", *dummies))
    models = [["index_max"], *[["index_max", *[f"regime_{k}_{i}" for i in range(1, k)]] for k in ks]]
    fits = side_by_side(lambda features: fit_logit(rows, features), models)
    n, small, *large = rows.agg(F.count(F.lit(1)), *[log_loss(F.col("y"), fit.probability()) for fit in fits]).first()
    out = [(k, *likelihood_ratio(n, small, loss, k - 1)) for k, loss in zip(ks, large)]
    return hourly.sparkSession.createDataFrame(
        [(k, statistic, k - 1, p) for k, statistic, p in out], "k int, statistic double, dof int, p_value double"
    )
