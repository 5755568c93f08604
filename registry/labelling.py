"""Daily label panels, calendars and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayrisk.constants import DIAGNOSES
from dayrisk.operators.daily import binned_rate, fill_calendar
from dayrisk.operators.folds import expanding_folds, holdout_cut, stratified_folds
from dayrisk.operators.labels import class_pivot, daily_event_counts, fold_column, fold_summary, next_label
from registry.core import query
from registry.inputs import (
    CATALOGUE_SQL, DAILY_COUNTS, FOLD_SQL, LONG_CUTS, LONG_SQL, RARE_SQL, events_catalogue, labels_sql, long_drivers,
    rare_labels, rounded, rounded_sql, table,
)

_PANEL = " ".join([*DAILY_COUNTS, "any_anomaly", "any_environmental"])


@query("daily_event_counts", rounded_sql("FROM labels_daily", ints=_PANEL, texts="date", ctes=f"{CATALOGUE_SQL}, {labels_sql()}"))
def event_counts(spark, folder):
    return rounded(daily_event_counts(events_catalogue(spark, folder)))


@query(
    "daily_event_counts_all_classes",
    rounded_sql("FROM labels_daily", ints=_PANEL, texts="date", ctes=f"{CATALOGUE_SQL}, {labels_sql(counted='true')}"),
)
def event_counts_all(spark, folder):
    return rounded(daily_event_counts(events_catalogue(spark, folder), only_environmental=False))


@query(
    "daily_class_pivot",
    f"WITH {CATALOGUE_SQL} SELECT CAST(anomaly_date AS VARCHAR) AS date, "
    + ", ".join(f"count(*) FILTER (WHERE ADIAG = '{c}' AND BIRD IS NOT NULL) AS n_{c.lower()}" for c in DIAGNOSES)
    + f", count(*) FILTER (WHERE ADIAG NOT IN ({', '.join(repr(c) for c in DIAGNOSES)}) AND BIRD IS NOT NULL) AS n_other"
    + " FROM catalogue WHERE ADIAG IS NOT NULL GROUP BY 1",
)
def pivot(spark, folder):
    return rounded(class_pivot(events_catalogue(spark, folder)))


@query(
    "calendar_fill",
    """WITH seen AS (SELECT user_id, CAST(ts AS DATE) AS date, count(*) AS n FROM events GROUP BY 1, 2),
      days AS (SELECT user_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM seen GROUP BY user_id)
    SELECT user_id, CAST(date AS VARCHAR) AS date, coalesce(n, 0) AS n FROM days LEFT JOIN seen USING (user_id, date)""",
)
def calendar(spark, folder):
    daily = table(spark, folder, "events").groupBy("user_id", F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(fill_calendar(daily, ["user_id"], fills={"n": 0}))


@query("fold_split", f"WITH {RARE_SQL} SELECT CAST(date AS VARCHAR) AS date, {FOLD_SQL} AS fold FROM rare")
def fold_split(spark, folder):
    return rounded(rare_labels(spark, folder).select("date", fold_column(F.col("date"), LONG_CUTS).alias("fold")))


@query(
    "fold_summary",
    f"""WITH {RARE_SQL}, folded AS (SELECT *, {FOLD_SQL} AS fold FROM rare)
    SELECT fold, CAST(min(date) AS VARCHAR) AS start, CAST(max(date) AS VARCHAR) AS "end", count(*) AS days,
      round(100 * avg(CAST(any_environmental AS DOUBLE)), 8) + 0.0 AS pos_rate_pct FROM folded WHERE fold IS NOT NULL GROUP BY 1""",
)
def summary(spark, folder):
    labels = rare_labels(spark, folder).withColumn("fold", fold_column(F.col("date"), LONG_CUTS))
    return rounded(fold_summary(labels, "any_environmental"))


_BINS = ((-0.1, 4.7, "low"), (4.7, 5.0, "middle"), (5.0, 5.3, "high"), (5.3, 9.0, "top"))


@query(
    "binned_base_rate",
    f"""WITH {LONG_SQL}, {RARE_SQL}, joined AS (
      SELECT Kp_real AS v, CAST(any_environmental AS DOUBLE) AS y FROM rare JOIN long_drivers ON CAST(ts AS DATE) = date),
    binned AS (SELECT CASE WHEN v > -0.1 AND v <= 4.7 THEN 'low' WHEN v > 4.7 AND v <= 5.0 THEN 'middle'
      WHEN v > 5.0 AND v <= 5.3 THEN 'high' WHEN v > 5.3 AND v <= 9.0 THEN 'top' END AS bin, y FROM joined)
    SELECT bin, round(avg(y), 8) + 0.0 AS mean, count(*) AS size FROM binned WHERE bin IS NOT NULL GROUP BY 1""",
)
def base_rate(spark, folder):
    daily = long_drivers(spark, folder).select(F.to_date("ts").alias("date"), "Kp_real")
    joined = rare_labels(spark, folder).join(daily, "date")
    return rounded(binned_rate(joined, "Kp_real", "any_environmental", _BINS))


@query(
    "next_day_label",
    f"""WITH {RARE_SQL} SELECT CAST(date AS VARCHAR) AS date,
      CAST(CAST(lead(any_environmental, 1) OVER (ORDER BY date) AS INTEGER) AS DOUBLE) AS target FROM rare""",
)
def next_day(spark, folder):
    ahead = next_label(rare_labels(spark, folder), "any_environmental")
    return rounded(ahead.withColumn("target", F.col("target").cast("double")))


@query(
    "persistence",
    f"""WITH {LONG_SQL}, {RARE_SQL} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date,
      CAST(coalesce(any_environmental, false) AS BIGINT) AS predicted
    FROM long_drivers LEFT JOIN rare ON CAST(ts AS DATE) = date""",
)
def persistence_forecast(spark, folder):
    from dayrisk.plans.baselines import persistence

    days = long_drivers(spark, folder).select(F.to_date("ts").alias("date"))
    return rounded(persistence(days, rare_labels(spark, folder), "any_environmental"))


@query(
    "climatology",
    f"""WITH {RARE_SQL}, folded AS (SELECT *, {FOLD_SQL} AS fold FROM rare)
    SELECT CAST(date AS VARCHAR) AS date, round((SELECT avg(CAST(any_environmental AS DOUBLE)) FROM folded WHERE fold = 'train'), 8) + 0.0 AS p
    FROM folded WHERE fold = 'test'""",
)
def climatology_forecast(spark, folder):
    from dayrisk.plans.baselines import climatology

    labels = rare_labels(spark, folder).withColumn("fold", fold_column(F.col("date"), LONG_CUTS))
    scored = climatology(labels.where("fold = 'test'"), labels.where("fold = 'train'"), "any_environmental")
    return rounded(scored.select("date", "p"))


@query(
    "holdout_cut",
    f"""WITH {RARE_SQL} SELECT CAST(date AS VARCHAR) AS date,
      CASE WHEN row_number() OVER (ORDER BY date) <= floor(0.8 * count(*) OVER ()) THEN 'fit' ELSE 'calibrate' END AS part FROM rare""",
)
def cut(spark, folder):
    return rounded(holdout_cut(rare_labels(spark, folder).select("date")))


@query(
    "time_series_folds",
    f"""WITH {RARE_SQL}, placed AS (SELECT date, row_number() OVER (ORDER BY date) AS rn, count(*) OVER () AS n FROM rare)
    SELECT CAST(date AS VARCHAR) AS date, CAST(CASE WHEN rn <= n - 5 * (n // 6) THEN 0
      ELSE (rn - 1 - (n - 5 * (n // 6))) // (n // 6) + 1 END AS BIGINT) AS test_fold FROM placed""",
)
def series_folds(spark, folder):
    return rounded(expanding_folds(rare_labels(spark, folder).select("date")))


@query(
    "stratified_folds",
    f"""WITH {RARE_SQL}, placed AS (SELECT date, any_environmental AS y,
        row_number() OVER (PARTITION BY any_environmental ORDER BY date) AS rn FROM rare),
      class AS (SELECT y, max(rn) AS n, min(date) AS first FROM placed GROUP BY y),
      dealt AS (SELECT y, n, coalesce(sum(n) OVER (ORDER BY first ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM class),
      quota AS (SELECT y, k, (SELECT count(*) FROM generate_series(CAST(start AS BIGINT), CAST(start + n - 1 AS BIGINT)) AS g(j) WHERE j % 5 <= k) AS upto
        FROM dealt, generate_series(0, 4) AS f(k))
    SELECT CAST(p.date AS VARCHAR) AS date, CAST(p.y AS BIGINT) AS y,
      CAST((SELECT count(*) FROM quota q WHERE q.y = p.y AND q.upto < p.rn) AS BIGINT) AS cv_fold FROM placed p""",
)
def class_folds(spark, folder):
    labels = rare_labels(spark, folder).select("date", F.col("any_environmental").cast("int").alias("y"))
    return rounded(stratified_folds(labels, "y"))
