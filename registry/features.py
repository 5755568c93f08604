"""Hourly and daily features, imputation and scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayrisk.constants import ROLL_HOURS
from dayrisk.functions.scalars import season_columns, storm_phase
from dayrisk.operators.columns import interactions, one_hot
from dayrisk.operators.daily import dominant_phase, to_daily
from dayrisk.operators.labels import fold_column
from dayrisk.operators.windows import BLOCK, hourly_features
from dayrisk.plans.panel import (
    FeaturePanel, PanelConfig, align_target, coupling_features, daily_features, feature_groups, feature_names, fit_panel,
)
from registry.core import query
from registry.inputs import (
    FOLD_SQL, HOURLY_DRIVERS, HOURLY_SQL, LONG_CUTS, LONG_DRIVERS, LONG_SQL, RARE_SQL, SERIES_SQL, hourly_drivers,
    long_drivers, rare_labels, rounded, rounded_sql, table,
)

TEXT_TS = ("CAST(ts AS VARCHAR)", "strftime(ts, '%Y-%m-%d %H:%M:%S')")


def _lag(c, k, part=""):
    return f"lag({c}, {k}) OVER ({part} ORDER BY ts)"


def _roll(c, w, part=""):
    frame = f"OVER ({part} ORDER BY ts ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    least = max(2, w // 2)
    return [
        f"CASE WHEN count({c}) {frame} >= {least} THEN {fn}({c}) {frame} END AS {c}_{name}{w}h"
        for fn, name in (("avg", "rmean"), ("stddev_samp", "rstd"))
    ]


def lag_roll_sql(drivers, part="", lags=(1, 3, 6, 24), rolls=ROLL_HOURS):
    out = []
    for d in drivers:
        out += [f"{_lag(d, k, part)} AS {d}_lag{k}h" for k in lags]
        for w in rolls:
            out += _roll(d, w, part)
    return out


def lag_roll_names(drivers, lags=(1, 3, 6, 24), rolls=ROLL_HOURS):
    out = []
    for d in drivers:
        out += [f"{d}_lag{k}h" for k in lags]
        out += [f"{d}_{s}{w}h" for w in rolls for s in ("rmean", "rstd")]
    return out


def phase_sql(part=""):
    change = f"(Dst - {_lag('Dst', 1, part)})"
    return [
        f"CAST(NOT coalesce(Dst <= -30 AND {change} IS NOT NULL, false) AS INTEGER) AS phase_quiet",
        f"CAST(coalesce(Dst <= -30 AND {change} < 0, false) AS INTEGER) AS phase_main",
        f"CAST(coalesce(Dst <= -30 AND {change} >= 0, false) AS INTEGER) AS phase_recovery",
    ]


PHASE_NAMES = "phase_quiet phase_main phase_recovery"

# A week-long block makes even a month of hours cross block borders.
BLOCK_DAYS = 7


@query(
    "lag_features",
    rounded_sql(f"FROM (SELECT ts, {', '.join(lag_roll_sql(HOURLY_DRIVERS, rolls=()))} FROM hourly)",
                " ".join(lag_roll_names(HOURLY_DRIVERS, rolls=())), texts="ts", ctes=HOURLY_SQL).replace(*TEXT_TS),
)
def lags(spark, folder):
    rows = hourly_features(hourly_drivers(spark, folder), HOURLY_DRIVERS, rolls=(), storm_driver=None, block_days=BLOCK_DAYS)
    return rounded(rows.drop(BLOCK))


def _rolling(spark, folder, infix):
    rows = hourly_features(hourly_drivers(spark, folder), HOURLY_DRIVERS, lags=(), storm_driver=None, block_days=BLOCK_DAYS)
    return rounded(rows.select("ts", *[c for c in rows.columns if infix in c]))


for _name, _infix in (("rolling_mean", "_rmean"), ("rolling_std", "_rstd")):
    _names = [n for n in lag_roll_names(HOURLY_DRIVERS) if _infix in n]
    query(
        _name,
        rounded_sql(f"FROM (SELECT ts, {', '.join(lag_roll_sql(HOURLY_DRIVERS, lags=()))} FROM hourly)",
                    " ".join(_names), texts="ts", ctes=HOURLY_SQL).replace(*TEXT_TS),
    )(lambda spark, folder, infix=_infix: _rolling(spark, folder, infix))


@query(
    "lag_roll_by_series",
    rounded_sql(f"FROM (SELECT user_id, ts, {', '.join(lag_roll_sql(['Bz_gsm', 'Dst'], 'PARTITION BY user_id'))} FROM hourly)",
                " ".join(lag_roll_names(["Bz_gsm", "Dst"])), "user_id", "ts", ctes=SERIES_SQL).replace(*TEXT_TS),
)
def lag_roll_series(spark, folder):
    rows = hourly_features(
        hourly_drivers(spark, folder, ["user_id"]), ["Bz_gsm", "Dst"], keys=["user_id"], storm_driver=None, block_days=BLOCK_DAYS
    )
    return rounded(rows.drop(BLOCK))


@query(
    "lag_roll_by_time",
    rounded_sql(
        """FROM (SELECT user_id, ts, first(Bz_gsm) OVER (w RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND INTERVAL 6 HOURS PRECEDING) AS Bz_gsm_lag6h,
          CASE WHEN count(Bz_gsm) OVER (w RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND INTERVAL 1 SECOND PRECEDING) >= 12
            THEN avg(Bz_gsm) OVER (w RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND INTERVAL 1 SECOND PRECEDING) END AS Bz_gsm_rmean24h
          FROM hourly WINDOW w AS (PARTITION BY user_id ORDER BY ts))""",
        "Bz_gsm_lag6h Bz_gsm_rmean24h", "user_id", "ts", ctes=SERIES_SQL,
    ).replace(*TEXT_TS),
)
def lag_roll_time(spark, folder):
    """Lags by elapsed time instead of rows, for series with gaps."""
    rows = hourly_features(
        hourly_drivers(spark, folder, ["user_id"]), ["Bz_gsm"], (6,), (24,), ["user_id"], storm_driver=None,
        block_days=BLOCK_DAYS, gap_mode="time",
    )
    return rounded(rows.select("user_id", "ts", "Bz_gsm_lag6h", "Bz_gsm_rmean24h"))


@query(
    "storm_phase",
    rounded_sql(f"FROM (SELECT ts, {', '.join(phase_sql())} FROM hourly)", ints=PHASE_NAMES, texts="ts", ctes=HOURLY_SQL).replace(*TEXT_TS),
)
def phases(spark, folder):
    rows = hourly_features(hourly_drivers(spark, folder), (), (), (), block_days=BLOCK_DAYS)
    return rounded(rows.drop(BLOCK))


_DAILY_PHASE = f"""daily_phase AS (SELECT CAST(ts AS DATE) AS date, max(phase_quiet) AS q, max(phase_main) AS m, max(phase_recovery) AS r
  FROM (SELECT ts, {', '.join(phase_sql())} FROM hourly) GROUP BY 1)"""


@query(
    "dominant_phase",
    f"""WITH {HOURLY_SQL}, {_DAILY_PHASE} SELECT CAST(date AS VARCHAR) AS date,
      CASE WHEN q = 1 THEN 'phase_quiet' WHEN m = 1 THEN 'phase_main' WHEN r = 1 THEN 'phase_recovery' END AS phase FROM daily_phase""",
)
def dominant(spark, folder):
    rows = hourly_features(hourly_drivers(spark, folder), (), (), (), block_days=BLOCK_DAYS)
    names = PHASE_NAMES.split()
    daily = to_daily(rows, {p: F.max(p) for p in names}, also_by=[BLOCK])
    return rounded(daily.select("date", dominant_phase(*[F.col(p) for p in names]).alias("phase")))


_CALENDAR = """days AS (SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date FROM hourly)"""


def _daily_sql(columns, names):
    return rounded_sql(
        f"FROM (SELECT * FROM days LEFT JOIN (SELECT CAST(ts AS DATE) AS date, {columns} FROM hourly GROUP BY 1) USING (date))",
        names, texts="date", ctes=f"{HOURLY_SQL}, {_CALENDAR}",
    )


@query(
    "hourly_to_daily",
    _daily_sql(", ".join(f"avg({d}) AS {d}" for d in HOURLY_DRIVERS), " ".join(HOURLY_DRIVERS)),
)
def collapse(spark, folder):
    hourly = hourly_drivers(spark, folder)
    return rounded(to_daily(hourly, {d: F.avg(d) for d in HOURLY_DRIVERS}))


@query(
    "daily_min_max",
    _daily_sql("max(flow_pressure) AS p_max, min(Dst) AS dst_min, avg(Bz_gsm) AS bz_mean", "p_max dst_min bz_mean"),
)
def min_max(spark, folder):
    hourly = hourly_drivers(spark, folder)
    return rounded(to_daily(hourly, {"p_max": F.max("flow_pressure"), "dst_min": F.min("Dst"), "bz_mean": F.avg("Bz_gsm")}))


_EY = "flow_speed * CASE WHEN Bz_gsm IS NOT NULL THEN greatest(-Bz_gsm, 0.0) END * 1e-3"
_COUPLING_SQL = f"""avg({_EY}) AS coupling_Ey_mean, max({_EY}) AS coupling_Ey_max,
  avg(CAST(coalesce(Bz_gsm < 0, false) AS INTEGER)) AS frac_southward,
  max(CASE WHEN dp IS NOT NULL THEN greatest(dp, 0.0) END) AS pdyn_shock"""
_COUPLING_NAMES = "coupling_Ey_mean coupling_Ey_max frac_southward pdyn_shock"


@query(
    "coupling_features",
    _daily_sql(_COUPLING_SQL, _COUPLING_NAMES).replace(
        "FROM hourly GROUP BY 1)", f"FROM (SELECT *, flow_pressure - {_lag('flow_pressure', 1)} AS dp FROM hourly) GROUP BY 1)"),
)
def coupling(spark, folder):
    return rounded(coupling_features(hourly_drivers(spark, folder), block_days=BLOCK_DAYS))


@query(
    "cyclic_doy",
    """SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date,
      round(sin(2 * pi() * extract(doy FROM o_orderdate) / 366.0), 8) + 0.0 AS doy_sin,
      round(cos(2 * pi() * extract(doy FROM o_orderdate) / 366.0), 8) + 0.0 AS doy_cos FROM orders""",
)
def cyclic(spark, folder):
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return rounded(days.select("date", *season_columns(F.col("date"))))


# --- the daily panel over the long table ------------------------------------------------------
PANEL_DRIVERS = LONG_DRIVERS
_FEATURES = lag_roll_names(PANEL_DRIVERS) + PHASE_NAMES.split() + _COUPLING_NAMES.split() + ["doy_sin", "doy_cos"]


def daily_panel_sql(drivers, source, with_coupling=True):
    """CTEs for the unscaled daily panel of one series table called ``source``."""
    means = ", ".join(f"avg({n}) AS {n}" for n in lag_roll_names(drivers))
    phases = ", ".join(f"max({n}) AS {n}" for n in PHASE_NAMES.split())
    coupled = f", {_COUPLING_SQL}" if with_coupling else ""
    return f"""feature_rows AS (SELECT *, {', '.join(lag_roll_sql(drivers))}, {', '.join(phase_sql())},
      flow_pressure - {_lag('flow_pressure', 1)} AS dp FROM {source}),
    panel_seen AS (SELECT CAST(ts AS DATE) AS date, {means}, {phases}{coupled} FROM feature_rows GROUP BY 1),
    panel_days AS (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM panel_seen),
    daily AS (SELECT *, sin(2 * pi() * extract(doy FROM date) / 366.0) AS doy_sin, cos(2 * pi() * extract(doy FROM date) / 366.0) AS doy_cos
      FROM panel_days LEFT JOIN panel_seen USING (date))"""


def aligned_sql(drivers=PANEL_DRIVERS, source="long_drivers", source_sql=LONG_SQL, labels_sql=RARE_SQL, with_coupling=True):
    return f"""{source_sql}, {labels_sql}, {daily_panel_sql(drivers, source, with_coupling)},
    ahead AS (SELECT date, CAST(lead(any_environmental, 1) OVER (ORDER BY date) AS INTEGER) AS target FROM rare),
    aligned AS (SELECT *, {FOLD_SQL} AS fold FROM daily JOIN ahead USING (date) WHERE target IS NOT NULL)"""


CONFIG = PanelConfig(drivers=PANEL_DRIVERS, include_coupling=True, block_days=366)


def long_panel(spark, folder, config=CONFIG):
    """Aligned long panel with its fold."""
    daily = daily_features(long_drivers(spark, folder), config)
    aligned = align_target(daily, rare_labels(spark, folder), config)
    return aligned.withColumn("fold", fold_column(F.col("date"), LONG_CUTS))


@query(
    "daily_panel",
    rounded_sql("FROM daily", " ".join(_FEATURES), texts="date", digits=6, ctes=f"{LONG_SQL}, {daily_panel_sql(PANEL_DRIVERS, 'long_drivers')}"),
)
def panel(spark, folder):
    return rounded(daily_features(long_drivers(spark, folder), CONFIG), 6)


@query(
    "align_panel",
    rounded_sql("FROM aligned WHERE fold = 'val'", " ".join(_FEATURES), "target", "date fold", digits=6, ctes=aligned_sql()),
)
def align(spark, folder):
    rows = long_panel(spark, folder).where("fold = 'val'")
    return rounded(rows.select("date", "fold", "target", *_FEATURES), 6)


_IMPUTED = ", ".join(f"coalesce({f}, (SELECT median({f}) FROM aligned WHERE fold = 'train')) AS {f}" for f in _FEATURES)


@query(
    "median_impute",
    rounded_sql(f"FROM (SELECT date, {_IMPUTED} FROM aligned WHERE fold = 'test')", " ".join(_FEATURES), texts="date", ctes=aligned_sql()),
)
def impute(spark, folder):
    rows = long_panel(spark, folder)
    fitted = fit_panel(rows.where("fold = 'train'"), _FEATURES)
    medians = {f: F.coalesce(F.col(f).cast("double"), F.lit(m)) for f, _, m, _, _ in fitted.params}
    return rounded(rows.where("fold = 'test'").select("date", *[c.alias(f) for f, c in medians.items()]))


@query(
    "fitted_params",
    f"""WITH {aligned_sql()}, long AS (SELECT unnest([{', '.join(repr(f) for f in _FEATURES)}]) AS feature,
        unnest([{', '.join(f'CAST({f} AS DOUBLE)' for f in _FEATURES)}]) AS v FROM aligned WHERE fold = 'train'),
      med AS (SELECT feature, median(v) AS m FROM long GROUP BY 1)
    SELECT feature, round(max(m), 8) + 0.0 AS median, round(avg(coalesce(v, m)), 8) + 0.0 AS mean,
      round(stddev_pop(coalesce(v, m)), 8) + 0.0 AS std FROM long JOIN med USING (feature) GROUP BY 1""",
)
def params(spark, folder):
    rows = long_panel(spark, folder)
    fitted = fit_panel(rows.where("fold = 'train'"), _FEATURES)
    return rounded(fitted.to_frame(spark).drop("pos"))


def _scaled_rows(features) -> str:
    """Every aligned row with its features imputed and scaled by the training rows."""
    train = "FILTER (WHERE fold = 'train') OVER ()"
    medians = ", ".join(f"median({f}) AS m_{f}" for f in features)
    scaled = []
    for f in features:
        x = f"coalesce({f}, m_{f})"
        spread = f"stddev_pop({x}) {train}"
        scaled.append(f"({x} - avg({x}) {train}) / CASE WHEN {spread} < 1e-12 THEN 1 ELSE {spread} END AS {f}")
    return f"(SELECT date, fold, target, {', '.join(scaled)} FROM aligned CROSS JOIN (SELECT {medians} FROM aligned WHERE fold = 'train'))"


@query(
    "zscore_scale",
    rounded_sql(f"FROM {_scaled_rows(_FEATURES)} WHERE fold = 'val'",
                " ".join(_FEATURES), texts="date", ctes=aligned_sql()),
)
def scale(spark, folder):
    rows = long_panel(spark, folder)
    fitted = fit_panel(rows.where("fold = 'train'"), _FEATURES)
    return rounded(fitted.transform(rows.where("fold = 'val'"), ["date"]))


# --- flagship: hours of events to a scaled panel with next-day label ---------------------------
_EVENT_LABELS_SQL = """rare AS (SELECT CAST(ts AS DATE) AS date,
  count(*) FILTER (WHERE event_type = 'error') > count(*) / 5.0 AS any_environmental FROM events GROUP BY 1)"""
_EVENT_NAMES = lag_roll_names(HOURLY_DRIVERS) + PHASE_NAMES.split() + ["doy_sin", "doy_cos"]
_EVENT_ALIGNED = aligned_sql(HOURLY_DRIVERS, "hourly", HOURLY_SQL, _EVENT_LABELS_SQL, False).replace(
    FOLD_SQL, "CASE WHEN date <= DATE '2024-01-20' THEN 'train' ELSE 'test' END")


@query(
    "feature_panel",
    rounded_sql(f"FROM {_scaled_rows(_EVENT_NAMES)} WHERE fold = 'train'",
                " ".join(_EVENT_NAMES), "target", "date", digits=6, ctes=_EVENT_ALIGNED),
)
def feature_panel(spark, folder):
    events = table(spark, folder, "events")
    errors = F.count_if(F.col("event_type") == "error") > F.count(F.lit(1)) / 5.0
    labels = events.groupBy(F.to_date("ts").alias("date")).agg(errors.alias("any_environmental"))
    plan = FeaturePanel(PanelConfig(drivers=HOURLY_DRIVERS))
    scaled = plan.fit_transform(hourly_drivers(spark, folder), labels, F.col("date") <= F.lit("2024-01-20").cast("date"))
    return rounded(scaled, 6)


_FAMILIES = {
    "lag": r"name LIKE '%\_lag%' ESCAPE '\'", "roll": r"name LIKE '%\_rmean%' ESCAPE '\' OR name LIKE '%\_rstd%' ESCAPE '\'",
    "phase": r"name LIKE 'phase\_%' ESCAPE '\'", "season": r"name LIKE 'doy\_%' ESCAPE '\'",
    "coupling": r"name LIKE 'coupling\_%' ESCAPE '\' OR name IN ('frac_southward', 'pdyn_shock')",
}


@query(
    "feature_groups",
    f"WITH {LONG_SQL}, names AS (SELECT unnest([{', '.join(repr(f) for f in _FEATURES)}]) AS name), "
    + "counted AS (" + " UNION ALL ".join(f"SELECT '{k}' AS family, count(*) FILTER (WHERE {rule}) AS n_columns FROM names" for k, rule in _FAMILIES.items())
    + ") SELECT family, n_columns, (SELECT count(DISTINCT CAST(ts AS DATE)) FROM long_drivers) AS days FROM counted",
)
def groups(spark, folder):
    """Columns per family of the built panel, with the number of measured days."""
    daily = daily_features(long_drivers(spark, folder), CONFIG)
    families = feature_groups(feature_names(daily.columns, CONFIG))
    days = daily.agg(F.count(F.col("phase_quiet")).alias("days"))
    entries = F.array(*[F.struct(F.lit(k).alias("family"), F.lit(len(v)).cast("bigint").alias("n_columns")) for k, v in families.items()])
    return days.select("days", F.explode(entries).alias("e")).select("e.family", "e.n_columns", "days")


_PAIRS = ["Bz_gsm", "flow_speed", "flow_pressure", "Dst"]


@query(
    "interactions",
    rounded_sql(
        "FROM (SELECT *, " + ", ".join(f"{a} * {b} AS {a}__x__{b}" for i, a in enumerate(_PAIRS) for b in _PAIRS[i + 1:]) + " FROM hourly)",
        " ".join(_PAIRS + [f"{a}__x__{b}" for i, a in enumerate(_PAIRS) for b in _PAIRS[i + 1:]]), texts="ts", ctes=HOURLY_SQL,
    ).replace(*TEXT_TS),
)
def products(spark, folder):
    return rounded(interactions(hourly_drivers(spark, folder), _PAIRS, keep=["ts"]))


@query(
    "one_hot_drop_first",
    "SELECT o_orderkey, " + ", ".join(f"CAST(o_orderstatus = '{s}' AS BIGINT) AS status_{s}" for s in ("O", "P")) + " FROM orders",
)
def dummies(spark, folder):
    orders = table(spark, folder, "orders")
    return rounded(orders.select("o_orderkey", *one_hot(F.col("o_orderstatus"), ["F", "O", "P"], "status_")))
