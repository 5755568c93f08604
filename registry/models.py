"""Model fits, comparisons, clusterings and scoring on the long panel."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayrisk.operators import classifiers as c
from dayrisk.operators import clusters
from dayrisk.operators.daily import to_daily
from dayrisk.operators.density import dbscan
from dayrisk.operators.labels import daily_event_counts, fold_column
from dayrisk.operators.linear import fit_elastic_net, fit_lasso, fit_ols, fit_ridge
from dayrisk.operators.metrics import evaluate
from dayrisk.operators.ward import ward_clusters
from dayrisk.plans import study
from dayrisk.plans.baselines import climatology, persistence
from dayrisk.plans.hypotheses import events_with_phase, regimes_beyond_index
from dayrisk.plans.panel import FittedPanel, align_target, daily_features, feature_groups, fit_panel
from dayrisk.plans.scoring import scenario_rows, score_scenarios
from dayrisk.sources.bundle import Bundle
from dayrisk.sources.run_metrics import long_metrics
from dayrisk.session import settled
from registry.core import query
from registry.features import _FEATURES, _lag, aligned_sql, CONFIG, long_panel
from registry.inputs import (
    CATALOGUE_SQL, LINE_SQL, LONG_CUTS, LONG_SQL, events_catalogue, line_scores, long_drivers, rare_labels, rounded, rounded_sql, table,
)
from registry.scoring import _EVALUATE, _EVALUATED

BASE = [f for f in _FEATURES if f not in feature_groups(_FEATURES)["coupling"]]
FITS = {"logit": c.logit, "forest": c.forest, "boosting": c.boosting, "kernel": c.kernel_machine, "calibrated_logit": c.calibrated_logit}


def scaled_panel(spark: SparkSession, folder: str) -> tuple[FittedPanel, DataFrame]:
    """The scaled long panel with all folds, read anew for every query.

    A fit is dozens of small jobs; on a settled panel none of them carries the panel's lineage.
    """
    rows = settled(long_panel(spark, folder).where("fold IS NOT NULL"))
    fitted = fit_panel(rows.where("fold = 'train'"), _FEATURES)
    return fitted, settled(fitted.transform(rows, ["date", "fold", "target"]))


def _panel(spark, folder):
    return scaled_panel(spark, folder)[1]


def _train(spark, folder):
    return _panel(spark, folder).where("fold = 'train'")


def _validated(spark, folder, name: str) -> DataFrame:
    """Metric row of a model fitted on train, on the validation fold."""
    panel = _panel(spark, folder)
    model = FITS[name](study.in_fold(panel, "train"), BASE, "target")
    return study.metric_rows(model.score(study.in_fold(panel, "val")).select(F.lit(model.name).alias("model"), F.col("target").alias("y"), "p"))


# --- linear models with one feature have a closed form ------------------------------------------
_XY = """xy AS (SELECT l_extendedprice / 1000.0 AS y, l_quantity AS x FROM lineitem),
  mo AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS v, covar_pop(x, y) AS cv FROM xy)"""


def _xy(spark, folder):
    return table(spark, folder, "lineitem").select((F.col("l_extendedprice") / 1000.0).alias("y"), F.col("l_quantity").alias("x"))


def _line(spark, fit):
    return rounded(spark.createDataFrame([(fit.weights[0], fit.intercept)], "slope double, intercept double"), 4)


for _name, _fit, _slope in (
    ("ols_1d", fit_ols, "cv / v"),
    ("ridge_1d", fit_ridge, "cv / (v + 1.0 / n)"),
    ("lasso_1d", fit_lasso, "sign(cv) * greatest(abs(cv) - 0.1, 0) / v"),
    ("elastic_net_1d", fit_elastic_net, "sign(cv) * greatest(abs(cv) - 0.05, 0) / (v + 0.05)"),
):
    query(_name, rounded_sql(f"FROM (SELECT {_slope} AS slope, my - ({_slope}) * mx AS intercept FROM mo)", "slope intercept", digits=4, ctes=_XY))(
        lambda spark, folder, fit=_fit: _line(spark, fit(_xy(spark, folder), ["x"]))
    )


@query("logit")
def logit(spark, folder):
    fit = c.logit(_train(spark, folder), BASE, "target").model
    return spark.createDataFrame(list(zip(fit.features, fit.weights)), "feature string, weight double")


@query("regressor_table")
def regressors(spark, folder):
    """OLS, ridge, lasso, elastic net, interactions with ridge, and random consensus on the daily minimum."""
    daily = to_daily(long_drivers(spark, folder), {"y": F.min("Dst")})
    lags = [f for f in BASE if f.startswith(("Bz_gsm_lag", "flow_speed_lag", "proton_density_lag", "flow_pressure_lag"))]
    panel = _panel(spark, folder).join(daily, "date", "left").persist()
    try:
        return spark.createDataFrame(study.regressor_table(panel, lags).collect(), "model string, r2 double, mae double")  # six rows
    finally:
        panel.unpersist()


@query("forest")
def random_forest(spark, folder):
    return _validated(spark, folder, "forest")


@query("boosting")
def gradient_boosting(spark, folder):
    return _validated(spark, folder, "boosting")


@query("rff_svm")
def kernel(spark, folder):
    return _validated(spark, folder, "kernel")


@query("calibrated_logit")
def averaged_logit(spark, folder):
    return _validated(spark, folder, "calibrated_logit")


@query("cv_auc")
def time_series_auc(spark, folder):
    auc = study.cross_validated_auc(_train(spark, folder), BASE, c.logit)
    return spark.createDataFrame([("logit", auc)], "model string, cv_roc_auc double")


@query("model_table")
def model_table(spark, folder):
    """All classifiers, fitted on train, scored on val in one table, with their cross-validated AUC."""
    return study.compare_models(_panel(spark, folder), BASE, FITS)


@query("ablation")
def ablation(spark, folder):
    """The forest on five nested feature sets."""
    return study.ablation(_panel(spark, folder), study.ablation_sets(_FEATURES), c.forest)


@query("calibrations")
def recalibrated(spark, folder):
    """The selected model and three recalibrations of it."""
    panel = _panel(spark, folder)
    return study.calibration_table(study.calibrations(panel, BASE, FITS[study.headline_model(panel, BASE, FITS)]))


def _locked(spark, folder, panel: DataFrame | None = None) -> study.LockedTest:
    return study.LockedTest.of_best(_panel(spark, folder) if panel is None else panel, rare_labels(spark, folder), BASE, FITS)


@query("validation_table")
def validated(spark, folder):
    """Persistence, climatology and the calibrated logit on the validation fold."""
    return study.validation_table(_panel(spark, folder), rare_labels(spark, folder), BASE, c.calibrated_logit)


@query("locked_test_report")
def locked(spark, folder):
    return _locked(spark, folder).report()


@query("locked_test_points")
def locked_points(spark, folder):
    return _locked(spark, folder).operating_points()


@query(
    "locked_test_baselines",
    rounded_sql(
        "FROM base JOIN eces USING (model)", "tss hss brier ece base_rate", texts="model",
        ctes=f"""{aligned_sql()}, scores AS (
          SELECT 'persistence' AS model, target AS y, CAST(coalesce(CAST(any_environmental AS INTEGER), 0) AS DOUBLE) AS p FROM aligned LEFT JOIN rare USING (date) WHERE fold = 'test'
          UNION ALL SELECT 'climatology', target, (SELECT avg(CAST(target AS DOUBLE)) FROM aligned WHERE fold = 'train') FROM aligned WHERE fold = 'test'),
          {_EVALUATE}""",
    ),
)
def locked_baselines(spark, folder):
    """The two forecasts without a model on the test fold."""
    panel, labels = settled(long_panel(spark, folder).select("date", "fold", "target")), rare_labels(spark, folder)
    test = study.in_fold(panel, "test").select("date", F.col("target").alias("y"))
    same = persistence(test, labels, "any_environmental").select(F.lit("persistence").alias("model"), "y", F.col("predicted").cast("double").alias("p"))
    flat = climatology(test, study.in_fold(panel, "train"), "target").select(F.lit("climatology").alias("model"), "y", "p")
    return rounded(evaluate(same.unionByName(flat)).select("model", "tss", "hss", "brier", "ece", "base_rate"))


@query("slice_rerun")
def one_orbit(spark, folder):
    """The forest's protocol again with labels from all orbits and from one orbit's events only."""
    events, daily = events_catalogue(spark, folder), daily_features(long_drivers(spark, folder), CONFIG)
    parts = []
    for name, own in (("all orbits", events), ("one orbit", events.where("ORBIT = 'G'"))):
        rows = align_target(daily, daily_event_counts(own), CONFIG)
        rows = settled(rows.withColumn("fold", fold_column(F.col("date"), LONG_CUTS)).where("fold IS NOT NULL"))
        fitted = fit_panel(rows.where("fold = 'train'"), BASE)
        panel = settled(fitted.transform(rows, ["date", "fold", "target"]))
        parts.append(study.slice_rerun(panel, BASE, c.forest).withColumn("model", F.lit(name)))
    return parts[0].unionByName(parts[1])


# --- hypotheses ---------------------------------------------------------------------------------
DAY_PHASE = f"""phases AS (SELECT CAST(ts AS DATE) AS d, CASE WHEN Dst <= -30 AND change < 0 THEN 'phase_main'
    WHEN Dst <= -30 AND change >= 0 THEN 'phase_recovery' ELSE 'phase_quiet' END AS phase
    FROM (SELECT ts, Dst, Dst - {_lag('Dst', 1)} AS change FROM long_drivers)),
  t AS (SELECT ADIAG AS r, phase AS c, count(*) AS n FROM catalogue JOIN phases ON d = anomaly_date WHERE is_environmental GROUP BY 1, 2),
  e AS (SELECT r, c, n, sum(n) OVER (PARTITION BY r) * sum(n) OVER (PARTITION BY c) / sum(n) OVER () AS x FROM t)"""


@query("phase_crosstab", f"WITH {CATALOGUE_SQL}, {LONG_SQL}, {DAY_PHASE} SELECT r AS ADIAG, c AS phase, n FROM t")
def phase_counts(spark, folder):
    rows = events_with_phase(events_catalogue(spark, folder), long_drivers(spark, folder))
    return rows.groupBy("ADIAG", "phase").agg(F.count(F.lit(1)).alias("n"))


@query("lr_test_regimes")
def regimes(spark, folder):
    labels = rare_labels(spark, folder).where(F.col("date") <= F.lit(LONG_CUTS["train"]).cast("date"))
    return regimes_beyond_index(long_drivers(spark, folder), labels)


# --- clusters -----------------------------------------------------------------------------------
def _places(spark, folder) -> tuple[DataFrame, list[str]]:
    """Whole embeddings as columns, and the names of the columns."""
    rows = table(spark, folder, "embeddings")
    width = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    names = [f"x{i}" for i in range(width)]
    return rows.select(
        F.col("vec_id").alias("id"), F.col("label").alias("cluster"), *[F.get("embedding", F.lit(i)).cast("double").alias(x) for i, x in enumerate(names)]
    ), names


def _projected(spark, folder):
    train = _train(spark, folder)
    return clusters.fit_pca(train, BASE).transform(train, ["date", "target"])


@query("pca")
def pca(spark, folder):
    shares = clusters.fit_pca(_train(spark, folder), BASE).shares
    return spark.createDataFrame([(i + 1, s) for i, s in enumerate(shares)], "axis int, share double")


@query("kmeans")
def kmeans(spark, folder):
    rows = _projected(spark, folder)
    axes = ["pc1", "pc2", "pc3"]
    found = clusters.assign(rows, clusters.kmeans(rows, axes, 5), axes)
    return found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("target").alias("rate"))


@query("bisecting")
def bisecting(spark, folder):
    rows = _projected(spark, folder)
    axes = ["pc1", "pc2", "pc3"]
    found = clusters.assign(rows, clusters.bisecting(rows, axes), axes)
    return clusters.rate_spread(found, "target")


@query("ward")
def hierarchical(spark, folder):
    found = ward_clusters(_projected(spark, folder), ["pc1", "pc2", "pc3"], 5)
    return found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("target").alias("rate"))


@query("cluster_table")
def clusterings(spark, folder):
    """Four clusterings of one projection: clusters, silhouette and spread of the positive rate."""
    axes = ["pc1", "pc2", "pc3"]
    methods = {
        "kmeans": lambda rows: clusters.assign(rows, clusters.kmeans(rows, axes, 5), axes),
        "ward": lambda rows: ward_clusters(rows, axes, 5),
        "bisecting": lambda rows: clusters.assign(rows, clusters.bisecting(rows, axes), axes),
        "dbscan": lambda rows: dbscan(rows, axes, 0.5, 20),
    }
    return study.cluster_table(_projected(spark, folder), axes, methods)


@query("dbscan")
def density(spark, folder):
    rows = _projected(spark, folder)
    found = dbscan(rows, ["pc1", "pc2", "pc3"], 0.5, 20)
    return found.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.avg("target").alias("rate"))


@query(
    "pos_rate_spread",
    """SELECT round(max(r) - min(r), 8) + 0.0 AS pos_rate_spread FROM (
      SELECT l_linenumber, avg(CAST(l_returnflag = 'R' AS DOUBLE)) AS r FROM lineitem GROUP BY 1)""",
)
def spread(spark, folder):
    items = table(spark, folder, "lineitem").select(F.col("l_linenumber").alias("cluster"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return rounded(clusters.rate_spread(items))


_POINTS = "pts AS (SELECT vec_id AS id, label AS c, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _silhouette_sql(power):
    d = f"power(list_distance(a.v, b.v), {power})"
    return f"""{_POINTS}, sums AS (SELECT a.id, a.c, b.c AS t, sum({d}) AS d, count(*) AS m FROM pts a CROSS JOIN pts b GROUP BY 1, 2, 3),
      ab AS (SELECT id, max(CASE WHEN c = t THEN d / nullif(m - 1, 0) END) AS a, min(CASE WHEN c <> t THEN d / m END) AS b FROM sums GROUP BY 1),
      sil AS (SELECT avg(CASE WHEN a IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM ab)"""


@query("silhouette_exact", rounded_sql("FROM sil", "silhouette", ctes=_silhouette_sql(1)))
def silhouette(spark, folder):
    return rounded(clusters.silhouette_exact(*_places(spark, folder)).select("silhouette"))


@query("silhouette_squared", rounded_sql("FROM sil", "silhouette", ctes=_silhouette_sql(2)))
def silhouette_one_pass(spark, folder):
    value = clusters.silhouette_squared(*_places(spark, folder))
    return rounded(spark.createDataFrame([(value,)], "silhouette double"))


# --- scoring ------------------------------------------------------------------------------------
def _bundle(spark, folder) -> Bundle:
    fitted, panel = scaled_panel(spark, folder)
    base = FittedPanel([p for p in fitted.params if p[0] in set(BASE)])
    test = _locked(spark, folder, panel)
    return Bundle(base, test.model, test.curve, test.margin(), CONFIG)


@query("batch_score")
def batch_score(spark, folder):
    """Every day of the drivers scored and decided, without labels."""
    daily = daily_features(long_drivers(spark, folder), CONFIG)
    return _bundle(spark, folder).score(daily)


def _scenarios(spark, folder):
    return table(spark, folder, "events").select(
        F.col("event_id").alias("scenario_id"), (F.col("value") - 50.0).alias("Bz_gsm"), (F.col("value") * 10.0).alias("flow_speed"),
        (-F.col("value")).alias("Dst"), F.dayofyear("ts").alias("doy"))


@query("scenario_score")
def scenario_score(spark, folder):
    return score_scenarios(_scenarios(spark, folder), _bundle(spark, folder))


_SCENARIO = ["Bz_gsm_lag1h", "Bz_gsm_rmean24h", "Bz_gsm_rstd6h", "Dst_lag3h", "flow_speed_rmean6h", "AE_lag1h", "phase_quiet", "phase_main", "phase_recovery", "doy_sin", "doy_cos"]


@query(
    "scenario_rows",
    rounded_sql("""FROM (SELECT event_id AS scenario_id, value - 50.0 AS Bz_gsm_lag1h, value - 50.0 AS Bz_gsm_rmean24h, NULL AS Bz_gsm_rstd6h,
      -value AS Dst_lag3h, value * 10.0 AS flow_speed_rmean6h, NULL AS AE_lag1h, CAST(-value > -30 AS INTEGER) AS phase_quiet,
      CAST(-value <= -30 AS INTEGER) AS phase_main, 0 AS phase_recovery, sin(2 * pi() * extract(doy FROM ts) / 366.0) AS doy_sin,
      cos(2 * pi() * extract(doy FROM ts) / 366.0) AS doy_cos FROM events)""", " ".join(_SCENARIO), "scenario_id"),
)
def what_if(spark, folder):
    return rounded(scenario_rows(_scenarios(spark, folder), _SCENARIO))


@query(
    "run_metrics",
    f"""WITH {LINE_SQL}, {_EVALUATE}, wide AS (SELECT model, tss, brier, ece {_EVALUATED})
    SELECT 'run' AS run_id, model, 'all' AS fold, metric, round(value, 8) + 0.0 AS value FROM (
      SELECT model, 'tss' AS metric, CAST(tss AS DOUBLE) AS value FROM wide UNION ALL SELECT model, 'brier', brier FROM wide UNION ALL SELECT model, 'ece', ece FROM wide)""",
)
def metrics_rows(spark, folder):
    return rounded(long_metrics(evaluate(line_scores(spark, folder)), "run", "all", ["tss", "brier", "ece"]))
