"""Metrics, curves, calibration in closed form and tests."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from dayrisk.functions.scalars import clip, decide, even_grid
from dayrisk.operators import metrics as m
from dayrisk.operators.calibration import conformal_clip, isotonic_fit, isotonic_predict
from dayrisk.operators.order_stats import exact_quantiles, first_best
from dayrisk.operators.significance import chi_square_independence, contingency_table
from registry.core import query
from registry.inputs import (
    CATALOGUE_SQL, EVENT_SQL, LINE_SQL, event_scores, events_catalogue, line_scores, rounded, rounded_sql, table,
)

_CELLS = """count(*) FILTER (WHERE y = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE y = 0 AND p >= 0.5) AS fp,
  count(*) FILTER (WHERE y = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE y = 0 AND p < 0.5) AS tn"""
_TSS = "(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END - CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0 END)"
_HSS_DEN = "CAST((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn) AS DOUBLE)"
_HSS = f"(CASE WHEN {_HSS_DEN} > 0 THEN 2.0 * CAST(tp * tn - fp * fn AS DOUBLE) / {_HSS_DEN} ELSE 0 END)"


def decided_lines(spark, folder):
    return line_scores(spark, folder).withColumn("yhat", (F.col("p") >= 0.5).cast("int"))


@query("contingency", rounded_sql("FROM (SELECT model, " + _CELLS + " FROM scores GROUP BY 1)", ints="tp fp fn tn", texts="model", ctes=LINE_SQL))
def contingency(spark, folder):
    return rounded(m.contingency(decided_lines(spark, folder), by=["model"]))


@query(
    "tss_hss",
    rounded_sql(f"FROM (SELECT model, {_TSS} AS tss, {_HSS} AS hss FROM (SELECT model, {_CELLS} FROM scores GROUP BY 1))", "tss hss", texts="model", ctes=LINE_SQL),
)
def tss_hss(spark, folder):
    return rounded(m.skill_scores(decided_lines(spark, folder), by=["model"]).select("model", "tss", "hss"))


@query("brier", rounded_sql("FROM (SELECT model, avg((p - y) * (p - y)) AS brier FROM scores GROUP BY 1)", "brier", texts="model", ctes=LINE_SQL))
def brier_scores(spark, folder):
    return rounded(line_scores(spark, folder).groupBy("model").agg(m.brier(F.col("y"), F.col("p")).alias("brier")))


_BIN_EDGES = ", ".join(repr(float(e)) for e in np.linspace(0.0, 1.0, 11))
# (position, edge) pairs; a value's bin is the last edge at or below it, the top edge joins the last bin
_BINS_SQL = f"""edges AS (SELECT unnest(range(11)) AS i, unnest([{_BIN_EDGES}]::DOUBLE[]) AS e),
  placed AS (SELECT model, least(greatest(p, 0.0), 1.0) AS p, y,
    least((SELECT max(i) FROM edges WHERE e <= least(greatest(p, 0.0), 1.0)), 9) AS bin FROM scores),
  held AS (SELECT model, bin, avg(p) AS mp, avg(CAST(y AS DOUBLE)) AS fp, count(*) AS n FROM placed GROUP BY 1, 2),
  bins AS (SELECT g.model, b.i AS bin, lo.e AS edge_low, hi.e AS edge_high, 0.5 * (lo.e + hi.e) AS centre,
      coalesce(mp, 0.0) AS mean_predicted, coalesce(fp, 0.0) AS fraction_positive, coalesce(n, 0) AS "count"
    FROM (SELECT DISTINCT model FROM scores) g CROSS JOIN (SELECT unnest(range(10)) AS i) b
    JOIN edges lo ON lo.i = b.i JOIN edges hi ON hi.i = b.i + 1 LEFT JOIN held ON held.model = g.model AND held.bin = b.i)"""


@query(
    "reliability_bins",
    rounded_sql("FROM bins", "edge_low edge_high centre mean_predicted fraction_positive", "bin count", "model", ctes=f"{LINE_SQL}, {_BINS_SQL}")
    .replace("CAST(count AS BIGINT) AS count", 'CAST("count" AS BIGINT) AS "count"'),
)
def bins(spark, folder):
    return rounded(m.reliability_bins(line_scores(spark, folder), by=["model"]))


_EVENT_MODEL = EVENT_SQL.replace("AS y FROM events", "AS y, 'all' AS model FROM events")


@query(
    "reliability_curve",
    rounded_sql('FROM bins WHERE "count" > 0', "mean_predicted fraction_positive", "bin", "model", ctes=f"{_EVENT_MODEL}, {_BINS_SQL}"),
)
def reliability_points(spark, folder):
    scores = event_scores(spark, folder).withColumn("model", F.lit("all"))
    return rounded(m.reliability_curve(scores, by=["model"]).drop("count"))


@query(
    "ece",
    rounded_sql('FROM (SELECT model, sum("count" * abs(mean_predicted - fraction_positive)) / sum("count") AS ece FROM bins GROUP BY 1)',
                "ece", texts="model", ctes=f"{LINE_SQL}, {_BINS_SQL}"),
)
def calibration_error(spark, folder):
    return rounded(m.calibration_error(line_scores(spark, folder), by=["model"]))


_MARGINS = ", ".join(repr(x) for x in even_grid(0.0, 0.5, 50))
_THRESHOLDS = ", ".join(repr(x) for x in even_grid(0.05, 0.95, 91))


def _risk_sql(score):
    return f"""margins AS (SELECT unnest(range(50)) AS point, unnest([{_MARGINS}]::DOUBLE[]) AS margin),
      cells AS (SELECT point, margin, {_CELLS} FROM margins JOIN scores ON abs(p - 0.5) >= margin GROUP BY 1, 2),
      full_grid AS (SELECT point, margin, coalesce(tp, 0) AS tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn, coalesce(tn, 0) AS tn
        FROM margins LEFT JOIN cells USING (point, margin)),
      curve AS (SELECT point, margin, (tp + fp + fn + tn) / (SELECT count(*) FROM scores) AS coverage,
        CASE WHEN tp + fn > 0 AND fp + tn > 0 THEN {score} END AS score FROM full_grid)"""


for _name, _score, _inputs, _sql in (
    ("risk_coverage", "tss", event_scores, EVENT_SQL),
    ("risk_coverage_hss", "hss", line_scores, LINE_SQL),
):
    query(
        _name, rounded_sql("FROM curve", "margin coverage score", "point", ctes=f"{_sql}, {_risk_sql(_TSS if _score == 'tss' else _HSS)}")
    )(lambda spark, folder, score=_score, inputs=_inputs: rounded(m.risk_coverage(inputs(spark, folder), score=score)))


@query(
    "select_margin",
    rounded_sql("FROM (SELECT * FROM curve WHERE coverage >= 0.5 AND score IS NOT NULL ORDER BY score DESC, margin LIMIT 1)",
                "margin coverage score", "point", ctes=f"{EVENT_SQL}, {_risk_sql(_TSS)}"),
)
def margin(spark, folder):
    return rounded(m.select_margin(m.risk_coverage(event_scores(spark, folder))))


_SWEEP = f"""thresholds AS (SELECT unnest([{_THRESHOLDS}]::DOUBLE[]) AS threshold),
  cells AS (SELECT threshold, count(*) FILTER (WHERE y = 1 AND p >= threshold) AS tp, count(*) FILTER (WHERE y = 0 AND p >= threshold) AS fp,
    count(*) FILTER (WHERE y = 1 AND p < threshold) AS fn, count(*) FILTER (WHERE y = 0 AND p < threshold) AS tn
    FROM thresholds CROSS JOIN (SELECT y, p FROM scores) GROUP BY 1),
  sweep AS (SELECT threshold, {_TSS} AS tss FROM cells)"""


@query("threshold_sweep", rounded_sql("FROM sweep", "threshold tss", ctes=f"{EVENT_SQL}, {_SWEEP}"))
def sweep(spark, folder):
    return rounded(m.threshold_sweep(event_scores(spark, folder)))


@query("best_threshold", rounded_sql("FROM (SELECT * FROM sweep ORDER BY tss DESC, threshold LIMIT 1)", "threshold tss", ctes=f"{LINE_SQL}, {_SWEEP}"))
def tuned(spark, folder):
    return rounded(m.best_threshold(m.threshold_sweep(line_scores(spark, folder))))


_RANK = """hist AS (SELECT model, p, CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS pos, CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) AS neg
    FROM scores GROUP BY 1, 2),
  ranked AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM hist WINDOW w AS (PARTITION BY model ORDER BY p DESC ROWS UNBOUNDED PRECEDING)),
  ranking AS (SELECT model, sum(neg * (cp - pos + pos / 2)) / (sum(pos) * sum(neg)) AS roc_auc,
    sum(pos * cp / (cp + cn)) / sum(pos) AS average_precision FROM ranked GROUP BY 1)"""


@query("roc_auc", rounded_sql("FROM ranking", "roc_auc", texts="model", ctes=f"{_EVENT_MODEL}, {_RANK}"))
def auc(spark, folder):
    scores = event_scores(spark, folder).withColumn("model", F.lit("all"))
    return rounded(m.ranking_scores(scores, by=["model"]).select("model", "roc_auc"))


@query("average_precision", rounded_sql("FROM ranking", "average_precision", texts="model", ctes=f"{LINE_SQL}, {_RANK}"))
def precision(spark, folder):
    return rounded(m.ranking_scores(line_scores(spark, folder), by=["model"]).select("model", "average_precision"))


@query(
    "operating_points",
    f"WITH {EVENT_SQL}, points(point, t) AS (VALUES ('half', 0.5), ('tuned', 0.12), ('never', 2.0)), cells AS ("
    """SELECT point, count(*) FILTER (WHERE y = 1 AND p >= t) AS tp, count(*) FILTER (WHERE y = 0 AND p >= t) AS fp,
      count(*) FILTER (WHERE y = 1 AND p < t) AS fn, count(*) FILTER (WHERE y = 0 AND p < t) AS tn FROM points CROSS JOIN scores GROUP BY 1)"""
    f""" SELECT point, round((tp + tn) / (tp + fp + fn + tn), 8) + 0.0 AS accuracy, round(tp / (tp + fn), 8) + 0.0 AS recall,
      round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 8) + 0.0 AS precision, round(CAST({_TSS} AS DOUBLE), 8) + 0.0 AS tss,
      CAST(tp + fp AS BIGINT) AS alerts FROM cells""",
)
def points(spark, folder):
    return rounded(m.operating_points(event_scores(spark, folder), {"half": 0.5, "tuned": 0.12, "never": None}))


@query(
    "percent_report",
    f"WITH {LINE_SQL} SELECT model, printf('%.1f%%', 100.0 * avg(CAST(y AS DOUBLE))) AS base_rate FROM scores GROUP BY 1",
)
def percent_report(spark, folder):
    from dayrisk.functions.scalars import percent_text

    return line_scores(spark, folder).groupBy("model").agg(percent_text(F.avg(F.col("y").cast("double"))).alias("base_rate"))


@query(
    "regression_scores",
    """WITH pairs AS (SELECT l_linestatus AS model, l_extendedprice AS y, l_quantity * 1000.0 AS predicted FROM lineitem)
    SELECT model, round(1.0 - sum((y - predicted) * (y - predicted)) / (var_pop(y) * count(*)), 8) + 0.0 AS r2,
      round(avg(abs(y - predicted)), 4) + 0.0 AS mae FROM pairs GROUP BY 1""",
)
def regression(spark, folder):
    pairs = table(spark, folder, "lineitem").select(
        F.col("l_linestatus").alias("model"), F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1000.0).alias("predicted"))
    scored = m.regression_scores(pairs, by=["model"])
    return rounded(scored.select("model", "r2", F.round("mae", 4).alias("mae")))


@query(
    "log_loss",
    rounded_sql("""FROM (SELECT avg(-ln(greatest(least(CASE WHEN y = 1 THEN p ELSE 1 - p END, 1.0), 1e-9))) AS log_loss,
      -(avg(y) * ln(avg(y)) + (1 - avg(y)) * ln(1 - avg(y))) AS null_log_loss FROM scores)""", "log_loss null_log_loss", ctes=EVENT_SQL),
)
def losses(spark, folder):
    y, p = F.col("y"), F.col("p")
    return rounded(event_scores(spark, folder).agg(m.log_loss(y, p).alias("log_loss"), m.null_log_loss(y).alias("null_log_loss")))


_NC = "CASE WHEN y = 1 THEN 1.0 - p ELSE p END"
_HIGHER = f"""misses AS (SELECT nc, row_number() OVER (ORDER BY nc) - 1 AS k, count(*) OVER () AS n FROM (SELECT {_NC} AS nc FROM scores)),
  q AS (SELECT n, nc AS value FROM misses WHERE k = ceil((n - 1) * (1.0::DOUBLE - 0.1::DOUBLE)))"""


@query("higher_quantile", rounded_sql("FROM q", "value", "n", ctes=f"{EVENT_SQL}, {_HIGHER}"))
def quantile(spark, folder):
    return rounded(m.conformal_quantile(event_scores(spark, folder)).select("n", "value"))


@query(
    "exact_median",
    """SELECT 'l_extendedprice' AS feature, count(l_extendedprice) AS n, round(median(l_extendedprice), 8) + 0.0 AS value FROM lineitem
      UNION ALL SELECT 'l_quantity', count(l_quantity), round(median(l_quantity), 8) + 0.0 FROM lineitem""",
)
def medians(spark, folder):
    return rounded(exact_quantiles(table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"], 0.5))


@query(
    "conformal_clip",
    rounded_sql("FROM (SELECT event_id, least(greatest(value / (value + 50.0), (SELECT value FROM q) / 2), 1 - (SELECT value FROM q) / 2) AS p FROM events)",
                "p", "event_id", ctes=f"{EVENT_SQL}, {_HIGHER}"),
)
def conformal(spark, folder):
    q = m.conformal_quantile(event_scores(spark, folder)).first()["value"]
    events = table(spark, folder, "events").select("event_id", (F.col("value") / (F.col("value") + 50.0)).alias("p"))
    return rounded(events.select("event_id", conformal_clip(F.col("p"), q).alias("p")))


# Isotonic values by the min-max formula over the distinct scores.
_ISO = """hist AS (SELECT p, avg(CAST(y AS DOUBLE)) AS a, count(*) AS w, row_number() OVER (ORDER BY p) AS i FROM scores GROUP BY p),
  sums AS (SELECT i, p, sum(a * w) OVER (ORDER BY i) AS s, sum(w) OVER (ORDER BY i) AS c FROM hist),
  spans AS (SELECT l.i AS a, r.i AS b, (r.s - coalesce(z.s, 0)) / (r.c - coalesce(z.c, 0)) AS v
    FROM sums l JOIN sums r ON r.i >= l.i LEFT JOIN sums z ON z.i = l.i - 1),
  lows AS (SELECT k.i AS i, s.a, min(s.v) AS v FROM sums k JOIN spans s ON s.a <= k.i AND s.b >= k.i GROUP BY 1, 2),
  iso AS (SELECT i, max(v) AS v FROM lows GROUP BY 1)"""


@query("isotonic", rounded_sql("FROM (SELECT sums.p AS p, iso.v AS calibrated FROM iso JOIN sums USING (i))", "p calibrated", ctes=f"{LINE_SQL}, {_ISO}"))
def isotonic(spark, folder):
    scores = line_scores(spark, folder)
    curve = isotonic_fit(scores)
    return rounded(isotonic_predict(scores.select("p").distinct(), curve))


_METHODS = f"""raw AS (SELECT l_discount * 10.0 AS p0, CAST(l_returnflag = 'R' AS INTEGER) AS y FROM lineitem),
  q AS (SELECT nc AS value FROM (SELECT nc, row_number() OVER (ORDER BY nc) - 1 AS k, count(*) OVER () AS n
    FROM (SELECT CASE WHEN y = 1 THEN 1.0 - p0 ELSE p0 END AS nc FROM raw)) WHERE k = ceil((n - 1) * (1.0::DOUBLE - 0.1::DOUBLE))),
  scores AS (SELECT 'raw' AS model, p0 AS p, y FROM raw
    UNION ALL SELECT 'conformal', least(greatest(p0, (SELECT value FROM q) / 2), 1 - (SELECT value FROM q) / 2), y FROM raw
    UNION ALL SELECT 'squared', p0 * p0, y FROM raw)"""
_EVALUATE = f"""{_RANK}, {_BINS_SQL}, base AS (SELECT model, {_TSS} AS tss, {_HSS} AS hss, brier, base_rate FROM (
    SELECT model, {_CELLS}, avg((p - y) * (p - y)) AS brier, avg(CAST(y AS DOUBLE)) AS base_rate FROM scores GROUP BY 1)),
  eces AS (SELECT model, sum("count" * abs(mean_predicted - fraction_positive)) / sum("count") AS ece FROM bins GROUP BY 1)"""
_EVALUATED = "FROM base JOIN ranking USING (model) JOIN eces USING (model)"


@query("calibration_table", rounded_sql(_EVALUATED, "brier ece roc_auc", texts="model", ctes=f"{_METHODS}, {_EVALUATE}"))
def calibration_table(spark, folder):
    wide = line_scores(spark, folder).select("y", F.col("p").alias("raw"))
    q = m.conformal_quantile(wide, p="raw").first()["value"]
    wide = wide.withColumns({"conformal": conformal_clip(F.col("raw"), q), "squared": F.col("raw") * F.col("raw")})
    table_ = m.evaluate(m.long_scores(wide, {n: n for n in ("raw", "conformal", "squared")}))
    return rounded(table_.select("model", "brier", "ece", "roc_auc"))


@query(
    "model_comparison",
    rounded_sql(_EVALUATED, "tss hss roc_auc average_precision brier ece base_rate", texts="model", ctes=f"{LINE_SQL}, {_EVALUATE}"),
)
def comparison(spark, folder):
    return rounded(m.evaluate(line_scores(spark, folder)))


@query(
    "model_select",
    f"""WITH {LINE_SQL}, {_EVALUATE} SELECT model, round(tss, 3) + 0.0 AS tss {_EVALUATED} ORDER BY round(tss, 3) DESC, model LIMIT 1""",
)
def select_model(spark, folder):
    scored = m.skill_scores(decided_lines(spark, folder), by=["model"]).select("model", F.round("tss", 3).alias("tss"))
    return rounded(first_best(scored, "tss", F.col("model")))


@query(
    "decide",
    """SELECT event_id, CASE WHEN abs(value / (value + 50.0) - 0.5) < 0.05 THEN 'ABSTAIN' WHEN value / (value + 50.0) >= 0.5 THEN 'ALERT'
      ELSE 'NO ALERT' END AS decision FROM events""",
)
def decisions(spark, folder):
    p = F.col("value") / (F.col("value") + 50.0)
    return table(spark, folder, "events").select("event_id", decide(p, 0.05).alias("decision"))


@query(
    "clip_scores",
    "SELECT event_id, round(least(greatest(value / 100.0, 0.0), 1.0), 8) + 0.0 AS p FROM events",
)
def clipped(spark, folder):
    return rounded(table(spark, folder, "events").select("event_id", clip(F.col("value") / 100.0, 0.0, 1.0).alias("p")))


_CROSS = f"""{CATALOGUE_SQL}, t AS (SELECT ADIAG AS r, ORBIT AS c, count(*) AS n FROM catalogue WHERE ADIAG IN ('ESD', 'ECEMP', 'SEU') GROUP BY 1, 2),
  e AS (SELECT r, c, n, sum(n) OVER (PARTITION BY r) * sum(n) OVER (PARTITION BY c) / sum(n) OVER () AS x FROM t)"""


@query(
    "crosstab",
    f"WITH {_CROSS} SELECT r AS ADIAG, "
    + ", ".join(f"CAST(sum(n) FILTER (WHERE c = '{c}') AS BIGINT) AS {c}" for c in ("E", "G", "P")) + " FROM t GROUP BY 1",
)
def crosstab(spark, folder):
    events = events_catalogue(spark, folder).where(F.col("ADIAG").isin("ESD", "ECEMP", "SEU"))
    return rounded(contingency_table(events, "ADIAG", "ORBIT", ["E", "G", "P"]))


@query(
    "chi_square",
    rounded_sql("""FROM (SELECT sum((n - x) * (n - x) / x) AS chi2, (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS dof,
      exp(-sum((n - x) * (n - x) / x) / 2) * (1 + sum((n - x) * (n - x) / x) / 2) AS p_value FROM e)""", "chi2 p_value", "dof", ctes=_CROSS),
)
def chi_square(spark, folder):
    """Independence of diagnosis and orbit; with four degrees of freedom the tail has a closed form."""
    events = events_catalogue(spark, folder).where(F.col("ADIAG").isin("ESD", "ECEMP", "SEU"))
    return rounded(chi_square_independence(events, "ADIAG", "ORBIT"))
