"""Fits and tests whose numbers SQL can follow: logits by Newton steps, chi-square tests with their tails, scoring from a given bundle."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayrisk.constants import SEED
from dayrisk.operators import classifiers as c
from dayrisk.operators.calibration import platt_fit, platt_predict
from dayrisk.operators.density import dbscan
from dayrisk.operators.isotonic import IsotonicCurve
from dayrisk.operators.linear import LinearFit, fit_logit, fit_logits
from dayrisk.operators.ransac import P, draw_rows, fit_ransac, trial_order
from dayrisk.operators.significance import chi_square_independence
from dayrisk.plans.hypotheses import events_with_phase, next_day_odds, phase_by_class
from dayrisk.plans.panel import FittedPanel, daily_features
from dayrisk.plans.scoring import score_scenarios
from dayrisk.sources.bundle import Bundle
from dayrisk.session import settled
from registry.core import query
from registry.features import CONFIG, PANEL_DRIVERS, daily_panel_sql
from registry.inputs import (
    CATALOGUE_SQL, LINE_SQL, LONG_CUTS, LONG_SQL, RARE_SQL, events_catalogue, line_scores, long_drivers, rare_labels, rounded, rounded_sql, table,
)
from registry.models import DAY_PHASE

STEPS = 40


def newton_sql(data: str, features: int, by: str = "", name: str = "fitted") -> str:
    """Recursive CTE ``name(it, b0, b1[, b2][, by])``: Newton steps for the logit over ``data(w, y, x1[, x2][, by])`` with the usual penalty."""
    x = ["1.0", *[f"x{i}" for i in range(1, features + 1)]]
    n = len(x)
    key = f"{by}, " if by else ""
    score = " + ".join(f"b{i} * {x[i]}" for i in range(n))
    sums = [f"sum(w * (m - y) * {x[i]}) + {'b%d' % i if i else '0'} AS g{i}" for i in range(n)]
    sums += [f"sum(w * m * (1 - m) * {x[i]} * {x[j]}) + {int(i == j and i > 0)} AS h{i}{j}" for i in range(n) for j in range(i, n)]
    h = lambda i, j: f"h{min(i, j)}{max(i, j)}"

    def determinant(columns) -> str:
        if n == 2:
            (a, b), (d, e) = columns
            return f"({a} * {e} - {d} * {b})"
        p, q, r = columns
        return " + ".join(f"{p[i]} * ({q[(i + 1) % 3]} * {r[(i + 2) % 3]} - {q[(i + 2) % 3]} * {r[(i + 1) % 3]})" for i in range(3)).join("()")

    gram = [[h(i, j) for i in range(n)] for j in range(n)]
    steps = [f"b{k} - {determinant([[f'g{i}' for i in range(n)] if j == k else gram[j] for j in range(n)])} / {determinant(gram)} AS b{k}" for k in range(n)]
    betas = ", ".join(f"b{i}" for i in range(n))
    match = f"JOIN {data} USING ({by})" if by else f", {data}"
    start = f"SELECT DISTINCT 0 AS it, {', '.join(f'0.0::DOUBLE AS b{i}' for i in range(n))}{f', {by}' if by else ''} FROM {data}"
    return f"""{name} AS ({start} UNION ALL
    SELECT it + 1 AS it, {', '.join(steps)}{f', {by}' if by else ''} FROM (
      SELECT it, {key}{betas}, {', '.join(sums)} FROM (SELECT *, 1 / (1 + exp(-({score}))) AS m FROM (SELECT * FROM {name} WHERE it < {STEPS}) {match})
      GROUP BY it, {key}{betas}))"""


# --- logits -------------------------------------------------------------------------------------
_PLATT = "d AS (SELECT p AS x1, y, count(*) AS w FROM scores GROUP BY 1, 2)"


@query(
    "platt",
    rounded_sql(
        f"FROM (SELECT DISTINCT x1 AS p, 1 / (1 + exp(-(b0 + b1 * x1))) AS calibrated FROM d, (SELECT * FROM fitted WHERE it = {STEPS}))", "p calibrated", digits=7,
        ctes=f"{LINE_SQL}, {_PLATT}, {newton_sql('d', 1)}",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def platt(spark, folder):
    scores = line_scores(spark, folder)
    slope, intercept = platt_fit(scores)
    return rounded(scores.select("p").distinct().withColumn("calibrated", platt_predict(F.col("p"), slope, intercept)), 7)


_TWO = """d AS (SELECT l_linestatus AS model, l_quantity / 10.0 AS x1, l_discount * 10.0 AS x2, CAST(l_returnflag = 'R' AS INTEGER) AS y, count(*) AS w
  FROM lineitem GROUP BY 1, 2, 3, 4)"""


def _two(spark, folder):
    flag = (F.col("l_returnflag") == "R").cast("int").alias("y")
    return table(spark, folder, "lineitem").select(F.col("l_linestatus").alias("model"), (F.col("l_quantity") / 10.0).alias("x1"), (F.col("l_discount") * 10.0).alias("x2"), flag)


@query(
    "logit_two_features",
    rounded_sql(f"FROM (SELECT b0 AS intercept, b1 AS x1, b2 AS x2 FROM fitted WHERE it = {STEPS})", "intercept x1 x2", digits=7, ctes=f"{_TWO}, {newton_sql('d', 2)}").replace(
        "WITH ", "WITH RECURSIVE ", 1),
)
def two_features(spark, folder):
    fit = fit_logit(_two(spark, folder), ["x1", "x2"])
    return rounded(spark.createDataFrame([(fit.intercept, *fit.weights)], "intercept double, x1 double, x2 double"), 7)


@query(
    "many_logits",
    rounded_sql(f"FROM (SELECT slice, b0 AS intercept, b1 AS x1, b2 AS x2 FROM fitted WHERE it = {STEPS})", "intercept x1 x2", "slice", digits=7,
                ctes=f"""{_TWO}, sliced AS (SELECT d.*, s.slice FROM d JOIN (SELECT unnest(range(5)) AS slice) s ON CAST(round(x2 * 10) AS BIGINT) % 5 <> s.slice),
                {newton_sql('sliced', 2, 'slice')}""").replace("WITH ", "WITH RECURSIVE ", 1),
)
def slices(spark, folder):
    """Five fits, each without a fifth of the discounts, by the same passes over the rows."""
    rows = _two(spark, folder).withColumn("fold", F.round(F.col("x2") * 10).cast("int") % 5)
    fits = fit_logits(rows, ["x1", "x2"], "y", [(F.col("fold") != k).cast("double") for k in range(5)])
    return rounded(spark.createDataFrame([(k, f.intercept, *f.weights) for k, f in enumerate(fits)], "slice long, intercept double, x1 double, x2 double"), 7)


_ODDS = f"""days AS (SELECT date, any_environmental, Bz_gsm, flow_speed FROM rare JOIN (SELECT CAST(ts AS DATE) AS date, avg(Bz_gsm) AS Bz_gsm, avg(flow_speed) AS flow_speed
    FROM long_drivers GROUP BY 1) USING (date) WHERE date <= DATE '{LONG_CUTS['train']}' AND Bz_gsm IS NOT NULL AND flow_speed IS NOT NULL),
  d AS (SELECT Bz_gsm AS x1, flow_speed AS x2, y, 1 AS w FROM (SELECT *, CAST(lead(any_environmental) OVER (ORDER BY date) AS INTEGER) AS y FROM days) WHERE y IS NOT NULL),
  base AS (SELECT avg(CAST(y AS DOUBLE)) AS r, count(*) AS n FROM d),
  best AS (SELECT * FROM fitted WHERE it = {STEPS}),
  losses AS (SELECT b1 AS coef_Bz_gsm, b2 AS coef_flow_speed, n, 2.0 * n * ((-(r * ln(r) + (1 - r) * ln(1 - r))) - (SELECT
      avg(-ln(least(greatest(CASE WHEN y = 1 THEN m ELSE 1 - m END, 1e-9), 1.0))) FROM (SELECT y, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS m FROM d, best))) AS statistic
    FROM base, best)"""


@query(
    "lr_test_next_day",
    rounded_sql("FROM (SELECT *, exp(-statistic / 2) AS p_value FROM losses)", "coef_Bz_gsm coef_flow_speed statistic p_value", "n", digits=6,
                ctes=f"{LONG_SQL}, {RARE_SQL}, {_ODDS.replace('  base AS', '  ' + newton_sql('d', 2) + ',' + chr(10) + '  base AS')}").replace("WITH ", "WITH RECURSIVE ", 1),
)
def odds(spark, folder):
    labels = rare_labels(spark, folder).where(F.col("date") <= F.lit(LONG_CUTS["train"]).cast("date"))
    return rounded(next_day_odds(long_drivers(spark, folder), labels), 6)


# --- random consensus -----------------------------------------------------------------------------
TRIALS, DRAWN, WITHIN = 200, 50, 20.0
_ORDER = ", ".join(f"({t}, {a}::BIGINT, {b}::BIGINT)" for t, (a, b) in enumerate(trial_order(TRIALS, SEED)))
_ITEMS = """items AS (SELECT l_orderkey * 8 + l_linenumber AS key, CAST(l_quantity AS DOUBLE) AS x1, CAST(l_discount AS DOUBLE) AS x2, l_extendedprice / 1000.0 AS y FROM lineitem)"""
_DRAWS = f"""{_ITEMS}, drawing(trial, a, b) AS (VALUES {_ORDER}),
  draws AS (SELECT trial, key, x1, x2, y FROM (SELECT *, row_number() OVER (PARTITION BY trial ORDER BY (key % {P} * a + b) % {P}, key, x1, x2, y) AS place FROM items, drawing) WHERE place <= {DRAWN})"""


def _least_squares(source: str, by: str = "") -> str:
    """Intercept and two slopes by the normal equations."""
    head = f"{by}, " if by else ""
    gram = [["n", "s1", "s2"], ["s1", "s11", "s12"], ["s2", "s12", "s22"]]
    det = lambda c: "(" + " + ".join(f"{c[0][i]} * ({c[1][(i + 1) % 3]} * {c[2][(i + 2) % 3]} - {c[1][(i + 2) % 3]} * {c[2][(i + 1) % 3]})" for i in range(3)) + ")"
    solved = ", ".join(f"{det([['sy', 's1y', 's2y'] if j == k else gram[j] for j in range(3)])} / {det(gram)} AS b{k}" for k in range(3))
    return f"""(SELECT {head}{solved} FROM (SELECT {head}CAST(count(*) AS DOUBLE) AS n, sum(x1) AS s1, sum(x2) AS s2, sum(x1 * x1) AS s11, sum(x1 * x2) AS s12, sum(x2 * x2) AS s22,
      sum(y) AS sy, sum(x1 * y) AS s1y, sum(x2 * y) AS s2y FROM {source} {f'GROUP BY {by}' if by else ''}))"""


def _items(spark, folder):
    return table(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"), F.col("l_quantity").cast("double").alias("x1"), F.col("l_discount").cast("double").alias("x2"),
        (F.col("l_extendedprice") / 1000.0).alias("y"))


@query("ransac_draws", rounded_sql("FROM draws", "x1 x2 y", "trial key", ctes=_DRAWS))
def draws(spark, folder):
    """The rows that each of 200 trials fits on."""
    return rounded(draw_rows(_items(spark, folder), "key", ["x1", "x2", "y"], DRAWN, TRIALS, SEED))


@query(
    "ransac",
    rounded_sql(f"FROM {_least_squares('inside')}", "x1 x2 intercept", digits=5, ctes=f"""{_DRAWS}, fits AS (SELECT * FROM {_least_squares('draws', 'trial')}),
      judged AS (SELECT trial, b0, b1, b2, count(*) AS inliers, sum(e * e) AS squares FROM (SELECT *, abs(y - (b0 + b1 * x1 + b2 * x2)) AS e FROM items, fits) WHERE e <= {WITHIN} GROUP BY ALL),
      best AS (SELECT * FROM judged ORDER BY inliers DESC, squares, trial LIMIT 1),
      inside AS (SELECT items.* FROM items, best WHERE abs(y - (b0 + b1 * x1 + b2 * x2)) <= {WITHIN})""").replace("CAST(x1 AS", "CAST(b1 AS").replace(
        "CAST(x2 AS DOUBLE), 5)", "CAST(b2 AS DOUBLE), 5)").replace("CAST(intercept AS", "CAST(b0 AS"),
)
def ransac(spark, folder):
    fit = fit_ransac(_items(spark, folder), ["x1", "x2"], "key", threshold=WITHIN, trials=TRIALS)
    return rounded(spark.createDataFrame([(*fit.weights, fit.intercept)], "x1 double, x2 double, intercept double"), 5)


# --- chi-square tests with their tails ------------------------------------------------------------
_TAIL = "exp(-chi2 / 2) * list_sum(list_transform(range(dof // 2), lambda k: power(chi2 / 2, k) / gamma(k + 1)))"  # an even number of degrees of freedom


@query(
    "phase_chi_square",
    rounded_sql(
        f"""FROM (SELECT chi2, dof, {_TAIL} AS p_value FROM (SELECT sum(n * n / x) - sum(n) AS chi2, (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS dof FROM e))""",
        "chi2 p_value", "dof", digits=6, ctes=f"{CATALOGUE_SQL}, {LONG_SQL}, {DAY_PHASE}"),
)
def phase_test(spark, folder):
    return rounded(phase_by_class(events_catalogue(spark, folder), long_drivers(spark, folder)), 6)


_BY_ORBIT = f"""{CATALOGUE_SQL}, {LONG_SQL}, {DAY_PHASE.replace('SELECT ADIAG AS r', 'SELECT ORBIT AS g, ADIAG AS r').replace('GROUP BY 1, 2)', 'GROUP BY 1, 2, 3)').replace(
    'SELECT r, c, n,', 'SELECT g, r, c, n,').replace('PARTITION BY r)', 'PARTITION BY g, r)').replace('PARTITION BY c)', 'PARTITION BY g, c)').replace('OVER ()', 'OVER (PARTITION BY g)')}"""


@query(
    "phase_chi_square_by_orbit",
    rounded_sql(
        f"""FROM (SELECT ORBIT, chi2, dof, {_TAIL} AS p_value FROM (SELECT g AS ORBIT, sum(n * n / x) - sum(n) AS chi2,
        (count(DISTINCT r) - 1) * (count(DISTINCT c) - 1) AS dof FROM e GROUP BY 1))""", "chi2 p_value", "dof", "ORBIT", digits=6, ctes=_BY_ORBIT),
)
def phase_tests(spark, folder):
    """The same test for every orbit, in one plan."""
    rows = events_with_phase(events_catalogue(spark, folder), long_drivers(spark, folder))
    return rounded(chi_square_independence(rows, "ADIAG", "phase", ["ORBIT"]), 6)


# --- scoring from a given bundle ------------------------------------------------------------------
_GIVEN = {  # feature: (median, mean, deviation, weight)
    "Bz_gsm_lag1h": (0.0, -0.5, 4.0, -0.8), "Bz_gsm_rmean24h": (0.5, 0.0, 2.0, -0.3), "Dst_lag3h": (-25.0, -26.0, 3.0, -0.4), "flow_speed_rmean6h": (395.0, 400.0, 80.0, 0.5),
    "AE_lag1h": (1.0, 2.0, 3.0, 0.2), "phase_main": (0.0, 0.3, 0.5, 0.6), "doy_sin": (0.0, 0.0, 0.7, 0.1),
}
_CURVE, _INTERCEPT, _MARGIN = [(0.1, 0.05), (0.3, 0.2), (0.45, 0.45), (0.6, 0.45), (0.9, 0.8)], -0.4, 0.1


def given_bundle(spark) -> Bundle:
    """A bundle of fixed weights."""
    panel = FittedPanel([(f, i, *values[:3]) for i, (f, values) in enumerate(_GIVEN.items())])
    fit = LinearFit(tuple(_GIVEN), tuple(v[3] for v in _GIVEN.values()), _INTERCEPT)
    return Bundle(panel, c.fitted("logit", fit), IsotonicCurve(spark.createDataFrame(_CURVE, "score double, value double")), _MARGIN, CONFIG)


def _scored_sql(source: str, keep: str) -> str:
    terms = " + ".join(f"{w} * (coalesce({f}, {median}) - {mean}) / {std}" for f, (median, mean, std, w) in _GIVEN.items())
    bends = " ".join(f"WHEN p_raw < {b} THEN {v} + (p_raw - {a}) / ({b} - {a}) * ({u} - {v})" for (a, v), (b, u) in zip(_CURVE, _CURVE[1:]))
    return f"""(SELECT {keep}, p_raw, p, CASE WHEN abs(p - 0.5) < {_MARGIN} THEN 'ABSTAIN' WHEN p >= 0.5 THEN 'ALERT' ELSE 'NO ALERT' END AS decision FROM (
      SELECT *, CASE WHEN p_raw < {_CURVE[0][0]} THEN {_CURVE[0][1]} {bends} ELSE {_CURVE[-1][1]} END AS p FROM (
        SELECT {keep}, 1 / (1 + exp(-({_INTERCEPT} + {terms}))) AS p_raw FROM {source})))"""


@query(
    "batch_score_given",
    rounded_sql(f"FROM {_scored_sql('daily', 'date')}", "p_raw p", texts="date decision", digits=6, ctes=f"{LONG_SQL}, {daily_panel_sql(PANEL_DRIVERS, 'long_drivers')}"),
)
def batch_given(spark, folder):
    """Every day of the drivers scored and decided by a bundle of fixed weights."""
    return rounded(given_bundle(spark).score(daily_features(long_drivers(spark, folder), CONFIG)), 6)


_SCENARIO_SQL = """(SELECT event_id AS scenario_id, value - 50.0 AS Bz_gsm_lag1h, value - 50.0 AS Bz_gsm_rmean24h, -value AS Dst_lag3h, value * 10.0 AS flow_speed_rmean6h,
  CAST(NULL AS DOUBLE) AS AE_lag1h, CAST(-value <= -30 AS INTEGER) AS phase_main, sin(2 * pi() * extract(doy FROM ts) / 366.0) AS doy_sin FROM events)"""


@query("scenario_score_given", rounded_sql(f"FROM {_scored_sql(_SCENARIO_SQL, 'scenario_id')}", "p_raw p", "scenario_id", "decision", digits=6))
def scenario_given(spark, folder):
    scenarios = table(spark, folder, "events").select(
        F.col("event_id").alias("scenario_id"), (F.col("value") - 50.0).alias("Bz_gsm"), (F.col("value") * 10.0).alias("flow_speed"),
        (-F.col("value")).alias("Dst"), F.dayofyear("ts").alias("doy"))
    return rounded(score_scenarios(scenarios, given_bundle(spark)), 6)


# --- density clusters by recursive spreading ------------------------------------------------------
_DENSE = """pts AS (SELECT c_custkey AS id, c_acctbal / 100.0 AS x, CAST(c_nationkey AS DOUBLE) AS y FROM customer),
  near AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON abs(a.x - b.x) <= 1.3 AND abs(a.y - b.y) <= 1.3 AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 1.2),
  core AS (SELECT a AS id FROM near GROUP BY a HAVING count(*) >= 6),
  links AS (SELECT near.a, near.b FROM near JOIN core ca ON ca.id = near.a JOIN core cb ON cb.id = near.b),
  spread AS (SELECT id, id AS root FROM core UNION SELECT links.b, spread.root FROM spread JOIN links ON links.a = spread.id),
  own AS (SELECT id, min(root) AS root FROM spread GROUP BY id),
  reached AS (SELECT DISTINCT near.b AS id FROM near JOIN core ON core.id = near.a)"""


@query(
    "dbscan_customers",
    f"""WITH RECURSIVE {_DENSE} SELECT pts.id AS c_custkey, CAST(reached.id IS NULL AS BIGINT) AS noise, (SELECT count(DISTINCT root) FROM own) AS n_clusters
    FROM pts LEFT JOIN reached USING (id)""",
)
def dense_customers(spark, folder):
    """Customers in the plane of balance and nation: which are noise, and how many density clusters the others form."""
    points = table(spark, folder, "customer").select("c_custkey", (F.col("c_acctbal") / 100.0).alias("x"), F.col("c_nationkey").cast("double").alias("y"))
    found = settled(dbscan(points, ["x", "y"], 1.2, 6))
    clusters = found.agg(F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"))
    return found.select("c_custkey", (F.col("cluster") < 0).cast("bigint").alias("noise")).join(F.broadcast(clusters))  # one row
