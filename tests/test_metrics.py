import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dayrisk.operators import metrics as m
from dayrisk.operators.calibration import conformal_clip, isotonic_fit, isotonic_predict, platt_fit, platt_predict
from dayrisk.operators.folds import holdout_cut
from dayrisk.operators.linear import balanced_weights, fit_elastic_net, fit_lasso, fit_logit, fit_ols, fit_ridge
from dayrisk.operators.order_stats import date_order, exact_quantiles, first_best, hashed_sample, row_positions, running_sums
from dayrisk.operators.ransac import fit_ransac
from dayrisk.operators.significance import chi_square_independence, chi_square_tail, likelihood_ratio
from dayrisk.operators import order_stats


def scored(n=400, seed=0, ties=True):
    rng = np.random.default_rng(seed)
    p = rng.random(n)
    if ties:
        p = np.round(p, 2)
    p[:5] = [0.0, 1.0, 0.5, 0.3, 0.7]
    y = (rng.random(n) < p * 0.6).astype(int)
    return y, p


def frame(spark, y, p, **more):
    return spark.createDataFrame(pd.DataFrame({"y": y.astype(int), "p": p, **more}))


def cells(y, yhat):
    return ((y == 1) & (yhat == 1)).sum(), ((y == 0) & (yhat == 1)).sum(), ((y == 1) & (yhat == 0)).sum(), ((y == 0) & (yhat == 0)).sum()


def tss(y, yhat):
    tp, fp, fn, tn = cells(y, yhat)
    return (tp / (tp + fn) if tp + fn else 0) - (fp / (fp + tn) if fp + tn else 0)


def auc(y, p):
    gap = p[y == 1][:, None] - p[y == 0][None, :]
    return ((gap > 0).sum() + 0.5 * (gap == 0).sum()) / gap.size


def average_precision(y, p):
    total, before = 0.0, 0
    for s in np.unique(p)[::-1]:
        chosen = p >= s
        hits = y[chosen].sum()
        total += (hits - before) / y.sum() * hits / chosen.sum()
        before = hits
    return total


def test_skill_scores_and_missing_classes(spark):
    y, p = scored()
    df = frame(spark, y, p).withColumn("yhat", (F.col("p") >= 0.5).cast("int"))
    row = m.skill_scores(df).first()
    tp, fp, fn, tn = cells(y, p >= 0.5)
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (tp, fp, fn, tn)
    assert row["tss"] == pytest.approx(tss(y, p >= 0.5))
    assert row["hss"] == pytest.approx(2 * (tp * tn - fp * fn) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)))
    none = m.skill_scores(df.where("y = 0")).first()
    assert none["hss"] == 0.0 and none["tss"] <= 0.0
    empty = m.skill_scores(df.where("false")).first()
    assert (empty["tss"], empty["hss"]) == (0.0, 0.0)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 7])
@pytest.mark.parametrize("ties", [True, False])
def test_ranking_scores(spark, rows_per_range, ties):
    y1, p1 = scored(300, 1, ties)
    y2, p2 = scored(200, 2, ties)
    df = frame(spark, np.r_[y1, y2], np.r_[p1, p2], model=["a"] * 300 + ["b"] * 200)
    rows = {r["model"]: r for r in m.ranking_scores(df, by=["model"], rows_per_range=rows_per_range).collect()}
    for name, y, p in (("a", y1, p1), ("b", y2, p2)):
        assert rows[name]["roc_auc"] == pytest.approx(auc(y, p), abs=1e-12)
        assert rows[name]["average_precision"] == pytest.approx(average_precision(y, p), abs=1e-12)


def test_one_class_has_no_auc(spark):
    row = m.ranking_scores(frame(spark, np.zeros(4), np.array([0.1, 0.2, 0.2, 0.9]))).first()
    assert row["roc_auc"] is None and row["average_precision"] is None


@pytest.mark.parametrize("rows_per_range", [1_000_000, 5])
def test_running_sums(spark, rows_per_range):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": ["a"] * 40 + ["b"] * 25, "o": np.r_[rng.permutation(40), rng.permutation(25)].astype(float), "v": rng.integers(0, 9, 65)})
    for descending in (False, True):
        got = running_sums(spark.createDataFrame(pdf), "o", ["v"], ["g"], descending, rows_per_range).toPandas()
        assert len(got) == 65
        want = pdf.sort_values("o", ascending=not descending).assign(c=lambda d: d.groupby("g").v.cumsum())
        both = got.merge(want, on=["g", "o"])
        assert (both.cum_v == both.c).all() and (both.all_v == both.groupby("g").v_x.transform("sum")).all()


@pytest.mark.parametrize("rows_per_range", [1_000_000, 10])
def test_row_positions_with_ties_on_one_date(spark, rows_per_range):
    rows = [(dt.date(2020, 1, 1 + (i % 3 == 0)), f"s{i}") for i in range(90)]
    df = spark.createDataFrame(rows, "date date, s string")
    got = row_positions(df, date_order("date", F.xxhash64("s")), ["s"], rows_per_range=rows_per_range).toPandas()
    assert sorted(got.position) == list(range(1, 91)) and set(got["size"]) == {90}
    assert got[got.position <= 60].date.nunique() == 1


@pytest.mark.parametrize("small", [20_000, 10])
@pytest.mark.parametrize("n", [1, 2, 9, 10, 11, 500, 3001])
def test_exact_quantiles(spark, monkeypatch, small, n):
    monkeypatch.setattr(order_stats, "SMALL", small)
    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 4, n).astype(float)})
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([(None, None)], "a double, b double"))
    for fraction, how, numpy_how in ((0.5, "linear", "linear"), (0.9, "higher", "higher")):
        got = {r["feature"]: r["value"] for r in exact_quantiles(df, ["a", "b"], fraction, how).collect()}
        for c in "ab":
            assert got[c] == pytest.approx(np.quantile(pdf[c], fraction, method=numpy_how), abs=1e-12)


def test_quantile_arguments(spark):
    df = spark.createDataFrame([(None,)], "a double")
    with pytest.raises(ValueError):
        exact_quantiles(df, ["a"], 0.5)
    with pytest.raises(ValueError):
        exact_quantiles(df, ["a"], 0.5, "lower")


def test_reliability_and_calibration_error(spark):
    y, p = scored(500, 4)
    p = np.r_[p, [i / 10 for i in range(11)], [-0.2, 1.3]]
    y = np.r_[y, np.ones(11), [0, 1]].astype(int)
    keep = (p < 0.6) | (p >= 0.7)
    y, p = y[keep], p[keep]
    edges = np.linspace(0, 1, 11)
    clipped = np.clip(p, 0, 1)
    place = np.clip(np.digitize(clipped, edges) - 1, 0, 9)
    rows = m.reliability_bins(frame(spark, y, p)).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [int((place == b).sum()) for b in range(10)]
    error = 0.0
    for b, r in enumerate(rows):
        if r["count"]:
            assert r["mean_predicted"] == pytest.approx(clipped[place == b].mean())
            assert r["fraction_positive"] == pytest.approx(y[place == b].mean())
            error += r["count"] / len(y) * abs(r["mean_predicted"] - r["fraction_positive"])
        else:
            assert (r["mean_predicted"], r["fraction_positive"]) == (0.0, 0.0)
    assert m.calibration_error(frame(spark, y, p)).first()["ece"] == pytest.approx(error)
    assert m.reliability_curve(frame(spark, y, p)).count() == sum(r["count"] > 0 for r in rows)
    assert m.calibration_error(frame(spark, y, p).where("false")).first()["ece"] == 0.0


@pytest.mark.parametrize("score", ["tss", "hss"])
def test_risk_coverage_equals_the_loop(spark, score):
    y, p = scored(300, 5)
    rows = m.risk_coverage(frame(spark, y, p), score=score).orderBy("point").collect()
    for r, margin in zip(rows, np.linspace(0, 0.5, 50)):
        kept = np.abs(p - 0.5) >= margin
        assert r["margin"] == margin and r["coverage"] == pytest.approx(kept.mean())
        if len(np.unique(y[kept])) < 2:
            assert r["score"] is None
            continue
        tp, fp, fn, tn = cells(y[kept], p[kept] >= 0.5)
        hss = 2 * (tp * tn - fp * fn) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn))
        assert r["score"] == pytest.approx(tss(y[kept], p[kept] >= 0.5) if score == "tss" else hss)
    assert len(rows) == 50
    with pytest.raises(KeyError):
        m.risk_coverage(frame(spark, y, p), score="f1")


def test_margin_selection(spark):
    curve = spark.createDataFrame([(0.0, 1.0, 0.2), (0.1, 0.8, 0.4), (0.2, 0.6, 0.4), (0.3, 0.4, 0.9), (0.4, 0.7, None)], "margin double, coverage double, score double")
    assert m.select_margin(curve).first()["margin"] == 0.1


def test_threshold_sweep_equals_the_loop(spark):
    y, p = scored(300, 6)
    grid = np.linspace(0.05, 0.95, 91)
    want = [tss(y, p >= t) for t in grid]
    rows = m.threshold_sweep(frame(spark, y, p)).orderBy("threshold").collect()
    np.testing.assert_allclose([r["tss"] for r in rows], want, atol=1e-12)
    assert m.best_threshold(m.threshold_sweep(frame(spark, y, p))).first()["threshold"] == grid[int(np.argmax(want))]


def test_operating_points_and_losses(spark):
    y, p = scored(200, 7)
    rows = {r["point"]: r for r in m.operating_points(frame(spark, y, p), {"half": 0.5, "never": None}).collect()}
    assert rows["never"]["alerts"] == 0 and rows["never"]["recall"] == 0.0 and rows["never"]["precision"] == 0.0
    assert rows["never"]["accuracy"] == pytest.approx(1 - y.mean())
    assert rows["half"]["precision"] == pytest.approx(y[p >= 0.5].mean())
    row = frame(spark, y, p).agg(m.brier(F.col("y"), F.col("p")).alias("b"), m.log_loss(F.col("y"), F.col("p")).alias("l"), m.null_log_loss(F.col("y")).alias("n")).first()
    truth = np.clip(np.where(y == 1, p, 1 - p), 1e-9, 1)
    assert row["b"] == pytest.approx(np.mean((p - y) ** 2)) and row["l"] == pytest.approx(-np.log(truth).mean())
    r = y.mean()
    assert row["n"] == pytest.approx(-(r * math.log(r) + (1 - r) * math.log(1 - r)))


def test_regression_scores(spark):
    rng = np.random.default_rng(8)
    y, q = rng.normal(size=50), rng.normal(size=50)
    row = m.regression_scores(spark.createDataFrame(pd.DataFrame({"y": y, "predicted": q}))).first()
    assert row["r2"] == pytest.approx(1 - ((y - q) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert row["mae"] == pytest.approx(np.abs(y - q).mean())


def test_evaluate_scores_all_models_at_once(spark):
    y, p = scored(200, 9)
    wide = frame(spark, y, p).withColumn("half", F.col("p") / 2)
    rows = {r["model"]: r for r in m.evaluate(m.long_scores(wide, {"full": "p", "half": "half"})).collect()}
    assert rows["full"]["roc_auc"] == pytest.approx(rows["half"]["roc_auc"])
    assert rows["half"]["brier"] == pytest.approx(np.mean((p / 2 - y) ** 2))


def pool(y):
    """Adjacent violators pooled, the textbook way."""
    blocks = []
    for v in y:
        blocks.append([v, 1])
        while len(blocks) > 1 and blocks[-2][0] > blocks[-1][0]:
            (a, n), (b, k) = blocks[-2:]
            blocks[-2:] = [[(a * n + b * k) / (n + k), n + k]]
    return np.concatenate([[v] * n for v, n in blocks])


def test_isotonic_ties_interpolation_and_ends(spark):
    y, p = scored(300, 10)
    curve = isotonic_fit(frame(spark, y, p))
    means = pd.Series(y).groupby(p).agg(["mean", "size"])
    expanded = pool(np.repeat(means["mean"].to_numpy(), means["size"].to_numpy()))
    want = pd.Series(expanded).groupby(np.repeat(means.index.to_numpy(), means["size"].to_numpy())).first()
    asked = spark.createDataFrame([(float(x),) for x in [*want.index, -1.0, 2.0]], "p double")
    got = isotonic_predict(asked, curve).toPandas().set_index("p")["calibrated"]
    np.testing.assert_allclose(got.loc[want.index].to_numpy(), want.to_numpy(), atol=1e-12)
    assert got[-1.0] == pytest.approx(want.iloc[0]) and got[2.0] == pytest.approx(want.iloc[-1])


def newton_logit(x, y, C=1.0, w=None):
    a = np.column_stack([x, np.ones(len(x))])
    beta, w = np.zeros(a.shape[1]), np.ones(len(x)) if w is None else w
    ridge = np.diag([1.0 / C] * x.shape[1] + [0.0])
    for _ in range(50):
        q = 1 / (1 + np.exp(-a @ beta))
        beta -= np.linalg.solve(a.T * (w * q * (1 - q)) @ a + ridge, a.T @ (w * (q - y)) + ridge @ beta)
    return beta


def table(spark, x, y):
    return spark.createDataFrame(pd.DataFrame({f"x{i}": x[:, i] for i in range(x.shape[1])} | {"y": y}))


@pytest.fixture(scope="module")
def regression():
    rng = np.random.default_rng(11)
    x = rng.normal(size=(200, 3)) * [1.0, 4.0, 0.5]
    return x, x @ [2.0, -1.0, 0.0] + 5 + rng.normal(size=200)


def test_logit_is_the_penalised_optimum(spark, regression):
    x, target = regression
    y = (target > 5).astype(int)
    df = table(spark, x, y)
    fit = fit_logit(df, ["x0", "x1", "x2"])
    np.testing.assert_allclose([*fit.weights, fit.intercept], newton_logit(x, y), atol=1e-4)
    weighted = balanced_weights(df.where("x0 > -0.5"))
    keep = x[:, 0] > -0.5
    w = np.where(y[keep] == 1, keep.sum() / (2 * y[keep].sum()), keep.sum() / (2 * (1 - y[keep]).sum()))
    fit = fit_logit(weighted, ["x0", "x1", "x2"], weight="weight")
    np.testing.assert_allclose([*fit.weights, fit.intercept], newton_logit(x[keep], y[keep], w=w), atol=1e-4)


def test_platt_is_a_one_feature_logit(spark):
    y, p = scored(300, 12)
    slope, intercept = platt_fit(frame(spark, y, p))
    np.testing.assert_allclose([slope, intercept], newton_logit(p[:, None], y), atol=1e-5)
    got = frame(spark, y, p).select(platt_predict(F.col("p"), slope, intercept)).first()[0]
    assert got == pytest.approx(1 / (1 + math.exp(-(slope * p[0] + intercept))))


def test_least_squares_family(spark, regression):
    x, y = regression
    df, names, n = table(spark, x, y), ["x0", "x1", "x2"], len(y)
    xc, yc = x - x.mean(0), y - y.mean()
    np.testing.assert_allclose(fit_ols(df, names).weights, np.linalg.lstsq(xc, yc, rcond=None)[0], atol=1e-6)
    ridge = fit_ridge(df, names, alpha=10.0)
    np.testing.assert_allclose(ridge.weights, np.linalg.solve(xc.T @ xc + 10 * np.eye(3), xc.T @ yc), atol=1e-6)
    assert ridge.intercept == pytest.approx(y.mean() - x.mean(0) @ ridge.weights, abs=1e-6)

    def descend(l1, l2):
        w = np.zeros(3)
        for _ in range(3000):
            for j in range(3):
                r = yc - xc @ w + xc[:, j] * w[j]
                c = xc[:, j] @ r / n
                w[j] = np.sign(c) * max(abs(c) - l1, 0) / (xc[:, j] @ xc[:, j] / n + l2)
        return w

    np.testing.assert_allclose(fit_lasso(df, names, alpha=0.1).weights, descend(0.1, 0), atol=1e-4)
    np.testing.assert_allclose(fit_elastic_net(df, names, alpha=0.4, l1_ratio=0.5).weights, descend(0.2, 0.2), atol=1e-4)


def test_ransac_ignores_outliers(spark, regression):
    x, y = regression
    bad = y.copy()
    bad[:60] += 500
    df = table(spark, x, bad).withColumn("id", F.monotonically_increasing_id())
    fit = fit_ransac(df, ["x0", "x1", "x2"], "id", min_samples=10, threshold=5.0)
    np.testing.assert_allclose(fit.weights, [2.0, -1.0, 0.0], atol=0.5)
    with pytest.raises(ValueError):
        fit_ransac(df.limit(5), ["x0"], "id")


def test_conformal_clip(spark):
    df = spark.createDataFrame([(0.0,), (0.4,), (1.0,)], "p double")
    assert [r[0] for r in df.select(conformal_clip(F.col("p"), 0.6)).collect()] == [0.3, 0.4, 0.7]


def test_chi_square(spark):
    # tail values from published tables
    for x, k, p in ((3.841, 1, 0.05), (5.991, 2, 0.05), (7.815, 3, 0.05), (9.488, 4, 0.05), (11.070, 5, 0.05), (18.307, 10, 0.05)):
        assert chi_square_tail(x, k) == pytest.approx(p, abs=2e-5)
    assert chi_square_tail(0.0, 3) == 1.0
    rows = [("a", "x")] * 10 + [("a", "y")] * 20 + [("b", "x")] * 30 + [("b", "y")] * 5
    row = chi_square_independence(spark.createDataFrame(rows, "r string, c string"), "r", "c").first()
    obs = np.array([[10, 20], [30, 5]])
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    assert row["dof"] == 1 and row["chi2"] == pytest.approx((((np.abs(obs - exp) - 0.5) ** 2) / exp).sum())
    rows += [("c", "x")] * 7
    row = chi_square_independence(spark.createDataFrame(rows, "r string, c string"), "r", "c").first()
    obs = np.array([[10, 20], [30, 5], [7, 0]])
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    assert row["dof"] == 2 and row["chi2"] == pytest.approx((((obs - exp) ** 2) / exp).sum())
    assert likelihood_ratio(100, 0.5, 0.48, 2) == (pytest.approx(4.0), pytest.approx(math.exp(-2)))


def test_top_one_and_sample(spark):
    df = spark.createDataFrame([(1, 0.2), (2, 0.9), (3, 0.9), (4, None)], "id int, score double")
    assert first_best(df, "score", F.col("id")).first()["id"] == 2
    one, two = (sorted(r["id"] for r in hashed_sample(spark.range(1000), "id", 100, s).collect()) for s in (1, 1))
    assert one == two and len(set(one)) == 100
    assert one != sorted(r["id"] for r in hashed_sample(spark.range(1000), "id", 100, 2).collect())


@pytest.mark.parametrize("rows_per_range", [2, 5])
def test_null_and_nan_keys_are_the_same_at_every_size(spark, rows_per_range):
    rows = [(i, None if i % 5 == 0 else float("nan") if i % 7 == 0 else float(i % 9)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, v double")
    place = lambda n: {r["id"]: (r["position"], r["size"]) for r in row_positions(df, F.col("v"), ["id"], rows_per_range=n).collect()}
    small, whole = place(rows_per_range), place(1_000_000)
    assert small == whole and sorted(p for p, _ in whole.values()) == list(range(1, 41))
    sums = df.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    total = lambda n: sorted(map(str, running_sums(sums, "v", ["n"], rows_per_range=n).collect()))
    assert total(rows_per_range) == total(1_000_000) and len(total(rows_per_range)) == sums.count()


def test_holdout_of_one_date_does_not_depend_on_the_layout(spark):
    rows = [(dt.date(2020, 1, 1) if i % 10 else None, i) for i in range(500)]
    df = spark.createDataFrame(rows, "date date, id int")
    cut = lambda frame: {r["id"] for r in holdout_cut(frame).where("part = 'fit'").collect()}
    assert cut(df.repartition(7)) == cut(df.repartition(2, "id")) and len(cut(df)) == 400
    one = holdout_cut(df.repartition(5))
    assert one.where("part = 'fit'").join(one.where("part = 'calibrate'"), "id").isEmpty()


def test_evaluate_keeps_null_and_unscored_groups(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.2), (None, 1, 0.7), (None, 0, 0.1), ("b", 1, None)], "model string, y int, p double")
    rows = {r["model"]: r for r in m.evaluate(df).collect()}
    assert set(rows) == {"a", None, "b"} and rows[None]["roc_auc"] == 1.0 and rows["b"]["roc_auc"] is None


def test_curves_of_an_empty_table_and_uneven_thresholds(spark):
    empty = spark.createDataFrame([], "y int, p double")
    assert all(r["coverage"] is None for r in m.risk_coverage(empty).collect())
    df = spark.createDataFrame([(1, 0.1), (0, 0.1), (1, 0.115), (0, 0.5), (1, 0.95)], "y int, p double")
    for r in m.threshold_sweep(df, thresholds=[0.1, 0.11, 0.12, 0.9]).collect():
        said = [(y, p >= r["threshold"]) for y, p in df.collect()]
        assert r["tss"] == pytest.approx(sum(a for y, a in said if y) / 3 - sum(a for y, a in said if not y) / 2)


def test_ranks_inside_a_bracket_are_split_over_ranges(spark):
    df = spark.range(3000).select((F.col("id") % 997).cast("double").alias("v"))
    wide = df.selectExpr("v")
    found = order_stats.select_ranks(wide, ["v"], [(3000, 0.0, 996.0)], 0.5, "linear", rows_per_range=50)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan and found.first()["value"] == float(np.median(df.toPandas()["v"]))
