import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dayrisk.functions.scalars import decide
from dayrisk.operators import classifiers as c
from dayrisk.operators import clusters, density
from dayrisk.operators.components import connected_components
from dayrisk.operators.metrics import ranking_scores
from dayrisk.plans import study
from dayrisk.plans.baselines import climatology, persistence
from dayrisk.plans.hypotheses import next_day_odds, phase_by_class, regimes_beyond_index
from dayrisk.plans.panel import FittedPanel, PanelConfig, daily_features, fit_panel
from dayrisk.plans.scoring import rows_for_dates, scenario_rows, score_dates, score_scenarios
from dayrisk.sources.bundle import Bundle
from dayrisk.sources.run_metrics import append_metrics, long_metrics, read_metrics
from dayrisk.streaming.daily import score_closed_days, stream_daily

FEATURES = ["x0", "x1"]


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(0)
    n = 400
    x = rng.normal(size=(n, 2))
    y = ((x**2).sum(1) + 0.3 * x[:, 0] > 1.8).astype(int)
    dates = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(n)]
    fold = ["train"] * 250 + ["val"] * 75 + ["test"] * 75
    pdf = pd.DataFrame({"date": dates, "fold": fold, "target": y, "x0": x[:, 0], "x1": x[:, 1]})
    return spark.createDataFrame(pdf).coalesce(2).persist()


def quick_forest(df, features, y):
    return c.forest(df, features, y, trees=20)


@pytest.mark.parametrize("fit", [
    quick_forest,
    lambda df, f, y: c.boosting(df, f, y, rounds=10),
    lambda df, f, y: c.kernel_machine(df, f, y, components=64),
])
def test_nonlinear_models_find_the_ring(panel, fit):
    model = fit(study.in_fold(panel, "train"), FEATURES, "target")
    scored = model.score(study.in_fold(panel, "val"))
    assert scored.columns == [*panel.columns, "p"]
    low, high = scored.selectExpr("min(p)", "max(p)").first()
    assert 0 <= low <= high <= 1
    assert ranking_scores(scored, "target").first()["roc_auc"] > 0.85


def test_calibrated_logit_averages_folds(panel):
    model = c.calibrated_logit(study.in_fold(panel, "train"), FEATURES, "target")
    assert len(model.model) == 5
    low, high = model.score(panel).selectExpr("min(p)", "max(p)").first()
    assert 0 <= low <= high <= 1


def test_time_series_auc_and_selection(spark, panel):
    auc = study.cross_validated_auc(study.in_fold(panel, "train"), FEATURES, quick_forest, splits=3)
    assert 0.7 < auc <= 1.0
    table = study.compare_models(panel, FEATURES, {"forest": quick_forest, "logit": c.logit}, cv=False)
    assert table.count() == 2 and study.select_model(table) == "forest"
    steps = study.ablation(panel, {"one": ["x0"], "two": FEATURES}, quick_forest)
    assert {r["feature_set"]: r["n_cols"] for r in steps.collect()} == {"one": 1, "two": 2}


def test_locked_test(spark, panel):
    labels = panel.select("date", (F.col("target") == 1).alias("any_environmental"))
    test = study.LockedTest(panel, labels, FEATURES, quick_forest)
    rows = {r["model"]: r for r in test.report().collect()}
    assert rows["climatology"]["tss"] == 0.0 and rows["climatology"]["roc_auc"] == 0.5
    assert rows["persistence"]["roc_auc"] is None and rows["persistence"]["tss"] > 0.9  # here target = same-day label
    assert rows["model"]["roc_auc"] > 0.8
    assert test.operating_points().count() == 3 and 0.05 <= test.threshold() <= 0.95 and 0 <= test.margin() <= 0.5
    scores = study.calibrations(panel, FEATURES, quick_forest)
    assert {r["model"] for r in study.calibration_table(scores).collect()} == {"raw", "platt", "isotonic", "conformal"}


def test_headline_chain_and_validation_table(spark, panel):
    labels = panel.select("date", (F.col("target") == 1).alias("any_environmental"))
    fits = {"logit": c.logit, "forest": quick_forest}
    assert study.headline_model(panel, FEATURES, fits) == "forest"
    chain = study.LockedTest.of_best(panel, labels, FEATURES, fits)
    assert chain.model.name == "forest" and chain.report().count() == 3
    rows = {r["model"]: r for r in study.validation_table(panel, labels, FEATURES, quick_forest).collect()}
    assert rows["climatology"]["tss"] == 0.0 and rows["persistence"]["roc_auc"] is None and rows["model"]["roc_auc"] > 0.8


def test_cluster_table(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(k, 0.2, (60, 2)) for k in (0, 5)])
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(target=[0] * 60 + [1] * 60))
    axes = ["a", "b"]
    table = {r["method"]: r for r in study.cluster_table(df, axes, {
        "kmeans": lambda rows: clusters.assign(rows, clusters.kmeans(rows, axes, 2, starts=2), axes), "dbscan": lambda rows: density.dbscan(rows, axes, 1.0, 5),
        "one": lambda rows: rows.withColumn("cluster", F.lit(0))}).collect()}
    assert all(table[m]["n_clusters"] == 2 and table[m]["pos_rate_spread"] == 1.0 and table[m]["silhouette"] > 0.9 for m in ("kmeans", "dbscan"))
    assert table["one"]["n_clusters"] == 1 and table["one"]["silhouette"] is None


def test_regressors(panel):
    rows = panel.withColumn("y", F.col("x0") * 3 + F.col("x1"))
    table = {r["model"]: r for r in study.regressor_table(rows, FEATURES, ransac_threshold=1.0).collect()}
    assert set(table) == {"OLS", "Ridge", "Lasso", "ElasticNet", "Poly(2)+Ridge", "RANSAC"}
    assert table["OLS"]["r2"] == pytest.approx(1.0) and table["RANSAC"]["r2"] == pytest.approx(1.0)


def test_baselines(spark):
    days = spark.createDataFrame([(dt.date(2020, 1, d),) for d in (1, 2, 3)], "date date")
    labels = spark.createDataFrame([(dt.date(2020, 1, 1), True), (dt.date(2020, 1, 2), False)], "date date, y boolean")
    assert [r["predicted"] for r in persistence(days, labels, "y").orderBy("date").collect()] == [1, 0, 0]
    assert {r["p"] for r in climatology(days, labels, "y").collect()} == {0.5}


def brute(x, eps, least):
    close = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core = close.sum(1) >= least
    label, found = np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            todo, label[i] = [i], found
            while todo:
                u = todo.pop()
                for v in np.flatnonzero(close[u] & core & (label < 0)):
                    label[v] = found
                    todo.append(v)
            found += 1
    reach = {i: set(label[np.flatnonzero(close[i] & core)]) for i in np.flatnonzero(~core)}
    return core, label, reach, found


@pytest.mark.parametrize("d, eps, least, size", [(3, 0.5, 20, 10_000), (2, 0.3, 10, 25)])
def test_dbscan_equals_brute_force(spark, monkeypatch, d, eps, least, size):
    monkeypatch.setattr(density, "SLICE", size)
    rng = np.random.default_rng(d)
    x = np.concatenate([
        *[rng.normal(k, 0.25, (120, d)) for k in (0, 2, 4)], rng.uniform(-2, 6, (150, d)),
        np.repeat(rng.normal(0, 1, (3, d)), 40, axis=0),  # many copies of a place
        rng.normal(1, 0.05, (300, d)),  # one crowded cell
    ])
    names = [f"f{i}" for i in range(d)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=range(len(x))))
    df = df.unionByName(spark.createDataFrame([(None,) * d + (len(x),)], df.schema))
    out = density.dbscan(df, names, eps, least).toPandas().sort_values("id").cluster.to_numpy()
    assert out[-1] == -1
    out = out[:-1]
    core, label, reach, found = brute(x, eps, least)
    names_of = dict(zip(label[core], out[core]))
    assert len(names_of) == found and sorted(names_of.values()) == list(range(found))
    assert (out[core] == [names_of[v] for v in label[core]]).all()
    for i, near in reach.items():
        assert out[i] == (min(names_of[v] for v in near) if near else -1)


def test_components_close_long_chains(spark):
    order = np.random.default_rng(1).permutation(300).tolist()
    edges = [(order[i], order[i + 1]) for i in range(299) if i != 150] + [(1000, 1001)]
    nodes = spark.createDataFrame([(v,) for v in [*range(300), 1000, 1001, 2000]], "node bigint")
    got = {r["node"]: r["label"] for r in connected_components(nodes, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    first, second = min(order[:151]), min(order[151:])
    assert all(got[v] == first for v in order[:151]) and all(got[v] == second for v in order[151:])
    assert (got[1001], got[2000]) == (1000, 2000)


def test_projection_and_clusters(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 4)) @ rng.normal(size=(4, 4)) + 3
    x[:75] += 40
    names = [f"f{i}" for i in range(4)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(id=range(150), y=[1] * 75 + [0] * 75))
    fit = clusters.fit_pca(df, names)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    np.testing.assert_allclose(fit.shares, values[::-1][:3] / values.sum(), atol=1e-9)
    got = fit.transform(df, ["id", "y"]).orderBy("id").toPandas()
    want = (x - x.mean(0)) @ vectors[:, ::-1][:, :3]
    np.testing.assert_allclose(np.abs(got[["pc1", "pc2", "pc3"]]), np.abs(want), atol=1e-8)
    axes = ["pc1", "pc2", "pc3"]
    for model in (clusters.kmeans(fit.transform(df, ["id", "y"]), axes, 2, starts=2), clusters.bisecting(fit.transform(df, ["id"]), axes, 2)):
        found = clusters.assign(fit.transform(df, ["id", "y"]), model, axes)
        assert clusters.rate_spread(found).first()["pos_rate_spread"] == 1.0


@pytest.mark.parametrize("block", [2048, 13])
def test_silhouette(spark, block):
    rng = np.random.default_rng(3)
    x, k = rng.normal(size=(90, 2)), rng.integers(-1, 3, 90)
    k[0] = 7
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    score = []
    for i in range(90):
        own = k == k[i]
        if own.sum() == 1:
            score.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, k == j].mean() for j in set(k) - {k[i]})
        score.append((b - a) / max(a, b))
    df = spark.createDataFrame(pd.DataFrame({"id": range(90), "a": x[:, 0], "b": x[:, 1], "cluster": k}))
    row = clusters.silhouette_exact(df, ["a", "b"], block_rows=block).first()
    assert row["silhouette"] == pytest.approx(np.mean(score)) and row["n_clusters"] == 4
    assert clusters.silhouette_exact(df.where("cluster in (-1, 0)"), ["a", "b"]).first()["silhouette"] is None


def hours(spark, n_days=60, seed=4):
    rng = np.random.default_rng(seed)
    n = n_days * 24
    names = ["Bz_gsm", "flow_speed", "proton_density", "flow_pressure", "Dst", "AE", "Kp_real"]
    pdf = pd.DataFrame({"ts": pd.date_range("2020-01-01", periods=n, freq="h")} | {c: rng.normal(0, 25, n) for c in names})
    labels = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=n_days).date, "any_environmental": rng.random(n_days) < 0.4})
    return spark.createDataFrame(pdf), spark.createDataFrame(labels)


def test_hypotheses(spark):
    hourly, labels = hours(spark)
    row = next_day_odds(hourly, labels).first()
    assert row["n"] == 59 and 0 <= row["p_value"] <= 1
    events = labels.select(F.col("date").alias("anomaly_date"), F.when(F.col("any_environmental"), "ESD").otherwise("SEU").alias("ADIAG"))
    assert 0 <= phase_by_class(events, hourly, 20).first()["p_value"] <= 1
    rows = regimes_beyond_index(hourly, labels, ks=(3,), starts=2).collect()
    assert [r["dof"] for r in rows] == [2]


@pytest.mark.parametrize("fit", [
    c.logit, quick_forest, c.calibrated_logit, lambda df, f, y: c.boosting(df, f, y, rounds=5), lambda df, f, y: c.kernel_machine(df, f, y, components=32),
])
def test_bundle_round_trip_and_scoring(spark, tmp_path, fit):
    hourly, labels = hours(spark)
    config = PanelConfig(drivers=("Bz_gsm", "Dst"), block_days=20)
    daily = daily_features(hourly, config)
    rows = daily.join(labels.select("date", F.col("any_environmental").cast("int").alias("target")), "date").withColumn(
        "fold", F.when(F.col("date") < "2020-02-15", "train").otherwise("test"))
    features = [f for f in daily.columns if f != "date"]
    fitted = fit_panel(rows.where("fold = 'train'"), features)
    scaled = fitted.transform(rows, ["date", "fold", "target"])
    test = study.LockedTest(scaled, labels, features, fit)
    bundle = Bundle(fitted, test.model, test.curve, 0.05, config)
    path = str(tmp_path / "bundle")
    with pytest.raises(FileNotFoundError):
        Bundle.load(spark, path)
    bundle.save(spark, path)
    loaded = Bundle.load(spark, path)
    assert loaded.margin == 0.05 and loaded.panel.params == fitted.params
    dates = spark.createDataFrame([(dt.date(2020, 2, 28),), (dt.date(2020, 2, 29),), (dt.date(2031, 1, 1),)], "date date")
    before = score_dates(hourly, dates, bundle, config).orderBy("date").collect()
    after = score_dates(hourly, dates, loaded).orderBy("date").collect()
    with pytest.raises(ValueError):
        score_dates(hourly, dates, loaded, PanelConfig(drivers=("Bz_gsm", "Dst"), block_days=20, gap_mode="time"))
    assert [r["date"].day for r in after] == [28, 29]  # the last day is scored, an absent day has no row
    for a, b in zip(before, after):
        assert b["p"] == pytest.approx(a["p"]) and a["decision"] == b["decision"]
    assert rows_for_dates(hourly, dates, config).count() == 2
    scenarios = spark.createDataFrame([(1, -20.0, -50.0, 80), (2, 5.0, 10.0, 200)], "scenario_id int, Bz_gsm double, Dst double, doy int")
    made = {r["scenario_id"]: r for r in scenario_rows(scenarios, features).collect()}
    assert made[1]["Bz_gsm_lag24h"] == -20.0 and made[1]["Bz_gsm_rstd6h"] is None
    assert (made[1]["phase_main"], made[1]["phase_quiet"], made[2]["phase_quiet"], made[1]["phase_recovery"]) == (1.0, 0.0, 1.0, 0.0)
    assert score_scenarios(scenarios, loaded).where("p is not null").count() == 2


def test_run_metrics_append(spark, tmp_path):
    path = str(tmp_path / "runs")
    scores = spark.createDataFrame([("a", 0.5, None)], "model string, tss double, roc_auc double")
    for run in ("r1", "r2"):
        append_metrics(long_metrics(scores, run, "val", ["tss", "roc_auc"]), path)
    assert {(r["run_id"], r["metric"], r["value"]) for r in read_metrics(spark, path).collect()} == {("r1", "tss", 0.5), ("r2", "tss", 0.5)}


def test_stream_of_hours(spark, tmp_path):
    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    hourly, _ = hours(spark, 3)
    hourly.coalesce(1).write.parquet(source)
    stream = spark.readStream.schema(hourly.schema).parquet(source)
    daily = stream_daily(stream, {"dst_mean": F.avg("Dst")})
    scored = lambda batch: batch.withColumn("decision", decide(F.lit(0.9), 0.1))
    query = score_closed_days(daily, scored, sink, str(tmp_path / "state"))
    query.awaitTermination(120)
    got = spark.read.parquet(sink).orderBy("date").collect()
    want = hourly.groupBy(F.to_date("ts").alias("date")).agg(F.avg("Dst").alias("m")).orderBy("date").collect()
    assert [r["date"] for r in got] == [w["date"] for w in want[:2]]  # the last day is still open
    assert [r["dst_mean"] for r in got] == pytest.approx([w["m"] for w in want[:2]])


def test_locked_test_and_dates_with_two_series(spark):
    rng = np.random.default_rng(4)
    days = pd.date_range("2020-01-01", periods=120)
    rows = [(s, d.date(), "train" if i < 70 else "val" if i < 95 else "test", float(x), int(x + rng.normal() > 0)) for s in "ab" for i, d in enumerate(days) for x in [rng.normal()]]
    panel = spark.createDataFrame(rows, "series string, date date, fold string, x double, target int")
    labels = panel.select("series", "date", (F.col("series") == "a").alias("any_environmental"))
    test = study.LockedTest(panel, labels, ["x"], lambda df, f, y: c.logit(df, f, y), keys=["series"])
    assert test.scores("test").count() == 50 and test.scores("test").columns == ["series", "date", "y", "p"]
    said = persistence(study.in_fold(panel, "test").select("series", "date"), labels, "any_environmental", ["series"])
    assert said.count() == 50 and said.where("predicted = 1").select("series").distinct().collect()[0][0] == "a"
    assert test.report().count() == 3


def test_scenarios_of_one_file_are_dealt_over_the_cores(spark):
    class Noted:
        panel = FittedPanel([("Dst_lag1h", 0, 0.0, 0.0, 1.0)])

        def score(self, rows, keep):
            return rows.withColumn("task", F.spark_partition_id())

    scenarios = spark.range(4000, numPartitions=1).selectExpr("id AS scenario_id", "CAST(-id AS DOUBLE) AS Dst", "80 AS doy")
    rows = score_scenarios(scenarios, Noted()).collect()
    tasks = [sum(r["task"] == t for r in rows) for t in {r["task"] for r in rows}]
    assert sum(tasks) == 4000 and len({r["scenario_id"] for r in rows}) == 4000
    assert len(tasks) >= spark.sparkContext.defaultParallelism and max(tasks) <= 2 * 4000 / len(tasks)
