"""Many fits by the same passes: Newton steps, trees, isotonic curves, tail probabilities."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dayrisk.operators import classifiers as c
from dayrisk.operators import isotonic, many_fits, ransac, trees
from dayrisk.operators.linear import fit_logits
from dayrisk.operators.significance import chi_square_independence, chi_square_tail, chi_square_tails
from dayrisk.plans import study


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    n = 600
    x = rng.normal(size=(n, 4))
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(y=((x[:, 0] ** 2 + x[:, 1] ** 2 + 0.3 * x[:, 2]) > 1.5).astype(int), g=rng.integers(0, 3, n), id=range(n))
    return spark.createDataFrame(pdf).repartition(3, "id").persist()


def plain_newton(x, y, w, C, loss):
    a = np.column_stack([x, np.ones(len(x))])
    beta, ridge = np.zeros(a.shape[1]), np.append(np.ones(x.shape[1]), 0)
    for _ in range(200):
        _, slope, bend = loss((a @ beta)[:, None], y)
        gradient = C * a.T @ (w * slope[:, 0]) + ridge * beta
        step = np.linalg.solve(C * (a.T * (w * bend[:, 0])) @ a + np.diag(ridge) + 1e-9 * np.eye(len(beta)), gradient)
        beta = beta - step * (0.5 if loss is many_fits.squared_hinge else 1)
    return beta


@pytest.mark.parametrize("loss", ["logistic", "hinge"])
def test_all_fits_are_their_own_optimum(rows, loss):
    pdf = rows.toPandas()
    weights = [F.lit(1.0), (F.col("g") != 1).cast("double"), F.when(F.col("y") == 1, 3.0).when(F.col("g") == 0, 0.5)]
    strengths = [1.0, 0.01, 2.0]
    got = many_fits.newton(many_fits.fit_rows(rows, list("abcd"), "y", weights), 3, strengths, loss)
    own = [np.ones(len(pdf)), (pdf.g != 1).to_numpy(float), np.where(pdf.y == 1, 3.0, np.where(pdf.g == 0, 0.5, 0.0))]
    for (beta, intercept), w, C in zip(got, own, strengths):
        want = plain_newton(pdf[list("abcd")].to_numpy(), pdf.y.to_numpy(float), w, C, many_fits.LOSSES[loss])
        np.testing.assert_allclose([*beta, intercept], want, atol=1e-6)


def test_a_step_of_all_fits_is_one_job(spark, rows):
    fitted = many_fits.fit_rows(rows, list("abcd"), "y", [(F.col("g") != k).cast("double") for k in range(3)] * 4)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("newton", "newton")
    many_fits.newton(fitted, 12)
    jobs = len(tracker.getJobIdsForGroup("newton"))
    spark.sparkContext.setJobGroup("other", "other")
    assert 3 <= jobs <= 15


def test_fits_without_rows_and_partial_sums(spark, rows, monkeypatch):
    with pytest.raises(ValueError):
        fit_logits(rows, ["a"], "y", [F.lit(1.0), F.lit(0.0)])
    with pytest.raises(ValueError):
        fit_logits(rows.where("false"), ["a"], "y", [F.lit(1.0)])
    want = fit_logits(rows, ["a", "b"], "y", [F.lit(1.0)])[0]
    monkeypatch.setattr(many_fits, "PARTS", 2)
    many = many_fits.newton(many_fits.fit_rows(rows.repartition(9), ["a", "b"], "y", [F.lit(1.0)]), 1)
    np.testing.assert_allclose(many[0][0], want.weights, atol=1e-8)


def gini_tree(x, y, w, deepest=64):
    """The best split of each node by looking at every one."""
    if deepest == 0 or (w * y).sum() in (0, w.sum()):
        return (w * y).sum() / w.sum()
    best = (1e-9, None, None)
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            left = x[:, f] <= cut
            gain = sum((w[m] * y[m]).sum() ** 2 / w[m].sum() for m in (left, ~left) if w[m].sum()) - (w * y).sum() ** 2 / w.sum()
            if gain > best[0] * (1 + 1e-9):
                best = (gain, f, cut)
    if best[1] is None:
        return (w * y).sum() / w.sum()
    left = x[:, best[1]] <= best[2]
    return (best[1], best[2], gini_tree(x[left], y[left], w[left], deepest - 1), gini_tree(x[~left], y[~left], w[~left], deepest - 1))


def test_a_local_tree_is_the_greedy_tree():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 30, (120, 3)).astype(np.uint8)
    y = (rng.random(120) < x[:, 0] / 40 + 0.1).astype(float)
    w = rng.integers(0, 4, 120).astype(float)
    tree = trees.grow_local(x, w * y, w, np.arange(3), 3, 7).arrays()
    want = gini_tree(x[w > 0], y[w > 0], w[w > 0])

    def follow(node, row):
        while isinstance(node, tuple):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node

    got = tree["value"][trees.walk(tree, x, tree["cut"])]
    np.testing.assert_allclose(got[w > 0], [follow(want, r) for r in x[w > 0]])


def test_trees_split_by_passes_equal_trees_grown_in_a_task(rows, monkeypatch):
    members = [F.lit(True), F.col("g") != 2]
    x = rows.toPandas()[list("abcd")].to_numpy()
    local = trees.grow_forests(rows, list("abcd"), "y", members, trees=3, balanced=False)
    monkeypatch.setattr(trees, "LOCAL_ROWS", 90)
    passes = trees.grow_forests(rows, list("abcd"), "y", members, trees=3, balanced=False)
    for a, b in zip(local, passes):
        assert len(a.threshold) == len(b.threshold)
        np.testing.assert_allclose(a.probability(x), b.probability(x))


def test_forests_of_members_and_sets(rows):
    alone = c.forest(rows.where("g <> 0"), list("abcd"), "y", trees=8)
    one, two = c.forests(rows, list("abcd"), "y", [F.lit(True), F.col("g") != 0], trees=8)
    narrow, wide = c.forests_of_sets(rows, [["a"], list("abcd")], "y", trees=8)
    scores = [m.score(rows).where("g = 0").toPandas() for m in (alone, two, narrow, wide)]
    auc = [study.ranking_scores(rows.sparkSession.createDataFrame(s), "y").first()["roc_auc"] for s in scores]
    assert min(auc[0], auc[1], auc[3]) > 0.85 and auc[3] > auc[2]
    assert set(narrow.model.nodes["feature"]) <= {-1, 0}


def test_drawn_rows_and_features():
    times = trees.drawn(np.arange(20_000), 3)
    assert abs(times.mean() - 1) < 0.03 and abs((times == 0).mean() - math.exp(-1)) < 0.02
    slots = trees.feature_draw(np.arange(1, 2001, dtype=np.uint64), 9, np.arange(20), 4)
    assert all(len(set(r)) == 4 for r in slots.tolist()) and abs(np.bincount(slots.ravel(), minlength=20) / 400 - 1).max() < 0.25


def test_boosting_lowers_the_loss_every_round(rows):
    x, y = (lambda p: (p[list("abcd")].to_numpy(), p.y.to_numpy()))(rows.toPandas())
    losses = []
    for rounds in (1, 5, 40):
        p = np.clip(trees.grow_boosted(rows, list("abcd"), "y", [F.lit(True)], rounds)[0].probability(x), 1e-9, 1 - 1e-9)
        losses.append(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))
    assert losses[0] > losses[1] > losses[2]


def test_ensembles_survive_storing(spark, rows):
    model = trees.grow_forests(rows, list("abcd"), "y", [F.lit(True)], trees=3)[0]
    again = trees.TreeEnsemble.of_table(spark.createDataFrame(model.table()).toPandas(), model.features, model.base)
    x = np.vstack([rows.toPandas()[list("abcd")].to_numpy(), np.full((1, 4), np.inf)])
    np.testing.assert_array_equal(model.probability(x), again.probability(x))


def plain_curve(p, y):
    d = pd.DataFrame({"p": p, "y": y}).groupby("p").y.agg(["size", "sum"]).reset_index()
    blocks = isotonic.pool(d["size"].to_numpy(float), d["sum"].to_numpy(float))
    ends = np.array([(d.p[i], s / w) for first, last, w, s in blocks for i in (first, last)])
    return lambda x: np.interp(x, ends[:, 0], ends[:, 1])


@pytest.mark.parametrize("kind, n, size", [("noise", 900, 250), ("down", 900, 200), ("up", 500, 120), ("wave", 800, 180)])
def test_curves_pooled_in_ranges_equal_plain_pooling(spark, kind, n, size):
    rng = np.random.default_rng(n)
    p = np.round(rng.random(n), 3 if kind != "up" else 6)
    q = {"noise": p, "down": 1 - p, "up": p, "wave": 0.5 + 0.5 * np.sin(9 * p)}[kind]
    y = (rng.random(n) < q).astype(float) if kind != "up" else p
    g = rng.integers(0, 2, n)
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": y, "g": g})).unionByName(spark.createDataFrame([(None, 1.0, 0), (0.5, None, 1)], "p double, y double, g long"))
    blocks = isotonic.pooled_blocks(df, by=["g"], rows_per_range=size).toPandas().sort_values("lo")
    x = np.linspace(-0.1, 1.1, 2000)
    for k in (0, 1):
        own = blocks[blocks.g == k]
        assert (np.diff(own.s / own.w) >= -1e-12).all() and own.w.sum() == (g == k).sum()
        ends = np.stack([own[["lo", "hi"]].to_numpy().ravel(), np.repeat((own.s / own.w).to_numpy(), 2)], 1)
        np.testing.assert_allclose(np.interp(x, ends[:, 0], ends[:, 1]), plain_curve(p[g == k], y[g == k])(x), atol=1e-12)


def test_looked_up_and_joined_curves_agree(spark):
    rng = np.random.default_rng(8)
    p = np.round(rng.random(400), 3)
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": (rng.random(400) < p).astype(int)}))
    curve = isotonic.isotonic_curve(df)
    asked = spark.createDataFrame([(float(x),) for x in np.linspace(-0.5, 1.5, 333)] + [(float(x),) for x in p[:20]] + [(None,), (float("nan"),)], "p double")
    one = curve.predict(asked, "p", "v").toPandas()
    two = isotonic.IsotonicCurve(curve.table, 0)._joined(asked, "p", "v", rows_per_range=40).toPandas()
    a, b = (t.dropna().drop_duplicates().sort_values("p") for t in (one, two))
    np.testing.assert_allclose(a.v, b.v, atol=1e-12)
    np.testing.assert_allclose(a.v, plain_curve(p, df.toPandas().y.to_numpy())(a.p), atol=1e-12)
    assert one.v.isna().sum() == two.v.isna().sum() == 2 and len(two) == len(one)
    assert isotonic.isotonic_curve(df.where("false")).predict(asked, "p", "v").where("v is not null").count() == 0


def test_many_distinct_scores_stay_off_the_driver(spark):
    scores = spark.range(1_000_000).select((F.col("id") / 1e6).alias("p"), (F.xxhash64("id") % 1000 / 2000 + 0.5 < F.col("id") / 1e6).cast("int").alias("y"))
    blocks = isotonic.pooled_blocks(scores, rows_per_range=300_000)
    mean = F.col("s") / F.col("w")
    told = blocks.agg(F.sum("w").alias("w"), F.sum("s").alias("s"), F.count(F.lit(1)).alias("n")).first()
    assert told["w"] == 1_000_000 and told["s"] == scores.agg(F.sum("y")).first()[0] and told["n"] < 100_000
    values = [r["m"] for r in blocks.orderBy("lo").select(mean.alias("m")).collect()]
    assert values == sorted(values)


@pytest.mark.parametrize("dof", [1, 2, 3, 4, 9, 10, 51])
def test_tails_as_columns(spark, dof):
    x = [0.0, 1e-9, 0.1, dof / 2, float(dof), dof + 2.0, 2.0 * dof, 5.0 * dof + 10]
    got = [r[0] for r in spark.createDataFrame([(v, dof) for v in x], "x double, d int").select(chi_square_tails("x", "d")).collect()]
    np.testing.assert_allclose(got, [chi_square_tail(v, dof) for v in x], rtol=1e-10)


def test_grouped_tests_equal_single_ones(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 500), "r": rng.choice(list("xyz"), 500), "c": rng.choice(list("uv"), 500)})
    pdf.loc[pdf.g == "b", "r"] = rng.choice(list("xy"), (pdf.g == "b").sum())
    df = spark.createDataFrame(pdf, "g string, r string, c string")
    for row in chi_square_independence(df, "r", "c", ["g"]).collect():
        one = chi_square_independence(df.where(F.col("g").eqNullSafe(F.lit(row["g"]))), "r", "c").first()
        assert tuple(row)[1:] == pytest.approx(tuple(one))


@pytest.mark.parametrize("fit", [c.logit, c.calibrated_logit, lambda df, f, y: c.forest(df, f, y, trees=5)])
def test_models_of_all_folds_together(spark, fit):
    rng = np.random.default_rng(0)
    n = 300
    x = rng.normal(size=(n, 2))
    pdf = pd.DataFrame({"date": pd.date_range("2020-01-01", periods=n).date, "x0": x[:, 0], "x1": x[:, 1], "target": (x[:, 0] + rng.normal(size=n) > 0).astype(int)})
    df = spark.createDataFrame(pdf)
    auc = study.cross_validated_auc(df, ["x0", "x1"], fit, splits=3)
    assert 0.6 < auc < 1


def test_averaged_logits_by_matrices_equal_joined_ones(rows):
    rows = rows.withColumn("day", F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")))
    model = c.calibrated_logit(rows, list("abcd"), "y", date="day").model
    one, two = model.score(rows).select("id", "p").toPandas(), model._joined(rows).select("id", "p").toPandas()
    np.testing.assert_allclose(one.sort_values("id").p, two.sort_values("id").p, atol=1e-12)


def test_draws_are_the_first_rows_of_every_trials_order(spark):
    keys = [int(k) for k in np.random.default_rng(3).integers(-(2**62), 2**62, 500)] + [5, 5, 5, 9]
    df = spark.createDataFrame([(k, float(i)) for i, k in enumerate(keys)], "key long, v double").repartition(7)
    got = ransac.draw_rows(df, "key", ["v"], 12, 30, 4).toPandas()
    for t, (a, b) in enumerate(ransac.trial_order(30, 4)):
        want = sorted(keys, key=lambda k: ((k % ransac.P * a + b) % ransac.P, k))[:12]
        assert sorted(got[got.trial == t].key) == sorted(want)
    assert ransac.draw_rows(df.where("key = 9"), "key", ["v"], 12, 2, 4).count() == 2
