"""K-means of many starts in shared passes."""

import numpy as np
import pytest

from dayrisk.operators import clusters
from dayrisk.operators.many_means import many_means


def blobs(spark, centres, n=60, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(f"{j}", *map(float, c + rng.normal(0, 0.3, 2))) for j, c in enumerate(np.asarray(centres, float)) for _ in range(n)]
    return spark.createDataFrame(rows, "blob string, a double, b double").repartition(5)


def test_all_starts_share_their_passes(spark):
    df = blobs(spark, [(0, 0), (5, 0), (0, 5), (6, 6)])
    spark.sparkContext.setJobGroup("means", "means")
    try:
        model = many_means(df, ["a", "b"], [4], 20, 7)[0]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("means")) < 60  # twenty fits apart are hundreds
    pairs = {(r["blob"], r["cluster"]) for r in clusters.assign(df, model, ["a", "b"]).collect()}
    assert len(pairs) == 4 and len({c for _, c in pairs}) == 4


def test_centres_are_the_means_of_their_rows(spark):
    df = blobs(spark, [(0, 0), (5, 0), (0, 5), (6, 6)])
    models = many_means(df, ["a", "b"], [2, 3, 4], 10, 7)
    assert [len(m.centres) for m in models] == [2, 3, 4] and models[0].cost > models[1].cost > models[2].cost
    for model in models:
        rows = clusters.assign(df, model, ["a", "b"]).toPandas()
        means = rows.groupby("cluster")[["a", "b"]].mean().to_numpy()
        assert np.allclose(means, model.centres, atol=1e-6)
        assert np.isclose(((rows[["a", "b"]].to_numpy() - means[rows["cluster"]]) ** 2).sum(), model.cost)


def test_few_points_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 9 + [(3.0, 4.0)], "a double, b double")
    assert sorted(many_means(df, ["a", "b"], [3], 4, 1)[0].centres) == [(1.0, 2.0), (3.0, 4.0)]
    with pytest.raises(ValueError):
        many_means(df.where("a > 5"), ["a", "b"], [3], 4, 1)


def test_close_rows_far_from_the_origin_keep_their_distance():
    x = np.random.default_rng(2).normal(size=(300, 8)) * 1e-4 + 1000
    x[:5] = x[5]
    exact = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    assert np.allclose(clusters.plain_distances(x, x), exact, rtol=1e-9, atol=0)
