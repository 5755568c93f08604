"""Ward's clusters against merging the cheapest pair again and again."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dayrisk.operators import ward


def plain(x, k):
    sets = [[i] for i in range(len(x))]

    def cost(a, b):
        pa, pb = x[a].mean(0), x[b].mean(0)
        return len(a) * len(b) / (len(a) + len(b)) * ((pa - pb) ** 2).sum()

    while len(sets) > k:
        _, i, j = min((cost(a, b), i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i < j)
        sets[i] += sets.pop(j)
    return {frozenset(s) for s in sets}


def partition(labels):
    return {frozenset(np.flatnonzero(labels == v).tolist()) for v in set(labels.tolist())}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("k", [1, 3, 5])
def test_chains_of_neighbours_give_the_greedy_clusters(seed, k):
    x = np.random.default_rng(seed).normal(size=(40, 3))
    assert partition(ward.cut(ward.ward_merges(np.ones(40), x), 40, k)) == plain(x, k)


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(c, 0.5, (20, 2)) for c in (0, 3, 6)])
    x = np.concatenate([x, x[:5]])  # copies
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]).assign(id=range(len(x)))).unionByName(spark.createDataFrame([(None, 1.0, len(x))], "a double, b double, id long"))
    got = ward.ward_clusters(df.repartition(3), ["a", "b"], 4).toPandas().sort_values("id").cluster.to_numpy()
    assert got[-1] == -1 and partition(got[:-1]) == plain(x, 4)
    assert ward.ward_clusters(df.where("id < 3"), ["a", "b"], 5).select("cluster").distinct().count() == 3
    assert ward.ward_clusters(df.where("a is null"), ["a", "b"]).first()["cluster"] == -1


def test_large_tables_merge_a_bounded_number_of_cells(spark):
    rows = spark.range(60_000).select(
        (F.randn(1) + 8 * (F.col("id") % 3)).alias("a"), (F.randn(2) - 8 * (F.col("id") % 3)).alias("b"), (F.col("id") % 3).alias("own")).cache()
    found = ward.ward_clusters(rows, ["a", "b"], 3, leaves=300)
    table = found.groupBy("own", "cluster").count().toPandas()
    assert found.count() == 60_000 and table.groupby("own")["count"].max().sum() > 59_400 and table.cluster.nunique() == 3
