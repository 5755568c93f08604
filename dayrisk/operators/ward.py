"""Hierarchical clusters by Ward's criterion on clustering features.

A clustering feature is the count and the sums of a set of points; two of them add up, and the cost of merging two sets follows from them
alone. Points fall into the cells of a tree that halves the range of every axis at each level; the deepest level with at most ``leaves``
cells gives the features that are merged, and a table with at most so many distinct points is merged point by point, which is exact.
Only these features, a bounded number, are merged in one place; rows take the label of their cell.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, functions as F

from dayrisk.session import settled

LEAVES = 2_000
DEEPEST = 16


def ward_merges(n: np.ndarray, centres: np.ndarray) -> list[tuple[int, int, float]]:
    """All merges ``(a, b, cost)`` of sets with ``n`` points each, by chains of nearest neighbours; a merged set goes on under the number ``a``.

    The cost is the growth of the sum of squared distances from the centres. Merges are not in order of cost.
    """
    n, centres = n.astype(float).copy(), centres.astype(float).copy()
    gap = ((centres[:, None] - centres[None]) ** 2).sum(2)
    cost = gap * (n[:, None] * n[None]) / (n[:, None] + n[None])
    np.fill_diagonal(cost, np.inf)
    alive, chain, out = np.ones(len(n), bool), [], []
    while alive.sum() > 1:
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        a = chain[-1]
        row = np.where(alive, cost[a], np.inf)
        row[a] = np.inf
        b = int(row.argmin())
        if len(chain) > 1 and row[chain[-2]] <= row[b]:  # the one before is as near: a pair of nearest neighbours
            b = chain[-2]
            chain = chain[:-2]
            a, b = min(a, b), max(a, b)
            out.append((a, b, float(cost[a, b])))
            centres[a] = (n[a] * centres[a] + n[b] * centres[b]) / (n[a] + n[b])
            n[a] += n[b]
            alive[b] = False
            cost[a] = cost[:, a] = ((centres - centres[a]) ** 2).sum(1) * n * n[a] / (n + n[a])
            cost[a, a] = np.inf
        else:
            chain.append(b)
    return out


def cut(merges: list[tuple[int, int, float]], size: int, k: int) -> np.ndarray:
    """Labels of ``size`` sets after all but the ``k - 1`` dearest merges; labels go by the smallest number in a cluster."""
    parent = np.arange(size)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b, _ in sorted(merges, key=lambda m: m[2])[: max(0, size - k)]:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    roots = [root(i) for i in range(size)]
    number = {r: j for j, r in enumerate(sorted(set(roots)))}
    return np.array([number[r] for r in roots])


def ward_clusters(df: DataFrame, features: Sequence[str], k: int = 5, out: str = "cluster", leaves: int = LEAVES) -> DataFrame:
    """Add the number of the row's cluster, -1 for a row with a null feature.

    Costs that are equal to the last bit may be merged in either order; copies of a point are one point with more weight. With fewer than
    ``k`` distinct points every one is a cluster.
    """
    names = list(features)
    axes = [f"_x{i}" for i in range(len(names))]
    whole = F.lit(True)
    for c in names:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    points = settled(df.where(whole).groupBy(*[(F.col(c).cast("double") + 0.0).alias(a) for c, a in zip(names, axes)]).agg(F.count(F.lit(1)).alias("_n")))
    keys = axes
    if points.count() > leaves:
        ends = points.agg(*[f(a).alias(f"{s}{a}") for a in axes for f, s in ((F.min, "lo"), (F.max, "hi"))]).first()
        cell = lambda level: [_cell(a, ends[f"lo{a}"], ends[f"hi{a}"], level).alias(f"_c{a}") for a in axes]
        keys = [f"_c{a}" for a in axes]
        deep = settled(points.select(*cell(DEEPEST)).distinct())
        at = lambda level: F.array(*[F.shiftright(F.col(c), DEEPEST - level) for c in keys])
        counts = deep.agg(*[F.count_distinct(at(level)).alias(f"n{level}") for level in range(DEEPEST + 1)]).first()
        level = max(v for v in range(DEEPEST + 1) if counts[f"n{v}"] <= leaves)
        keyed = points.select("*", *cell(level))
    else:
        keyed = points
    sums = [F.sum(F.col("_n") * F.col(a)).alias(f"s{a}") for a in axes]
    found = keyed.groupBy(*keys).agg(F.sum("_n").alias("n"), *sums).orderBy(*keys).collect()  # at most ``leaves`` rows
    if not found:
        return df.withColumn(out, F.lit(-1))
    n = np.array([r["n"] for r in found], float)
    centres = np.array([[r[f"s{a}"] for a in axes] for r in found]) / n[:, None]
    labels = cut(ward_merges(n, centres), len(n), k)
    named = [(*[r[c] for c in keys], int(label)) for r, label in zip(found, labels)]
    table = df.sparkSession.createDataFrame(named, ", ".join(f"{c} {'double' if keys is axes else 'long'}" for c in keys) + f", `{out}` int")
    rows = df.withColumns({a: F.when(whole, F.col(c).cast("double") + 0.0) for c, a in zip(names, axes)})
    if keys is not axes:
        rows = rows.select("*", *cell(level))
    return rows.join(F.broadcast(table), keys, "left").select(*df.columns, F.coalesce(out, F.lit(-1)).alias(out))


def _cell(axis: str, low: float, high: float, level: int):
    width = (high - low) / 2**DEEPEST or 1.0
    place = F.least(F.floor((F.col(axis) - F.lit(low)) / F.lit(width)), F.lit(2**DEEPEST - 1)).cast("long")
    return F.shiftright(place, DEEPEST - level)
