"""K-means of many starts and numbers of clusters side by side: one pass over the rows for a step of all of them.

Starting centres are drawn by k-means||: a first row at random, two rounds that take a row with a chance of ``2 k`` times its share of the
cost, and a weighted K-means++ of these few candidates on the driver. A pass adds up, for every fit that still moves, sums and counts
of its clusters, whose size hangs on clusters and features alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from dayrisk.operators.linear import vectors
from dayrisk.operators.many_fits import added
from dayrisk.session import settled

MAX_STEPS = 100
TOLERANCE = 1e-4
ROUNDS = 2
#: Steps of K-means on the candidates of a start.
LOCAL_STEPS = 30
SLICE = 2048


@dataclass(frozen=True)
class Centres:
    """Centres of a fit and the sum of squared distances to them that its last step saw."""

    features: tuple[str, ...]
    centres: tuple[tuple[float, ...], ...]
    cost: float

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        """Add the nearest centre's number; the first of equally near ones."""
        x = vector_to_array("_x")
        far = F.array(*[sum(((F.get(x, F.lit(i)) - F.lit(c)) ** 2 for i, c in enumerate(centre)), F.lit(0.0)) for centre in self.centres])
        rows = VectorAssembler(inputCols=list(self.features), outputCol="_x").transform(df).withColumn("_far", far)
        return rows.select(*df.columns, (F.array_position("_far", F.array_min("_far")) - 1).cast("int").alias(out))


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre and the squared distance to it."""
    at, far = np.empty(len(x), np.int64), np.empty(len(x))
    for i in range(0, len(x), SLICE):
        gap = x[i : i + SLICE, None, :] - centres[None, :, :]
        square = (gap * gap).sum(axis=2)
        at[i : i + SLICE] = square.argmin(axis=1)
        far[i : i + SLICE] = square.min(axis=1)
    return at, far


def uniform(rows: np.ndarray, seed: int, step: int) -> np.ndarray:
    """A number in [0, 1) for every row, the same wherever the row is read."""
    with np.errstate(over="ignore"):
        x = rows.astype(np.uint64) + np.uint64((seed * 1_000_003 + step + 1) * 0x9E3779B97F4A7C15 % 2**64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53


def local_centres(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Weighted K-means++ and a few steps of K-means on rows that fit on the driver; all of them if there are ``k`` at most."""
    if len(points) <= k:
        return points
    rng = np.random.default_rng(seed)
    weights = np.maximum(weights, 1e-12)
    centres = points[[rng.choice(len(points), p=weights / weights.sum())]]
    while len(centres) < k:
        chance = weights * nearest(points, centres)[1]
        if not chance.sum() > 0:
            break
        centres = np.vstack([centres, points[rng.choice(len(points), p=chance / chance.sum())]])
    before = None
    for _ in range(LOCAL_STEPS):
        at = nearest(points, centres)[0]
        if before is not None and (at == before).all():
            break
        before = at
        for j in np.unique(at):
            centres[j] = np.average(points[at == j], axis=0, weights=weights[at == j])
    return centres


def many_means(df: DataFrame, features: Sequence[str], ks: Sequence[int], starts: int, seed: int) -> list[Centres]:
    """For each of ``ks`` the cheapest of ``starts`` fits. A null or NaN feature is an error, as is a table without rows.

    A fit ends when no centre moves by more than TOLERANCE, after MAX_STEPS at the latest; a cluster without rows keeps its centre.
    """
    rows = settled(vectors(df, features, []).select(vector_to_array("features").alias("x"), F.monotonically_increasing_id().alias("row")))
    fits = [(k, seed + i) for k in ks for i in range(starts)]

    def over(make: Callable[[np.ndarray, np.ndarray], np.ndarray | None], schema: str) -> DataFrame:
        """``make(x, rows)`` of every batch as bytes."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                    made = make(x, batch.column("row").to_numpy(zero_copy_only=False))
                    if len(made):
                        yield pa.RecordBatch.from_arrays([pa.array([made.tobytes()], pa.binary())], names=[schema.split()[0]])

        return rows.mapInArrow(run, schema)

    def drawn(make: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
        """The few rows ``(fit, x)`` that ``make`` picks."""
        return np.concatenate([np.frombuffer(r["picked"]) for r in over(make, "picked binary").collect()] or [np.empty(0)]).reshape(-1, len(features) + 1)

    def first(x: np.ndarray, row: np.ndarray) -> np.ndarray:
        least = [uniform(row, seed + i, 0) for i in range(starts)]
        return np.array([[u.min(), *x[u.argmin()]] for u in least]).reshape(1, starts, -1)

    found = np.concatenate([np.frombuffer(r["picked"]) for r in over(first, "picked binary").collect()] or [np.empty(0)]).reshape(-1, starts, len(features) + 1)
    if not len(found):
        raise ValueError("no rows to fit")
    candidates = [found[found[:, i, 0].argmin(), i, 1:][None, :] for _ in ks for i in range(starts)]
    for step in range(1, ROUNDS + 1):
        now = list(candidates)
        costs = added(over(lambda x, row: np.array([nearest(x, c)[1].sum() for c in now]), "sums binary"))

        def picked(x: np.ndarray, row: np.ndarray, step: int = step, now: list = now, costs: np.ndarray = costs) -> np.ndarray:
            out = [np.empty((0, x.shape[1] + 1))]
            for f, ((k, own), c) in enumerate(zip(fits, now)):
                took = x[uniform(row, own, step) * costs[f] < 2 * k * nearest(x, c)[1]]
                out.append(np.column_stack([np.full(len(took), float(f)), took]))
            return np.concatenate(out)

        more = drawn(picked)
        candidates = [np.unique(np.vstack([c, more[more[:, 0] == f, 1:]]), axis=0) for f, c in enumerate(candidates)]
    sizes = [len(c) for c in candidates]
    near = added(over(lambda x, row: np.concatenate([np.bincount(nearest(x, c)[0], minlength=len(c)).astype(float) for c in candidates]), "sums binary"))
    weights = np.split(near, np.cumsum(sizes)[:-1])
    centres = [local_centres(c, w, k, own) for (k, own), c, w in zip(fits, candidates, weights)]
    cost, todo = np.full(len(fits), np.inf), list(range(len(fits)))
    for _ in range(MAX_STEPS):
        if not todo:
            break
        now = [centres[f] for f in todo]

        def sums(x: np.ndarray, row: np.ndarray, now: list = now) -> np.ndarray:
            out = []
            for c in now:
                at, far = nearest(x, c)
                inside = (at[:, None] == np.arange(len(c))).astype(float)
                out += [[far.sum()], inside.sum(0), (inside.T @ x).ravel()]
            return np.concatenate(out)

        total, at, on = added(over(sums, "sums binary")), 0, []
        for f in todo:
            k, width = centres[f].shape
            part, at = total[at : at + 1 + k * (1 + width)], at + 1 + k * (1 + width)
            count, summed = part[1 : 1 + k, None], part[1 + k :].reshape(k, width)
            moved = np.where(count > 0, summed / np.maximum(count, 1), centres[f])
            if (((moved - centres[f]) ** 2).sum(1) > TOLERANCE**2).any():
                on.append(f)
            centres[f], cost[f] = moved, part[0]
        todo = on
    best = [min(range(i * starts, (i + 1) * starts), key=lambda f: cost[f]) for i in range(len(ks))]
    return [Centres(tuple(features), tuple(tuple(map(float, c)) for c in centres[f]), float(cost[f])) for f in best]
