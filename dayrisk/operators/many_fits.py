"""Many penalised linear classifiers fitted side by side: one pass over the rows for each Newton step of all of them.

A fit is a column of row weights (0: the row is not in it), so folds, slices and members of one model are fits over the same
rows. A pass adds up, for every fit, loss, gradient and the weighted Gram matrix of its rows; their size hangs on the number of
features alone. Partial sums of partitions are added in groups before the driver adds the last few and takes the step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dayrisk.session import settled

MAX_STEPS = 60
TOLERANCE = 1e-9
#: Partial sums that the driver adds at most in one step; more are added in groups by Spark first.
PARTS = 64


def logistic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-loss, its slope and its curvature in the score."""
    mu = 1 / (1 + np.exp(-np.clip(score, -700, 700)))
    return np.logaddexp(0, score) - y[:, None] * score, mu - y[:, None], mu * (1 - mu)


def squared_hinge(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half the squared distance from the margin, its slope and its curvature."""
    sign = (2 * y - 1)[:, None]
    short = np.maximum(0, 1 - sign * score)
    return short**2 / 2, -sign * short, (short > 0).astype(float)


LOSSES = {"logistic": logistic, "hinge": squared_hinge}


def _sums(x: np.ndarray, y: np.ndarray, weights: np.ndarray, beta: np.ndarray, loss: Callable) -> np.ndarray:
    """For each fit its loss, gradient and Gram matrix, one after the other."""
    with np.errstate(over="ignore"):
        value, slope, bend = loss(x @ beta.T, y)
    grams = [(x * (weights[:, k] * bend[:, k])[:, None]).T @ x for k in range(len(beta))]
    return np.concatenate([(weights * value).sum(0)[:, None], (weights * slope).T @ x, np.stack(grams).reshape(len(beta), -1)], 1)


def added(parts: DataFrame, most: int = PARTS) -> np.ndarray:
    """Element-wise sum of the arrays ``sums`` of all rows; the driver gets ``most`` rows at most."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column("sums"):
                part = np.frombuffer(raw.as_buffer(), np.float64)
                total = part.copy() if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    size = parts.rdd.getNumPartitions()
    while size > most:
        size = max(1, size // most)
        parts = parts.coalesce(size).mapInArrow(add, "sums binary")
    rows = [np.frombuffer(r["sums"], np.float64) for r in parts.collect()]
    if not rows:
        raise ValueError("no rows to fit")
    return np.sum(rows, 0)


@dataclass
class _State:
    beta: np.ndarray
    trial: np.ndarray
    step: np.ndarray
    scale: float = 1.0
    value: float = np.inf
    done: bool = False


def fit_rows(df: DataFrame, features: Sequence[str] | Column, y: str | Column, weights: Sequence[Column], parts: int | None = None) -> DataFrame:
    """Settled ``(x, y, w)``: what :func:`newton` passes over. ``features`` are columns or one array column; null weights are 0."""
    x = features if isinstance(features, Column) else F.array(*[F.col(f"`{f}`").cast("double") for f in features])
    label = F.col(y) if isinstance(y, str) else y
    rows = df.select(x.alias("x"), label.cast("double").alias("y"), F.array(*[F.coalesce(w.cast("double"), F.lit(0.0)) for w in weights]).alias("w"))
    return settled(rows if parts is None else rows.repartition(parts))


def newton(
    rows: DataFrame, fits: int, C: float | Sequence[float] = 1.0, loss: str = "logistic", project: Callable[[np.ndarray], np.ndarray] | None = None
) -> list[tuple[np.ndarray, float]]:
    """Minimise ``C * sum(w * loss) + |coefficients|^2 / 2`` for every fit, intercept free: ``(coefficients, intercept)`` for each.

    ``project`` maps a matrix of rows to the features of the fits. Steps that do not lower a fit's objective are halved. A fit that has not
    settled after MAX_STEPS is an error, as is one without rows.
    """
    strength = np.broadcast_to(np.asarray(C, float), (fits,))
    calculate = LOSSES[loss]

    def run(beta: np.ndarray | None, todo: list[int]):
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                w = batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)[:, todo]
                x = np.hstack([project(x) if project else x, np.ones((len(x), 1))])
                if beta is None:  # width and weights first
                    part = np.concatenate([[x.shape[1] * len(x)], w.sum(0), [len(x)]])
                else:
                    part = _sums(x, batch.column("y").to_numpy(zero_copy_only=False), w, beta, calculate)
                total = part if total is None else total + part
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total.astype(float).tobytes()], pa.binary())], names=["sums"])

        return added(rows.mapInArrow(sums, "sums binary"))

    first = run(None, list(range(fits)))
    width = round(first[0] / first[-1])
    if (first[1:-1] <= 0).any():
        raise ValueError("no rows to fit")
    ridge = np.append(np.ones(width - 1), 0.0)
    states = [_State(np.zeros(width), np.zeros(width), np.zeros(width)) for _ in range(fits)]
    for _ in range(MAX_STEPS):
        todo = [k for k, s in enumerate(states) if not s.done]
        if not todo:
            break
        sums = run(np.stack([states[k].trial for k in todo]), todo).reshape(len(todo), -1)
        for k, row in zip(todo, sums):
            s, c = states[k], strength[k]
            value = c * row[0] + (ridge * s.trial**2).sum() / 2
            if not value <= s.value + 1e-12 * abs(s.value):  # too far: half the step
                s.scale /= 2
                s.trial = s.beta + s.scale * s.step
                s.done = s.scale < 1e-10
                continue
            s.beta, s.value, s.scale = s.trial, value, 1.0
            gradient = c * row[1 : 1 + width] + ridge * s.beta
            gram = c * row[1 + width :].reshape(width, width) + np.diag(ridge)
            gram[-1, -1] += 1e-12 * (1 + gram[-1, -1])
            s.step = -np.linalg.solve(gram, gradient)
            s.trial = s.beta + s.step
            s.done = bool(np.abs(s.step).max() <= TOLERANCE * (1 + np.abs(s.beta).max()))
    if not all(s.done for s in states):
        raise RuntimeError(f"{sum(not s.done for s in states)} of {fits} fits have not settled after {MAX_STEPS} steps")
    return [(s.beta[:-1], float(s.beta[-1])) for s in states]
