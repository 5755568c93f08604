"""Robust regression by random consensus: many small fits, one pass to judge them all."""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from dayrisk.constants import SEED
from dayrisk.operators.linear import LinearFit, fit_ols


#: Draws order the rows by ((key mod P) * a + b) mod P, with a and b of the trial's own: products stay below 2 ** 62.
P = 2_147_483_647
#: Candidates of one trial from so many groups of partitions are brought together last.
GROUPS = 64


def trial_order(trials: int, seed: int) -> list[tuple[int, int]]:
    """``(a, b)`` of every trial."""
    draw = random.Random(seed)
    return [(draw.randrange(1, P), draw.randrange(P)) for _ in range(trials)]


def draw_rows(df: DataFrame, key: str, values: Sequence[str], m: int, trials: int, seed: int) -> DataFrame:
    """``(trial, key, values...)``: for every trial the ``m`` rows that its order puts first, ties by the key and the values.

    One pass over the rows: a partition keeps ``m`` candidates for each trial, and candidates are cut to ``m`` again wherever they meet, so
    no pool is drawn and no task sees more than its share.
    """
    order, names = np.array(trial_order(trials, seed), np.int64), list(values)
    kind = df.select(*names).dtypes
    schema = "trial int, grp int, place long, k long, " + ", ".join(f"`{n}` {t}" for n, t in kind)
    columns = ["trial", "grp", "place", "k", *names]

    def first(rows: pd.DataFrame, place: np.ndarray) -> np.ndarray:
        if len(place) > m:
            near = np.flatnonzero(place <= np.partition(place, m - 1)[m - 1])
        else:
            near = np.arange(len(place))
        ties = [rows[n].to_numpy()[near] for n in ["k", *names]]
        return near[np.lexsort((*reversed(ties), place[near]))][:m]

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group = TaskContext.get().partitionId() % GROUPS
        kept: list[pd.DataFrame | None] = [None] * trials
        for batch in batches:
            at = np.mod(batch["k"].to_numpy(np.int64), P)
            for t, (a, b) in enumerate(order):
                place = (at * a + b) % P
                own = first(batch, place)
                new = batch.iloc[own].assign(place=place[own])
                if kept[t] is not None:
                    new = pd.concat([kept[t], new], ignore_index=True)
                    new = new.iloc[first(new, new["place"].to_numpy())]
                kept[t] = new
        for t, rows in enumerate(kept):
            if rows is not None:
                yield rows.assign(trial=np.int32(t), grp=np.int32(group))[columns]

    def cut(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.iloc[first(rows, rows["place"].to_numpy())][columns]

    keyed = df.select(F.col(key).cast("long").alias("k"), *names).where("k IS NOT NULL")
    found = keyed.mapInPandas(candidates, schema).groupBy("trial", "grp").applyInPandas(cut, schema).groupBy("trial").applyInPandas(cut, schema)
    return found.select("trial", F.col("k").alias(key), *names)


def fit_ransac(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    y: str = "y",
    min_samples: int | None = None,
    threshold: float = 20.0,
    trials: int = 200,
    seed: int = SEED,
) -> LinearFit:
    """Least squares on the largest consensus set.

    Every trial fits on its own draw of ``min_samples`` rows (see :func:`draw_rows`; ``key`` is a whole number). One distributed pass then
    counts the inliers of all trials over all rows, and the inliers of the best trial (smaller error on ties) give the final fit.
    """
    features = list(features)
    m = min_samples or max(50, len(features) + 1)
    rows = df.select(key, *features, y).dropna()

    def fit(trial: pd.DataFrame) -> pd.DataFrame:
        x = np.column_stack([np.ones(len(trial)), trial[features].to_numpy(dtype=float)])
        weights = np.linalg.lstsq(x, trial[y].to_numpy(dtype=float), rcond=None)[0]
        return pd.DataFrame({"trial": [trial["trial"].iloc[0]], "n": [len(trial)], "weights": [weights.tolist()]})

    fits = draw_rows(rows, key, [*features, y], m, trials, seed).groupBy("trial").applyInPandas(fit, "trial int, n int, weights array<double>")
    found = fits.orderBy("trial").collect()  # one short row per trial
    if not found or found[0]["n"] < m:
        raise ValueError(f"{found[0]['n'] if found else 0} rows, a trial needs {m}")
    models = [r["weights"] for r in found]
    best = models[_best_trial(rows, features, y, np.array(models), threshold)]
    chosen = LinearFit(tuple(features), tuple(best[1:]), best[0])
    return fit_ols(rows.where(F.abs(F.col(y) - chosen.score()) <= F.lit(threshold)), features, y)


def _best_trial(rows: DataFrame, features: Sequence[str], y: str, models: np.ndarray, threshold: float) -> int:
    names, target = list(features), y

    def judge(batches):
        for batch in batches:
            x = np.column_stack([np.ones(len(batch)), batch[names].to_numpy(dtype=float)])
            error = np.abs(batch[target].to_numpy(dtype=float)[:, None] - x @ models.T)
            inside = error <= threshold
            yield pd.DataFrame(
                {
                    "trial": np.arange(len(models)),
                    "inliers": inside.sum(axis=0),
                    "squares": np.where(inside, error**2, 0.0).sum(axis=0),
                }
            )

    judged = (
        rows.select(*names, target)
        .mapInPandas(judge, "trial int, inliers bigint, squares double")
        .groupBy("trial")
        .agg(F.sum("inliers").alias("inliers"), F.sum("squares").alias("squares"))
        .orderBy(F.desc("inliers"), "squares", "trial")
        .first()
    )
    return judged["trial"]
