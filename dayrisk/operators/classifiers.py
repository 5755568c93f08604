"""Tree ensembles, logits and a kernel machine, all scored as ``p`` = probability of class 1.

Every model comes in two forms: ``model(df, features, y)`` fits one, ``model.many(df, features, y, members)`` fits one for each condition on
the rows (folds, slices) by the same passes, in the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from dayrisk.constants import SEED
from dayrisk.operators import trees as t
from dayrisk.operators.calibration import isotonic_predict, platt_fit
from dayrisk.operators.folds import stratified_folds
from dayrisk.operators.isotonic import IsotonicCurve, isotonic_curves
from dayrisk.operators.linear import LinearFit, fit_logits, vectors
from dayrisk.operators.many_fits import fit_rows, newton
from dayrisk.session import settled, side_by_side

Scorer = Callable[[DataFrame], DataFrame]  # adds column p


def scorer_of(model, features: Sequence[str]) -> Scorer:
    names = list(features)

    def score(df: DataFrame) -> DataFrame:
        assembled = VectorAssembler(inputCols=names, outputCol="features").transform(df)
        scored = model.transform(assembled)
        return scored.withColumn("p", F.get(vector_to_array("probability"), F.lit(1))).select(*df.columns, "p")

    return score


@dataclass
class Fitted:
    """A fitted model and how to score rows with it."""

    name: str
    model: object
    score: Scorer


def fitted(name: str, model) -> Fitted:
    """Any of the models of this module, ready to score."""
    if isinstance(model, LinearFit):
        return Fitted(name, model, lambda rows: rows.withColumn("p", model.probability()))
    return Fitted(name, model, model.score)


def with_many(many: Callable) -> Callable:
    """Give a function that fits one model its form for many members."""

    def attach(one: Callable) -> Callable:
        one.many = many
        return one

    return attach


def fit_members(fit: Callable, df: DataFrame, features: Sequence[str], y: str, members: Sequence[Column]) -> list[Fitted]:
    """One model for every member; a ``fit`` without a form for many is called for each."""
    if hasattr(fit, "many"):
        return fit.many(df, features, y, members)
    return side_by_side(lambda m: fit(df.where(m), features, y), members)


def forests(df: DataFrame, features: Sequence[str], y: str, members: Sequence[Column], trees: int = 300, balanced: bool = True, seed: int = SEED) -> list[Fitted]:
    return [fitted("forest", m) for m in t.grow_forests(df, features, y, members, trees=trees, balanced=balanced, seed=seed)]


def forests_of_sets(df: DataFrame, sets: Sequence[Sequence[str]], y: str, trees: int = 300, seed: int = SEED) -> list[Fitted]:
    """A forest for every set of features, grown together on the same rows."""
    features = list(dict.fromkeys(f for own in sets for f in own))
    return [fitted("forest", m) for m in t.grow_forests(df, features, y, [F.lit(True)], sets, trees=trees, seed=seed)]


@with_many(forests)
def forest(df: DataFrame, features: Sequence[str], y: str = "y", trees: int = 300, balanced: bool = True, seed: int = SEED) -> Fitted:
    """Random forest of deep trees, square-root feature draws, class-balanced weights."""
    return forests(df, features, y, [F.lit(True)], trees, balanced, seed)[0]


forest.of_sets = forests_of_sets


def boostings(df: DataFrame, features: Sequence[str], y: str, members: Sequence[Column], rounds: int = 200, depth: int = 3, step: float = 0.1) -> list[Fitted]:
    counts = df.agg(*[F.count_if(m).alias(f"n{k}") for k, m in enumerate(members)]).first()
    if max(counts) <= t.LOCAL_ROWS:
        return [fitted("boosting", m) for m in t.grow_boosted(df, features, y, members, rounds, depth, step)]

    def large(member: Column) -> Fitted:
        data = vectors(df.where(member), features, [F.col(y).cast("double").alias("label")])
        model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=step, seed=SEED).fit(data)
        return Fitted("boosting", model, scorer_of(model, features))

    return side_by_side(large, members)


@with_many(boostings)
def boosting(df: DataFrame, features: Sequence[str], y: str = "y", rounds: int = 200, depth: int = 3, step: float = 0.1) -> Fitted:
    """Gradient-boosted shallow trees, unweighted.

    A table of up to LOCAL_ROWS rows is boosted in one task for each member, on binned rows; a larger one by MLlib's distributed rounds.
    """
    return boostings(df, features, y, [F.lit(True)], rounds, depth, step)[0]


def logits(df: DataFrame, features: Sequence[str], y: str, members: Sequence[Column], C: float = 1.0) -> list[Fitted]:
    weights = [F.coalesce(m.cast("double"), F.lit(0.0)) for m in members]
    return [fitted("logit", m) for m in fit_logits(df, features, y, weights, C)]


@with_many(logits)
def logit(df: DataFrame, features: Sequence[str], y: str = "y", C: float = 1.0) -> Fitted:
    return logits(df, features, y, [F.lit(True)], C)[0]


def member_folds(df: DataFrame, y: str, members: Sequence[Column], folds: int, date: str) -> DataFrame:
    """Settled rows of every member, ``member`` by number, with their stratified ``cv_fold`` within it."""
    parts = side_by_side(lambda k: stratified_folds(df.where(members[k]), y, folds, date).withColumn("member", F.lit(k)), range(len(members)))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return settled(out)


def _decisions(features: Sequence[str], table: np.ndarray, project: Callable | None = None):
    """``table[which]`` holds weights and, last, the intercept: a function of the row's features and of ``which``."""

    @F.pandas_udf("double")
    def decide(x: pd.DataFrame, which: pd.Series) -> pd.Series:
        z = x.to_numpy(dtype=float)
        z = np.hstack([project(z) if project else z, np.ones((len(z), 1))])
        return pd.Series(np.einsum("ij,ij->i", z, table[which.to_numpy()]))

    columns = F.struct(*[F.col(f"`{f}`").cast("double") for f in features])
    return lambda which: decide(columns, which)


@dataclass(frozen=True)
class KernelFit:
    """A linear machine on random Fourier features of the Gaussian kernel (Rahimi and Recht, 2007), with Platt scaling."""

    features: tuple[str, ...]
    gamma: float
    components: int
    seed: int
    weights: tuple[float, ...]  # the intercept is last
    slope: float
    intercept: float

    @staticmethod
    def projection(features: int, gamma: float, components: int, seed: int) -> Callable[[np.ndarray], np.ndarray]:
        rng = np.random.default_rng(seed)
        weights = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(features, components))
        shifts = rng.uniform(0.0, 2.0 * np.pi, size=components)
        return lambda x: np.sqrt(2.0 / components) * np.cos(x @ weights + shifts)

    def score(self, df: DataFrame) -> DataFrame:
        project = self.projection(len(self.features), self.gamma, self.components, self.seed)
        margin = _decisions(self.features, np.array([self.weights]), project)(F.lit(0))
        return df.withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-(margin * F.lit(self.slope) + F.lit(self.intercept)))))


def kernel_gamma(df: DataFrame, features: Sequence[str]) -> float:
    """``1 / (number of features * variance of all entries)``."""
    row = df.selectExpr(*[f"{fn}(`{f}`) AS {a}{i}" for i, f in enumerate(features) for fn, a in (("avg", "m"), ("var_pop", "v"))]).first()
    means = np.array([row[f"m{i}"] for i in range(len(features))])
    within = np.array([row[f"v{i}"] for i in range(len(features))])
    variance = float(within.mean() + means.var())
    return 1.0 / (len(features) * variance) if variance > 0 else 1.0


def kernel_machines(
    df: DataFrame, features: Sequence[str], y: str, members: Sequence[Column], C: float = 1.0, components: int = 256, seed: int = SEED,
    date: str = "date", folds: int = 5,
) -> list[Fitted]:
    placed = member_folds(df, y, members, folds, date)
    own = [F.col("member") == k for k in range(len(members))]
    balance = t.class_weights(placed, y, own)

    def one(k: int) -> Fitted:
        rows = placed.where(own[k])
        gamma = kernel_gamma(rows, features)
        project = KernelFit.projection(len(features), gamma, components, seed)
        weights = [*(F.when(F.col("cv_fold") != f, balance[k]) for f in range(folds)), balance[k]]
        found = newton(fit_rows(rows, features, y, weights), folds + 1, C, "hinge", project)
        table = np.array([[*beta, intercept] for beta, intercept in found])
        margins = settled(rows.select(F.col(y).alias("y"), _decisions(features, table, project)(F.col("cv_fold")).alias("margin")))
        slope, intercept = platt_fit(margins, "y", "margin")
        return fitted("kernel", KernelFit(tuple(features), gamma, components, seed, tuple(map(float, table[-1])), slope, intercept))

    return side_by_side(one, range(len(members)))


@with_many(kernel_machines)
def kernel_machine(
    df: DataFrame, features: Sequence[str], y: str = "y", C: float = 1.0, components: int = 256, seed: int = SEED,
    date: str = "date", folds: int = 5,
) -> Fitted:
    """Balanced support-vector classifier (squared hinge) on random Fourier features, probabilities by Platt scaling.

    The scaling is fitted on decision values of held-out folds, so it does not see values of rows the machine was trained on; the
    machine and those of the folds are fitted by the same passes.
    """
    return kernel_machines(df, features, y, [F.lit(True)], C, components, seed, date, folds)[0]


@dataclass(frozen=True)
class AveragedLogit:
    """Logits with an isotonic curve each; the probability is the mean."""

    fits: tuple[tuple[LinearFit, IsotonicCurve], ...]

    def __len__(self) -> int:
        return len(self.fits)

    def score(self, rows: DataFrame) -> DataFrame:
        """All members by one product of matrices and a lookup each; members with long curves are joined one after the other."""
        curves = [curve.arrays() for _, curve in self.fits]
        if any(c is None for c in curves):
            return self._joined(rows)
        features = self.fits[0][0].features
        table = np.array([[*fit.weights, fit.intercept] for fit, _ in self.fits])

        @F.pandas_udf("double")
        def p(x: pd.DataFrame) -> pd.Series:
            z = np.hstack([x.to_numpy(dtype=float), np.ones((len(x), 1))]) @ table.T
            with np.errstate(over="ignore"):
                raw = 1 / (1 + np.exp(-z))
            return pd.Series(np.mean([np.interp(raw[:, k], *curve) for k, curve in enumerate(curves)], axis=0) + 0 * z.sum(1))

        return rows.withColumn("p", p(F.struct(*[F.col(f"`{f}`").cast("double") for f in features])))

    def _joined(self, rows: DataFrame) -> DataFrame:
        out = rows
        for k, (fit, curve) in enumerate(self.fits):
            out = isotonic_predict(out.withColumn("_raw", fit.probability()), curve, "_raw", f"_p{k}").drop("_raw")
        mean = sum((F.col(f"_p{k}") for k in range(len(self.fits))), F.lit(0.0)) / F.lit(len(self.fits))
        return out.withColumn("p", mean).select(*rows.columns, "p")


def calibrated_logits(
    df: DataFrame, features: Sequence[str], y: str, members: Sequence[Column], C: float = 1.0, folds: int = 5, date: str = "date"
) -> list[Fitted]:
    rows = member_folds(df, y, members, folds, date)
    pairs = [(k, f) for k in range(len(members)) for f in range(folds)]
    weights = [((F.col("member") == k) & (F.col("cv_fold") != f)).cast("double") for k, f in pairs]
    fits = fit_logits(rows, features, y, weights, C)
    table = np.array([[*fit.weights, fit.intercept] for fit in fits])
    score = _decisions(features, table)(F.col("member") * folds + F.col("cv_fold"))
    held = rows.select("member", "cv_fold", F.col(y).alias("y"), (F.lit(1.0) / (F.lit(1.0) + F.exp(-score))).alias("p"))
    curves = isotonic_curves(held, ["member", "cv_fold"])
    return [
        fitted("calibrated_logit", AveragedLogit(tuple((fit, curves[pair]) for fit, pair in zip(fits, pairs) if pair[0] == k))) for k in range(len(members))
    ]


@with_many(calibrated_logits)
def calibrated_logit(
    df: DataFrame, features: Sequence[str], y: str = "y", C: float = 1.0, folds: int = 5, date: str = "date"
) -> Fitted:
    """Per stratified fold a logit on the rest and an isotonic curve on the fold; probabilities averaged."""
    return calibrated_logits(df, features, y, [F.lit(True)], C, folds, date)[0]
