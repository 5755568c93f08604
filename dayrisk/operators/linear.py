"""Linear and logistic models, with penalties given in the usual per-row convention.

Spark divides the loss by the number (or weight) of rows and scales penalties by the deviation of the
label; the functions here translate, so that ``C``, ``alpha`` and ``l1_ratio`` mean what they mean in
the textbook objective. A fit is a list of weights, so scoring is a plain column expression.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from dayrisk.functions.scalars import sigmoid
from dayrisk.operators.many_fits import fit_rows, newton


@dataclass(frozen=True)
class LinearFit:
    """Weights in feature order and the intercept."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self) -> Column:
        terms = [f"{w!r}D * `{f}`" for f, w in zip(self.features, self.weights)]
        return F.expr(" + ".join([f"{self.intercept!r}D", *terms]))

    def probability(self) -> Column:
        return sigmoid(self.score())


def vectors(df: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """``features`` as one vector column for the fitting algorithms; nothing else is carried along."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return assembled.select("features", *keep)


def balanced_weights(df: DataFrame, y: str = "y") -> DataFrame:
    """Add ``weight = n / (2 n_class)``, so that both classes weigh the same."""
    counts = df.groupBy(y).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per class
    total = sum(r["n"] for r in counts)
    weight = F.lit(None).cast("double")
    for r in counts:
        weight = F.when(F.col(y) == F.lit(r[y]), F.lit(total / (len(counts) * r["n"]))).otherwise(weight)
    return df.withColumn("weight", weight)


def fit_logit(df: DataFrame, features: Sequence[str], y: str = "y", C: float = 1.0, weight: str | None = None) -> LinearFit:
    """Minimise ``C * sum(w * loss) + |coefficients|^2 / 2``, intercept free. Rows without a label or a feature are left out."""
    return fit_logits(df, features, y, [F.col(weight) if weight else F.lit(1.0)], C)[0]


def fit_logits(df: DataFrame, features: Sequence[str], y: str, weights: Sequence[Column], C: float | Sequence[float] = 1.0) -> list[LinearFit]:
    """A logit for every column of row weights, all of them by the same passes over the rows."""
    found = newton(fit_rows(df.dropna("any", subset=[*features, y]), features, y, weights), len(weights), C)
    return [LinearFit(tuple(features), tuple(map(float, beta)), intercept) for beta, intercept in found]


def _fit_linear(df: DataFrame, features: Sequence[str], y: str, penalties) -> LinearFit:
    data = vectors(df, features, [F.col(y).cast("double").alias("label")])
    moments = data.agg(F.count("label").alias("n"), F.stddev_pop("label").alias("s")).first()
    if not moments["n"]:
        raise ValueError("no rows to fit")
    l1, l2 = penalties(moments["n"], moments["s"] or 1.0)
    reg = l1 + l2
    model = LinearRegression(
        regParam=reg, elasticNetParam=l1 / reg if reg else 0.0, standardization=False, maxIter=1000, tol=1e-12
    ).fit(data)
    return LinearFit(tuple(features), tuple(float(w) for w in model.coefficients), float(model.intercept))


def fit_ols(df: DataFrame, features: Sequence[str], y: str = "y") -> LinearFit:
    return _fit_linear(df, features, y, lambda n, s: (0.0, 0.0))


def fit_ridge(df: DataFrame, features: Sequence[str], y: str = "y", alpha: float = 1.0) -> LinearFit:
    """Minimise ``sum(error^2) + alpha * |w|^2``."""
    return _fit_linear(df, features, y, lambda n, s: (0.0, alpha * s / n))


def fit_lasso(df: DataFrame, features: Sequence[str], y: str = "y", alpha: float = 0.1) -> LinearFit:
    """Minimise ``sum(error^2) / (2 n) + alpha * |w|_1``."""
    return _fit_linear(df, features, y, lambda n, s: (alpha, 0.0))


def fit_elastic_net(
    df: DataFrame, features: Sequence[str], y: str = "y", alpha: float = 0.1, l1_ratio: float = 0.5
) -> LinearFit:
    """Minimise ``sum(error^2) / (2 n) + alpha * (l1_ratio * |w|_1 + (1 - l1_ratio) / 2 * |w|^2)``."""
    return _fit_linear(df, features, y, lambda n, s: (alpha * l1_ratio, alpha * (1 - l1_ratio) * s))
