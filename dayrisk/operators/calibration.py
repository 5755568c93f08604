"""Recalibration of probabilities: Platt scaling, isotonic regression, conformal clipping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from dayrisk.functions.scalars import sigmoid
from dayrisk.operators.isotonic import IsotonicCurve, isotonic_curve
from dayrisk.operators.linear import fit_logit


def isotonic_fit(df: DataFrame, y: str = "y", p: str = "p") -> IsotonicCurve:
    """Non-decreasing calibration curve by pooling adjacent violators; rows without score or label are left out."""
    return isotonic_curve(df, y, p)


def isotonic_predict(df: DataFrame, curve: IsotonicCurve, p: str = "p", out: str = "calibrated") -> DataFrame:
    """Interpolate between the knots; scores beyond the fitted range take the end values."""
    return curve.predict(df, p, out)


def conformal_clip(p: Column, q: float) -> Column:
    """Clip to ``[q/2, 1 - q/2]``, where ``q`` is the nonconformity quantile of the calibration rows."""
    low, high = q / 2, 1 - q / 2
    return F.when(p.isNotNull(), F.least(F.greatest(p, F.lit(low)), F.lit(high)))


def platt_fit(df: DataFrame, y: str = "y", p: str = "p"):
    """One-feature regularised logit on the raw probability: ``(slope, intercept)``."""
    fit = fit_logit(df.where(F.col(p).isNotNull()), [p], y)
    return fit.weights[0], fit.intercept


def platt_predict(p: Column, slope: float, intercept: float) -> Column:
    return sigmoid(p * F.lit(slope) + F.lit(intercept))
