"""Likelihood-ratio and chi-square tests."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def chi_square_tail(statistic: float, dof: int) -> float:
    """Upper tail of the chi-square distribution for whole degrees of freedom.

    Even: a finite Poisson sum. Odd: the error function plus a finite sum.
    """
    if dof < 1:
        return float("nan")
    if statistic <= 0:
        return 1.0
    half = statistic / 2
    if dof % 2 == 0:
        term = total = 1.0
        for k in range(1, dof // 2):
            term *= half / k
            total += term
        return math.exp(-half) * total
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for k in range(1, (dof - 1) // 2 + 1):
        total += term
        term *= half / (k + 0.5)
    return total


def likelihood_ratio(n: int, loss_small: float, loss_large: float, dof: int) -> tuple[float, float]:
    """Statistic ``2 n (loss_small - loss_large)`` from mean log losses, and its tail probability."""
    statistic = 2.0 * n * (loss_small - loss_large)
    return statistic, chi_square_tail(statistic, dof)


def contingency_table(df: DataFrame, rows: str, columns: str, levels: Sequence[str]) -> DataFrame:
    """Counts per row level, one column per listed level."""
    wide = df.where(F.col(rows).isNotNull()).groupBy(rows).pivot(columns, list(levels)).count()
    return wide.select(rows, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).alias(str(v)) for v in levels])


#: Lanczos' approximation of the gamma function for g = 7.
LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313, -176.61502916214059, 12.507343278686905, -0.13857109526572012,
    9.9843695780195716e-6, 1.5056327351493116e-7,
)
TERMS = 600


def log_gamma(a: str) -> str:
    """SQL for the logarithm of the gamma function of a positive expression."""
    series = " + ".join([repr(LANCZOS[0]) + "D", *[f"{c!r}D / ({a} + {k - 1}D)" for k, c in enumerate(LANCZOS[1:], 1)]])
    return f"(0.5D * ln(2 * pi()) + ({a} - 0.5D) * ln({a} + 6.5D) - ({a} + 6.5D) + ln({series}))"


def chi_square_tails(statistic: str, dof: str) -> Column:
    """Upper tail of the chi-square distribution as a column, for columns of statistics and (whole or not) degrees of freedom.

    The regularised incomplete gamma function: its series below the mean, its continued fraction above. Null without a degree of freedom.
    TERMS terms are enough for ten digits up to 50 000 degrees of freedom.
    """
    a, x = f"(CAST({dof} AS DOUBLE) / 2D)", f"(CAST({statistic} AS DOUBLE) / 2D)"
    scale = f"exp(-{x} + {a} * ln({x}) - {log_gamma(a)})"
    series = f"""aggregate(sequence(1, {TERMS}), named_struct('t', 1D / {a}, 's', 1D / {a}),
      (z, n) -> named_struct('t', z.t * {x} / ({a} + n), 's', z.s + z.t * {x} / ({a} + n)), z -> z.s)"""
    # Lentz' method: d and c are the running denominator and quotient, h the value so far
    step = f"named_struct('d', 1D / (-n * (n - {a}) * z.d + {x} + 1D - {a} + 2D * n), 'c', {x} + 1D - {a} + 2D * n - n * (n - {a}) / z.c, 'h', z.h)"
    fraction = f"""aggregate(sequence(1, {TERMS}), named_struct('d', 1D / ({x} + 1D - {a}), 'c', 1D / 1e-300D, 'h', 1D / ({x} + 1D - {a})),
      (z, n) -> transform(array({step}), y -> named_struct('d', y.d, 'c', y.c, 'h', y.h * y.d * y.c))[0], z -> z.h)"""
    return F.expr(f"""CASE WHEN {dof} < 1 OR {statistic} IS NULL THEN NULL WHEN {x} <= 0 THEN 1D
      WHEN {x} < {a} + 1D THEN 1D - {scale} * {series} ELSE {scale} * {fraction} END""")


def chi_square_independence(df: DataFrame, rows: str, columns: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., chi2, dof, p_value)``, one row per group, all tests in one plan; without ``by`` one row.

    With one degree of freedom the statistic has Yates' correction. The data is counted once; marginals are sums over the counted cells.
    Rows with a null in either category are left out, null groups are groups; without a row there is nothing to test.
    """
    by = list(by)
    cells = (
        df.where(F.col(rows).isNotNull() & F.col(columns).isNotNull())
        .groupBy(*by, F.col(rows).alias("_r"), F.col(columns).alias("_c"))
        .agg(F.count(F.lit(1)).cast("double").alias("_n"))
    )

    def marginal(key: str, name: str) -> DataFrame:
        summed = cells.groupBy(*by, key).agg(F.sum("_n").alias(name))
        return summed.withColumnsRenamed({b: f"_by_{b}" for b in by} | {key: f"_of{key}"})

    def joined(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
        match = F.col(key) == F.col(f"_of{key}")
        for b in by:
            match = match & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
        return left.join(right, match).drop(f"_of{key}", *[f"_by_{b}" for b in by])

    placed = joined(joined(cells, marginal("_r", "_row"), "_r"), marginal("_c", "_col"), "_c")
    # cells that do not occur still count with their expected number: chi2 = N (sum n^2 / (row * column) - 1)
    total = placed.groupBy(*by).agg(
        F.sum("_n").alias("n"), F.sum(F.col("_n") * F.col("_n") / (F.col("_row") * F.col("_col"))).alias("share"),
        F.count_distinct("_r").alias("r"), F.count_distinct("_c").alias("c"), F.max("_row").alias("r1"), F.max("_col").alias("c1"),
    )
    plain = F.greatest(F.col("n") * (F.col("share") - 1), F.lit(0.0))
    # of a two by two table |observed - expected| is the same in all four cells
    weight = F.col("n") * (1 / F.col("r1") + 1 / (F.col("n") - F.col("r1"))) * (1 / F.col("c1") + 1 / (F.col("n") - F.col("c1")))
    gap = F.sqrt(plain / weight)
    tested = total.withColumn("dof", ((F.col("r") - 1) * (F.col("c") - 1)).cast("int")).withColumn(
        "chi2", F.when(F.col("dof") == 1, F.pow(F.greatest(gap - 0.5, F.lit(0.0)), 2) * weight).otherwise(plain)
    )
    return tested.select(*by, "chi2", "dof", F.coalesce(chi_square_tails("chi2", "dof"), F.lit(1.0)).alias("p_value"))
