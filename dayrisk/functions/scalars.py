"""Scalar expressions: seasonal encoding, coupling physics, grids and decisions."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, functions as F

from dayrisk.constants import STORM_LEVEL


def season_angle(day: Column) -> Column:
    return F.lit(2.0 * math.pi) * F.dayofyear(day) / F.lit(366.0)


def season_columns(day: Column) -> list[Column]:
    """Sine and cosine of the day of year, so that the year has no seam."""
    return [F.sin(season_angle(day)).alias("doy_sin"), F.cos(season_angle(day)).alias("doy_cos")]


def positive_part(value: Column) -> Column:
    """``max(value, 0)`` that stays null for null (``greatest`` alone would give 0)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def motional_field(bz: Column, speed: Column) -> Column:
    """Electric field of the southward field component, in mV/m for nT and km/s."""
    return speed * positive_part(-bz) * F.lit(1e-3)


def southward(bz: Column) -> Column:
    """1 for a southward hour, else 0; a missing hour counts as 0 and stays in the denominator."""
    return F.coalesce(bz < 0, F.lit(False)).cast("int")


def storm_phase(level: Column, change: Column, at: float = STORM_LEVEL) -> dict[str, Column]:
    """0/1 flags: main (deep and falling), recovery (deep, not falling), quiet (neither, or unknown)."""
    deep = level <= F.lit(at)
    main = F.coalesce(deep & (change < 0), F.lit(False))
    recovery = F.coalesce(deep & (change >= 0), F.lit(False))
    return {
        "phase_quiet": (~(main | recovery)).cast("int"),
        "phase_main": main.cast("int"),
        "phase_recovery": recovery.cast("int"),
    }


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def even_grid(start: float, stop: float, points: int) -> list[float]:
    """Grid points exactly as ``numpy.linspace`` rounds them; comparisons depend on the last bit."""
    return [float(x) for x in np.linspace(start, stop, points)]


def grid_index(value: Column, grid: Sequence[float]) -> Column:
    """0-based index of the last point of an even ``grid`` that is <= value, -1 below the first.

    The division only guesses; comparing with the grid's own literals settles ties at an edge.
    The cost per row does not depend on the number of points.
    """
    points = F.array(*[F.lit(float(g)) for g in grid])
    last, step = len(grid) - 1, (grid[-1] - grid[0]) / (len(grid) - 1)
    guess = F.least(
        F.greatest(F.floor((value - F.lit(grid[0])) / F.lit(step)), F.lit(0)), F.lit(last)
    ).cast("int")
    above = F.get(points, F.least(guess + 1, F.lit(last)))
    here = F.get(points, guess)
    return (
        F.when(value.isNull(), F.lit(None).cast("int"))
        .when((guess < last) & (above <= value), guess + 1)
        .when(here <= value, guess)
        .otherwise(guess - 1)
    )


def interval_label(value: Column, intervals: Sequence[tuple[float, float, str]]) -> Column:
    """Label of the left-open, right-closed interval holding the value, else null."""
    out = F.lit(None).cast("string")
    for low, high, name in reversed(list(intervals)):
        out = F.when((value > F.lit(low)) & (value <= F.lit(high)), F.lit(name)).otherwise(out)
    return out


def decide(p: Column, margin: float | Column) -> Column:
    """ABSTAIN within ``margin`` of one half, else ALERT / NO ALERT at one half."""
    width = margin if isinstance(margin, Column) else F.lit(float(margin))
    return (
        F.when(F.abs(p - F.lit(0.5)) < width, F.lit("ABSTAIN"))
        .when(p >= F.lit(0.5), F.lit("ALERT"))
        .when(p.isNotNull(), F.lit("NO ALERT"))
    )


def sigmoid(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def percent_text(share: Column, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", share * F.lit(100.0))
