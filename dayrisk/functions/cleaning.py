"""Cleaning expressions for sentinel-coded records and code-valued strings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dayrisk.constants import CODE_COLUMNS, ENVIRONMENTAL, SENTINELS

BLANKS = " \t\n\r\x0b\x0c"


def clock_from_day_of_year(year: Column, doy: Column, hour: Column) -> Column:
    """UTC timestamp of an hour given as year, day of year (from 1) and hour."""
    zero = F.lit(0)
    new_year = F.try_make_timestamp(year.cast("int"), F.lit(1), F.lit(1), zero, zero, zero, F.lit("UTC"))
    return new_year + F.make_dt_interval(doy.cast("int") - 1, hour.cast("int"))


def null_if_sentinel(value: Column, limit: float) -> Column:
    """Null where ``|value| >= limit`` (and for NaN, which sorts above every number)."""
    return F.when(F.abs(value) < F.lit(limit), value)


def sentinels_to_null(df: DataFrame, limits: Mapping[str, float] = SENTINELS) -> DataFrame:
    """Apply :func:`null_if_sentinel` to every listed column that is present; others pass through."""
    return df.select(
        *[null_if_sentinel(F.col(c), limits[c]).alias(c) if c in limits else F.col(c) for c in df.columns]
    )


def decode_scaled_index(df: DataFrame, raw: str = "Kp", decoded: str = "Kp_real", scale: float = 10.0) -> DataFrame:
    """Add the real-valued index beside its scaled integer; no-op without the raw column."""
    if raw not in df.columns:
        return df
    return df.withColumn(decoded, F.col(raw) / F.lit(scale))


def tolerant_date(text: Column, formats: Sequence[str] = ()) -> Column:
    """Date, or null where the text is not one. Extra ``formats`` are tried in order."""
    tries = [F.try_to_date(text), *[F.try_to_date(text, f) for f in formats]]
    return F.coalesce(*tries)


def normal_code(text: Column) -> Column:
    """Trim blanks, strip leading ``@`` signs, upper-case; blanks behind an ``@`` stay."""
    return F.upper(F.ltrim(F.trim(text, F.lit(BLANKS)), F.lit("@")))


def normalise_codes(df: DataFrame, columns: Sequence[str] = CODE_COLUMNS) -> DataFrame:
    return df.withColumns({c: normal_code(F.col(c)) for c in columns if c in df.columns})


def is_member(code: Column, members: Sequence[str] = ENVIRONMENTAL) -> Column:
    """Membership flag that is false, not null, for a null code."""
    return F.coalesce(code.isin(*members), F.lit(False))


def drop_all_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which every listed column is null."""
    return df.dropna(how="all", subset=list(columns))


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any listed column is null."""
    return df.dropna(how="any", subset=list(columns))
