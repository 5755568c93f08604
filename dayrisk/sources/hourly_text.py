"""Yearly whitespace-separated text files of hourly driver records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from dayrisk.constants import HOURLY_FIELDS, HOURLY_INT_FIELDS
from dayrisk.functions.cleaning import (
    clock_from_day_of_year,
    decode_scaled_index,
    drop_all_null,
    sentinels_to_null,
)

CLOCK_FIELDS = ("year", "doy", "hour")


def parse_records(
    lines: DataFrame,
    fields: Sequence[str] = HOURLY_FIELDS,
    int_fields: Iterable[str] = HOURLY_INT_FIELDS,
    wanted: Sequence[str] | None = None,
    text: str = "value",
) -> DataFrame:
    """Split each line on blanks and name the fields by position; short lines end in nulls.

    Only ``wanted`` fields (default all) are cast and kept, so the rest is never materialised.
    """
    ints = set(int_fields)
    parts = F.split(F.trim(F.col(text), F.lit(" \t\r")), r"\s+")
    keep = list(fields) if wanted is None else [f for f in fields if f in set(wanted)]
    number = {
        f: F.get(parts, F.lit(fields.index(f))).try_cast("double") for f in keep
    }
    return lines.where(F.length(F.trim(F.col(text), F.lit(" \t\r"))) > 0).select(
        *[(number[f].cast("int") if f in ints else number[f]).alias(f) for f in keep]
    )


def clean_records(parsed: DataFrame) -> DataFrame:
    """Timestamp from the clock fields, sentinels to null, decoded index, all-null rows dropped."""
    timed = parsed.select(
        clock_from_day_of_year(*[F.col(c) for c in CLOCK_FIELDS]).alias("ts"),
        *[c for c in parsed.columns if c not in CLOCK_FIELDS],
    )
    tidy = decode_scaled_index(sentinels_to_null(timed))
    return drop_all_null(tidy, [c for c in tidy.columns if c != "ts"])


def read_hourly_text(
    spark: SparkSession,
    folder: str,
    years: Iterable[int] | None = None,
    wanted: Sequence[str] | None = None,
    prefix: str = "omni2_",
) -> DataFrame:
    """Read the requested years (default all). Years without a file are skipped; none at all is an error.

    The years become part of the path pattern, so files of other years are never listed or opened.
    """
    names = "*" if years is None else "{" + ",".join(str(int(y)) for y in years) + "}"
    if wanted is not None:
        wanted = [*CLOCK_FIELDS, *wanted]
        if "Kp_real" in wanted:
            wanted.append("Kp")
    try:
        lines = spark.read.text(f"{folder.rstrip('/')}/{prefix}{names}.dat")
    except AnalysisException as error:
        raise FileNotFoundError(f"no hourly record files {prefix}{names}.dat in {folder}") from error
    return clean_records(parse_records(lines, wanted=wanted))


def write_hourly_table(hourly: DataFrame, path: str, ts: str = "ts") -> None:
    """Keep the cleaned records as Parquet by year, so later reads prune years and columns."""
    hourly.withColumn("year", F.year(ts)).write.mode("overwrite").partitionBy("year").parquet(path)


def read_hourly_table(spark: SparkSession, path: str, years: Iterable[int] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    if years is not None:
        table = table.where(F.col("year").isin([int(y) for y in years]))
    return table.drop("year")
