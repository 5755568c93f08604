"""Event catalogue: one row per dated event, exported from its sheet as CSV or Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayrisk.constants import MISSING_CLOCK, UNKNOWN_DIAGNOSIS
from dayrisk.functions.cleaning import is_member, normalise_codes, tolerant_date

SCHEMA = (
    "VER double, EDATE string, ADATE string, BIRD string, STIMEU int, DUR double, STIMEL int, "
    "ORBIT string, NS string, EW string, LAT double, LON double, ATYPE string, ADIAG string, ACOMMENT string"
)


def read_catalogue(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw catalogue rows with fixed types; ``path`` is a Parquet file or folder (ending in ``.parquet``) or CSV with a header line.

    Columns go by name: they may come in any order, further columns are left out, and absent ones stay absent as long as the event
    date ``ADATE`` is there. ``multi_line`` is for comments with line breaks; such a file is read by one task.
    """
    if path.rstrip("/").endswith(".parquet"):
        raw = spark.read.parquet(path)
    else:
        raw = spark.read.csv(path, header=True, multiLine=multi_line, escape='"')
    named = {c.strip().upper(): c for c in raw.columns}
    if "ADATE" not in named:
        raise ValueError(f"{path} has no column ADATE")
    kinds = dict(part.split() for part in SCHEMA.split(", "))
    return raw.select(*[F.expr(f"try_cast(`{named[c]}` AS {kind})").alias(c) for c, kind in kinds.items() if c in named])


def clean_catalogue(
    raw: DataFrame, keep_unknown: bool = True, date_formats: Sequence[str] = ()
) -> DataFrame:
    """Parse dates, drop undated rows, null the missing clock, normalise codes and flag the class.

    ``ADATE`` is the event date. ``EDATE`` is when the batch was entered and stays an attribute only.
    Of the absent columns, only those read here appear, as nulls. The clock column is called ``event_time_utc``: Spark names ignore case, so ``stimeu`` would clash.
    """
    absent = F.lit(None)
    entry = tolerant_date(F.col("EDATE"), date_formats) if "EDATE" in raw.columns else absent.cast("date")
    clock = F.nullif(F.col("STIMEU"), F.lit(MISSING_CLOCK)) if "STIMEU" in raw.columns else absent.cast("int")
    dated = raw.withColumns(
        {"anomaly_date": tolerant_date(F.col("ADATE"), date_formats), "catalog_entry_date": entry, "event_time_utc": clock}
    ).where(F.col("anomaly_date").isNotNull())
    code = F.col("ADIAG") if "ADIAG" in raw.columns else absent.cast("string")
    coded = normalise_codes(dated.withColumn("ADIAG", code)).withColumn("is_environmental", is_member(F.col("ADIAG")))
    return coded if keep_unknown else drop_class(coded)


def drop_class(events: DataFrame, code: str = UNKNOWN_DIAGNOSIS, column: str = "ADIAG") -> DataFrame:
    """Drop one class; rows with a null class go too, as the comparison is not true for them."""
    return events.where(F.col(column) != F.lit(code))
