"""Tables written in the formats of the sources and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession, functions as F

from dayrisk.constants import HOURLY_FIELDS
from dayrisk.plans.scoring import stored_rows_for_dates
from dayrisk.session import ensure_checkpoint_dir, settled
from dayrisk.sources.catalogue import clean_catalogue, read_catalogue
from dayrisk.sources.hourly_text import read_hourly_text, write_hourly_table
from registry.core import query
from registry.features import CONFIG, PANEL_DRIVERS, _FEATURES, TEXT_TS, daily_panel_sql
from registry.inputs import CATALOGUE_SQL, LONG_SQL, long_drivers, raw_catalogue, rounded, rounded_sql, table


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the one that driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


YEARS = (1993, 1995, 1996, 2050)


def record_line():
    """A day of the long drivers as a line of 55 fields between blanks."""
    missing = lambda c, fill: F.coalesce(F.col(c).cast("string"), F.lit(fill))
    filled = {
        "year": F.year("ts").cast("string"), "doy": F.dayofyear("ts").cast("string"), "hour": F.hour("ts").cast("string"), "Bz_gsm": missing("Bz_gsm", "999.9"),
        "flow_speed": missing("flow_speed", "9999."), "Dst": missing("Dst", "99999"), "Kp": F.coalesce(F.round(F.col("Kp_real") * 10).cast("int").cast("string"), F.lit("99")),
    }
    return F.concat(F.lit(" "), F.concat_ws("  ", *[filled.get(f, F.lit("0")) for f in HOURLY_FIELDS]))


@query(
    "yearly_text_files",
    rounded_sql(f"""FROM (SELECT ts, Bz_gsm, flow_speed, Dst, round(Kp_real * 10) / 10.0 AS Kp_real FROM long_drivers WHERE extract(year FROM ts) IN {YEARS})""",
                "Bz_gsm flow_speed Dst Kp_real", texts="ts", ctes=LONG_SQL).replace(*TEXT_TS),
)
def yearly_files(spark, folder):
    """All years written as text files, one folder a year; some of them, and one that is not there, read back by name."""
    path, rows = new_folder(spark, "yearly"), settled(long_drivers(spark, folder))
    for r in rows.select(F.year("ts").alias("y")).distinct().collect():  # as many as the calendar has
        rows.where(F.year("ts") == r["y"]).select(record_line()).write.text(f"{path}/omni2_{r['y']}.dat")
    return rounded(read_hourly_text(spark, path, YEARS, ["Bz_gsm", "flow_speed", "Dst", "Kp_real"]).select("ts", "Bz_gsm", "flow_speed", "Dst", "Kp_real"))


_CATALOGUE_COLUMNS = "anomaly_date catalog_entry_date BIRD ORBIT ADIAG"


@query(
    "catalogue_csv",
    rounded_sql("FROM catalogue", "", "event_time_utc is_environmental", _CATALOGUE_COLUMNS, ctes=CATALOGUE_SQL),
)
def catalogue_file(spark, folder):
    """The untidy catalogue written as CSV, columns in another order and one that is not known, read back and cleaned."""
    path = new_folder(spark, "catalogue")
    raw = raw_catalogue(spark, folder).select("ORBIT", "ADIAG", F.col("STIMEU").alias("stimeu"), F.lit("x, \"y\"").alias("remark"), "BIRD", "EDATE", F.col("ADATE").alias("Adate"))
    raw.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, escape='"')
    return rounded(clean_catalogue(read_catalogue(spark, path)).select(*_CATALOGUE_COLUMNS.split(), "event_time_utc", "is_environmental"))


@query(
    "rows_for_dates",
    rounded_sql("""FROM daily WHERE date IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE extract(doy FROM o_orderdate) IN (3, 100, 101, 300))
      AND date IN (SELECT CAST(ts AS DATE) FROM long_drivers)""",
                " ".join(_FEATURES), texts="date", digits=6, ctes=f"{LONG_SQL}, {daily_panel_sql(PANEL_DRIVERS, 'long_drivers')}"),
)
def some_dates(spark, folder):
    """Feature rows of some dates, from drivers stored by year."""
    path = new_folder(spark, "drivers")
    write_hourly_table(long_drivers(spark, folder), path)
    day = F.to_date("o_orderdate").alias("date")
    dates = table(spark, folder, "orders").where(F.dayofyear("o_orderdate").isin(3, 100, 101, 300)).select(day).distinct()
    return rounded(stored_rows_for_dates(spark, path, dates, CONFIG).select("date", *_FEATURES), 6)
