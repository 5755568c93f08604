"""Sources, cleaning and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from dayrisk.constants import DIAGNOSES, ORBITS, SEED
from dayrisk.functions.cleaning import complete_cases, decode_scaled_index, drop_all_null, sentinels_to_null
from dayrisk.operators.labels import coverage_report, date_audit
from dayrisk.operators.lookup import describe_codes
from dayrisk.operators.order_stats import hashed_sample
from dayrisk.sources.catalogue import drop_class
from dayrisk.sources.hourly_text import clean_records, parse_records
from registry.core import query
from registry.inputs import (
    CATALOGUE_SQL, HOURLY_DRIVERS, HOURLY_SQL, SERIES_SQL, events_catalogue, hourly_drivers, raw_catalogue,
    rounded, rounded_sql, table,
)

# --- text records -----------------------------------------------------------------------------
TEXT_FIELDS = ["year", "doy", "hour", "flag", "flow_speed", "Kp", "Dst", "proton_temp"]


def record_lines(spark, folder):
    """Events as text records: year, day of year, hour, four numbers, irregular blanks, short lines."""
    ts = F.col("ts").cast("timestamp")
    cut = F.col("event_id") % 50 == 0
    parts = [
        F.lit("  "), F.year(ts).cast("string"), F.lit("   "), F.dayofyear(ts).cast("string"), F.lit(" "),
        F.hour(ts).cast("string"), F.lit("\t "), F.col("event_id").cast("string"), F.lit("  "),
        F.when(F.col("event_id") % 11 == 0, F.lit("9999.0")).otherwise(F.col("value").cast("string")),
        F.lit(" "), F.when(F.col("event_id") % 7 == 0, F.lit("99")).otherwise(F.col("user_id").cast("string")),
    ]
    tail = F.when(cut, F.lit("")).otherwise(F.concat(F.lit("   "), (-F.col("value")).cast("string"), F.lit(" 999999. ")))
    return table(spark, folder, "events").select(F.concat(*parts, tail).alias("value"))


_LINES = """records AS (
  SELECT ts, event_id, CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS flow_speed,
    CASE WHEN event_id % 7 = 0 OR user_id >= 99 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS Kp,
    CASE WHEN event_id % 50 <> 0 THEN -value END AS Dst,
    CASE WHEN event_id % 50 <> 0 THEN 999999.0 END AS proton_temp FROM events)"""


@query(
    "text_scan",
    rounded_sql(
        """FROM (SELECT extract(year FROM ts) AS year, extract(doy FROM ts) AS doy, extract(hour FROM ts) AS hour,
          event_id AS flag, CASE WHEN event_id % 11 = 0 THEN 9999.0 ELSE value END AS flow_speed,
          CASE WHEN event_id % 7 = 0 THEN 99 ELSE user_id END AS Kp,
          CASE WHEN event_id % 50 <> 0 THEN -value END AS Dst,
          CASE WHEN event_id % 50 <> 0 THEN 999999.0 END AS proton_temp FROM events)""",
        "flow_speed Kp Dst proton_temp", "year doy hour flag",
    ),
)
def text_scan(spark, folder):
    lines = record_lines(spark, folder)
    return rounded(parse_records(lines, TEXT_FIELDS))


@query(
    "timestamp_from_doy",
    rounded_sql(
        "FROM (SELECT event_id AS flag, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS ts FROM events)",
        "", "flag", "ts",
    ),
)
def timestamp_from_doy(spark, folder):
    timed = clean_records(parse_records(record_lines(spark, folder), TEXT_FIELDS, wanted=TEXT_FIELDS[:4]))
    return rounded(timed.select("flag", "ts"))


@query(
    "sentinel_to_null",
    rounded_sql("FROM (SELECT event_id AS flag, * EXCLUDE (event_id) FROM records)",
                "flow_speed Kp Dst proton_temp", "flag", ctes=_LINES),
)
def sentinel_to_null(spark, folder):
    parsed = parse_records(record_lines(spark, folder), TEXT_FIELDS)
    return rounded(sentinels_to_null(parsed).select("flag", "flow_speed", "Kp", "Dst", "proton_temp"))


@query(
    "index_decode",
    rounded_sql("FROM (SELECT event_id AS flag, Kp, Kp / 10.0 AS Kp_real FROM records)", "Kp Kp_real", "flag", ctes=_LINES),
)
def index_decode(spark, folder):
    parsed = parse_records(record_lines(spark, folder), TEXT_FIELDS, wanted=["flag", "Kp"])
    return rounded(decode_scaled_index(sentinels_to_null(parsed)))


@query(
    "drop_all_null_rows",
    rounded_sql("FROM hourly WHERE coalesce(Bz_gsm, Dst, flow_speed) IS NOT NULL", "Bz_gsm flow_speed Dst",
                texts="ts", ctes=HOURLY_SQL).replace("CAST(ts AS VARCHAR)", "strftime(ts, '%Y-%m-%d %H:%M:%S')"),
)
def drop_all_null_rows(spark, folder):
    drivers = ["Bz_gsm", "flow_speed", "Dst"]
    return rounded(drop_all_null(hourly_drivers(spark, folder).select("ts", *drivers), drivers))


@query(
    "complete_case_rows",
    rounded_sql("FROM hourly WHERE Bz_gsm + flow_speed + flow_pressure + proton_density + Dst IS NOT NULL",
                "Bz_gsm flow_speed flow_pressure proton_density Dst",
                texts="ts", ctes=HOURLY_SQL).replace("CAST(ts AS VARCHAR)", "strftime(ts, '%Y-%m-%d %H:%M:%S')"),
)
def complete_case_rows(spark, folder):
    return rounded(complete_cases(hourly_drivers(spark, folder), HOURLY_DRIVERS))


@query(
    "coverage_report",
    f"""WITH {SERIES_SQL}, long AS (
      SELECT name AS "column", v FROM (SELECT unnest(['Bz_gsm', 'flow_speed', 'flow_pressure', 'proton_density', 'Dst']) AS name,
        unnest([Bz_gsm, flow_speed, flow_pressure, proton_density, Dst]) AS v FROM hourly))
    SELECT "column", count(*) - count(v) AS missing, count(v) AS present,
      round(100.0 * (count(*) - count(v)) / count(*), 8) + 0.0 AS pct_missing FROM long GROUP BY 1""",
)
def coverage(spark, folder):
    return rounded(coverage_report(hourly_drivers(spark, folder, ["user_id"]), HOURLY_DRIVERS))


# --- event catalogue --------------------------------------------------------------------------
@query(
    "string_normalise",
    f"WITH {CATALOGUE_SQL} SELECT event_id, BIRD, ORBIT, ADIAG, CAST(is_environmental AS BIGINT) AS is_environmental FROM catalogue",
)
def string_normalise(spark, folder):
    return rounded(events_catalogue(spark, folder).select("event_id", "BIRD", "ORBIT", "ADIAG", "is_environmental"))


@query(
    "tolerant_dates",
    f"""WITH {CATALOGUE_SQL} SELECT event_id, CAST(anomaly_date AS VARCHAR) AS anomaly_date,
      CAST(catalog_entry_date AS VARCHAR) AS catalog_entry_date FROM catalogue""",
)
def tolerant_dates(spark, folder):
    return rounded(events_catalogue(spark, folder).select("event_id", "anomaly_date", "catalog_entry_date"))


@query(
    "clock_sentinel",
    rounded_sql("FROM (SELECT event_id, CASE WHEN event_id % 13 <> 0 THEN event_time_utc END AS event_time_utc FROM catalogue)",
                "event_time_utc", "event_id", ctes=CATALOGUE_SQL),
)
def clock_sentinel(spark, folder):
    times = events_catalogue(spark, folder).select("event_id", F.col("event_time_utc").cast("double").alias("event_time_utc"))
    return rounded(times)


@query("drop_unknown", f"WITH {CATALOGUE_SQL} SELECT event_id, ADIAG FROM catalogue WHERE ADIAG <> 'UNK'")
def drop_unknown(spark, folder):
    return drop_class(events_catalogue(spark, folder)).select("event_id", "ADIAG")


@query(
    "date_audit",
    f"""WITH {CATALOGUE_SQL}, per AS (
        SELECT 'anomaly_date' AS "column", anomaly_date AS d, count(*) AS n FROM catalogue GROUP BY 2
        UNION ALL SELECT 'catalog_entry_date', catalog_entry_date, count(*) FROM catalogue GROUP BY 2)
      SELECT "column", count(*) AS n_dates, max(n) AS largest_pile,
        CAST(arg_min(d, (-n, d)) AS VARCHAR) AS largest_date FROM per GROUP BY 1""",
)
def audit(spark, folder):
    return rounded(date_audit(events_catalogue(spark, folder), ["anomaly_date", "catalog_entry_date"]))


def _names(codes):
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return ", ".join(f"({quote(k)}, {quote(v)})" for k, v in codes.items())


@query(
    "code_lookup",
    f"""WITH {CATALOGUE_SQL}, diagnoses(code, diagnosis) AS (VALUES {_names(DIAGNOSES)}),
      orbits(code, orbit_name) AS (VALUES {_names(ORBITS)})
    SELECT event_id, ADIAG, diagnosis, ORBIT, orbit_name FROM catalogue
      LEFT JOIN diagnoses ON diagnoses.code = ADIAG LEFT JOIN orbits ON orbits.code = ORBIT""",
)
def code_lookup(spark, folder):
    events = events_catalogue(spark, folder).select("event_id", "ADIAG", "ORBIT")
    named = describe_codes(events, "ADIAG", DIAGNOSES, "diagnosis")
    return describe_codes(named, "ORBIT", ORBITS, "orbit_name")


@query(
    "orbit_slice",
    f"""WITH {CATALOGUE_SQL} SELECT event_id, CAST(anomaly_date AS VARCHAR) AS anomaly_date, ADIAG FROM catalogue WHERE ORBIT = 'G'""",
)
def orbit_slice(spark, folder):
    return rounded(events_catalogue(spark, folder).where("ORBIT = 'G'").select("event_id", "anomaly_date", "ADIAG"))


@query(
    "class_subset",
    f"""WITH {CATALOGUE_SQL} SELECT event_id, CAST(anomaly_date AS VARCHAR) AS anomaly_date, ADIAG FROM catalogue
      WHERE ADIAG IN ('ESD', 'ECEMP', 'SEU') AND anomaly_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'""",
)
def class_subset(spark, folder):
    events = events_catalogue(spark, folder)
    kept = events.where(F.col("ADIAG").isin("ESD", "ECEMP", "SEU") & F.col("anomaly_date").between("1996-01-01", "1998-12-31"))
    return rounded(kept.select("event_id", "anomaly_date", "ADIAG"))


@query(
    "hashed_sample",
    f"SELECT o_orderkey AS event_id, o_totalprice AS weight FROM orders ORDER BY md5('{SEED}:' || o_orderkey), o_orderkey LIMIT 2000",
)
def sample(spark, folder):
    return hashed_sample(raw_catalogue(spark, folder).select("event_id", "weight"), "event_id", 2000, SEED)


@query(
    "union_by_year",
    """SELECT CAST(extract(year FROM o_orderdate) AS BIGINT) AS year, count(*) AS n FROM orders
      WHERE extract(year FROM o_orderdate) IN (1996, 1999, 2000) GROUP BY 1""",
)
def union_by_year(spark, folder):
    """Yearly parts put together again; the parts' filters reach the scan."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    parts = [
        orders.where((F.col("o_orderdate") >= f"{y}-01-01") & (F.col("o_orderdate") < f"{y + 1}-01-01"))
        for y in (1996, 1999, 2000)
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rounded(whole.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n")))


@query(
    "key_intersection",
    """SELECT DISTINCT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date FROM lineitem
      WHERE CAST(l_shipdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def key_intersection(spark, folder):
    days = table(spark, folder, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    urgent = table(spark, folder, "orders").where("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").alias("date"))
    return rounded(days.join(urgent, "date", "left_semi"))
