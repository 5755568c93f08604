"""Tables of the domain derived from the given tables, each in Spark and as a SQL fragment.

* hourly drivers: ``events`` by hour, one driver per event type
* series drivers: the same per user
* long drivers: ``lineitem`` by ship date (years of days, one row per day)
* event catalogue: ``orders``, with codes and dates made untidy on the way
* rare labels: one catalogue event in about a thousandth of the orders
* scores: ``lineitem`` (p on the 0.1 grid) and ``events`` (p almost continuous)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from dayrisk.operators.daily import fill_calendar
from dayrisk.sources.catalogue import clean_catalogue


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


HOURLY_DRIVERS = ["Bz_gsm", "flow_speed", "flow_pressure", "proton_density", "Dst"]


def _of(event_type: str):
    return F.avg(F.when(F.col("event_type") == event_type, F.col("value")))


def driver_columns():
    return [
        (_of("click") - 50.0).alias("Bz_gsm"),
        (_of("view") * 10.0).alias("flow_speed"),
        _of("purchase").alias("flow_pressure"),
        _of("signup").alias("proton_density"),
        (-_of("error")).alias("Dst"),
    ]


def hourly_drivers(spark: SparkSession, folder: str, keys=()) -> DataFrame:
    events = table(spark, folder, "events")
    return events.groupBy(*keys, F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("ts")).agg(*driver_columns())


_DRIVERS_SQL = """
    avg(value) FILTER (WHERE event_type = 'click') - 50.0 AS Bz_gsm,
    avg(value) FILTER (WHERE event_type = 'view') * 10.0 AS flow_speed,
    avg(value) FILTER (WHERE event_type = 'purchase') AS flow_pressure,
    avg(value) FILTER (WHERE event_type = 'signup') AS proton_density,
    -avg(value) FILTER (WHERE event_type = 'error') AS Dst"""
HOURLY_SQL = f"hourly AS (SELECT date_trunc('hour', ts) AS ts, {_DRIVERS_SQL} FROM events GROUP BY 1)"
SERIES_SQL = f"hourly AS (SELECT user_id, date_trunc('hour', ts) AS ts, {_DRIVERS_SQL} FROM events GROUP BY 1, 2)"


def long_drivers(spark: SparkSession, folder: str) -> DataFrame:
    """Six and a half years of days from lineitem."""
    flag = F.col("l_returnflag")
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.date_trunc("day", F.col("l_shipdate").cast("timestamp")).alias("ts"))
        .agg(
            (F.avg("l_quantity") - 25.0).alias("Bz_gsm"),
            (F.avg("l_extendedprice") / 97.0).alias("flow_speed"),
            (F.avg("l_tax") * 100.0).alias("proton_density"),
            (F.avg("l_discount") * 100.0).alias("flow_pressure"),
            (-F.avg(F.when(flag == "R", F.col("l_quantity")))).alias("Dst"),
            (F.avg(F.when(flag == "A", F.col("l_quantity"))) / 5.0).alias("Kp_real"),
            F.count_if(F.col("l_linestatus") == "O").cast("double").alias("AE"),
        )
    )


LONG_DRIVERS = ["Bz_gsm", "flow_speed", "proton_density", "flow_pressure", "Dst", "Kp_real", "AE"]
LONG_SQL = """long_drivers AS (
  SELECT date_trunc('day', l_shipdate) AS ts,
    avg(l_quantity) - 25.0 AS Bz_gsm, avg(l_extendedprice) / 97.0 AS flow_speed,
    avg(l_tax) * 100.0 AS proton_density, avg(l_discount) * 100.0 AS flow_pressure,
    -avg(l_quantity) FILTER (WHERE l_returnflag = 'R') AS Dst,
    avg(l_quantity) FILTER (WHERE l_returnflag = 'A') / 5.0 AS Kp_real,
    CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS DOUBLE) AS AE
  FROM lineitem GROUP BY 1)"""


def raw_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as untidy catalogue rows: stray blanks, @ signs, lower case, bad dates, missing codes."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    code = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(" esd"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit("@ECEMP "))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit(" @@seu "))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("unk"))
        .when(F.col("o_orderstatus") == "F", F.lit("rfi"))
        .when(F.col("o_orderstatus") == "P", F.lit("Sdc"))
    )
    orbit = F.when(F.col("o_orderstatus") == "O", "g").when(F.col("o_orderstatus") == "F", " p").otherwise("@e")
    return table(spark, folder, "orders").select(
        key.alias("event_id"),
        F.col("o_totalprice").alias("weight"),
        F.date_format(F.date_trunc("month", "o_orderdate"), "yyyy-MM-dd").alias("EDATE"),
        F.when(key % 97 == 0, F.lit("n/a")).otherwise(day).alias("ADATE"),
        F.when(cust % 17 != 0, F.concat(F.lit(" @sat-"), cust.cast("string"), F.lit(" "))).alias("BIRD"),
        F.when(key % 13 == 0, F.lit(9999)).otherwise((key % 2400).cast("int")).alias("STIMEU"),
        orbit.alias("ORBIT"),
        code.alias("ADIAG"),
    )


def events_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    return clean_catalogue(raw_catalogue(spark, folder))


# The cleaned catalogue straight from orders.
CATALOGUE_SQL = """catalogue AS (
  SELECT *, coalesce(ADIAG IN ('ESD', 'ECEMP', 'SEU'), false) AS is_environmental FROM (
    SELECT o_orderkey AS event_id, o_totalprice AS weight,
      CAST(o_orderdate AS DATE) AS anomaly_date,
      CAST(date_trunc('month', o_orderdate) AS DATE) AS catalog_entry_date,
      CASE WHEN o_custkey % 17 <> 0 THEN 'SAT-' || o_custkey END AS BIRD,
      CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 2400 <> 9999 THEN o_orderkey % 2400 END AS event_time_utc,
      CASE o_orderstatus WHEN 'O' THEN 'G' WHEN 'F' THEN 'P' ELSE 'E' END AS ORBIT,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'ESD' WHEN '2-HIGH' THEN 'ECEMP' WHEN '3-MEDIUM' THEN 'SEU'
        WHEN '4-NOT SPECIFIED' THEN 'UNK'
        ELSE CASE o_orderstatus WHEN 'F' THEN 'RFI' WHEN 'P' THEN 'SDC' END END AS ADIAG
    FROM orders WHERE o_orderkey % 97 <> 0))"""

DAILY_COUNTS = ["n_anomalies", "n_esd", "n_ecemp", "n_seu", "n_rfi", "n_sdc", "n_unk"]


def labels_sql(source: str = "catalogue", name: str = "labels_daily", counted: str = "is_environmental") -> str:
    """The gap-free daily label panel of a cleaned catalogue."""
    classes = ",\n      ".join(
        f"count(*) FILTER (WHERE ADIAG = '{c.upper()}' AND BIRD IS NOT NULL) AS n_{c}"
        for c in ("esd", "ecemp", "seu", "rfi", "sdc", "unk")
    )
    filled = ", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in DAILY_COUNTS)
    return f"""{name}_seen AS (
    SELECT anomaly_date AS date, count(*) FILTER (WHERE {counted}) AS n_anomalies,
      {classes}
    FROM {source} WHERE {counted} OR ADIAG IS NOT NULL GROUP BY 1),
  {name}_days AS (
    SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM {name}_seen),
  {name} AS (
    SELECT date, {filled}, coalesce(n_anomalies, 0) > 0 AS any_anomaly,
      coalesce(n_esd, 0) + coalesce(n_ecemp, 0) + coalesce(n_seu, 0) > 0 AS any_environmental
    FROM {name}_days LEFT JOIN {name}_seen USING (date))"""


def rare_labels(spark: SparkSession, folder: str) -> DataFrame:
    """0/1 label per day of the order calendar: whether the day's first order, by key, is urgent. A day's rule, whatever the table's size."""
    orders = table(spark, folder, "orders")
    first = F.min_by("o_orderpriority", "o_orderkey") == "1-URGENT"
    daily = orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(first.cast("bigint").alias("n_anomalies"))
    return fill_calendar(daily, fills={"n_anomalies": 0}).select(
        "date", "n_anomalies", (F.col("n_anomalies") > 0).alias("any_environmental")
    )


RARE_SQL = """rare_seen AS (
    SELECT CAST(o_orderdate AS DATE) AS date, CAST(arg_min(o_orderpriority, o_orderkey) = '1-URGENT' AS BIGINT) AS n_anomalies
    FROM orders GROUP BY 1),
  rare_days AS (
    SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM rare_seen),
  rare AS (
    SELECT date, coalesce(n_anomalies, 0) AS n_anomalies, coalesce(n_anomalies, 0) > 0 AS any_environmental
    FROM rare_days LEFT JOIN rare_seen USING (date))"""

LONG_CUTS = {"train": "1998-12-31", "val": "1999-12-31", "test": "2001-08-01"}
FOLD_SQL = """CASE WHEN date <= DATE '1998-12-31' THEN 'train' WHEN date <= DATE '1999-12-31' THEN 'val'
  WHEN date <= DATE '2001-08-01' THEN 'test' END"""


def line_scores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        (F.col("l_discount") * 10.0).alias("p"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.col("l_linestatus").alias("model"),
    )


def event_scores(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        (F.col("value") / (F.col("value") + 50.0)).alias("p"),
        (F.col("event_type") == "error").cast("int").alias("y"),
    )


LINE_SQL = """scores AS (SELECT l_discount * 10.0 AS p, CAST(l_returnflag = 'R' AS INTEGER) AS y,
  l_linestatus AS model FROM lineitem)"""
EVENT_SQL = "scores AS (SELECT value / (value + 50.0) AS p, CAST(event_type = 'error' AS INTEGER) AS y FROM events)"


def rounded(df: DataFrame, digits: int = 8) -> DataFrame:
    """Round doubles and write dates as text, so that engines that sum in another order compare equal."""
    out = []
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            # adding 0.0 turns a negative zero into zero
            text = f"round(CAST(`{name}` AS DOUBLE), {digits}) + 0.0D"
        elif kind == "date":
            text = f"date_format(`{name}`, 'yyyy-MM-dd')"
        elif kind.startswith("timestamp"):
            text = f"date_format(`{name}`, 'yyyy-MM-dd HH:mm:ss')"
        elif kind in ("int", "smallint", "tinyint", "boolean"):
            text = f"CAST(`{name}` AS BIGINT)"
        else:
            text = f"`{name}`"
        out.append(f"{text} AS `{name}`")
    return df.selectExpr(*out)


def rounded_sql(body: str, doubles: str = "", ints: str = "", texts: str = "", digits: int = 8, ctes: str = "") -> str:
    """The matching SQL: ``body`` is a FROM clause, the names list its columns by kind."""
    columns = [f"round(CAST({c} AS DOUBLE), {digits}) + 0.0 AS {c}" for c in doubles.split()]
    columns += [f"CAST({c} AS BIGINT) AS {c}" for c in ints.split()]
    columns += [f"CAST({c} AS VARCHAR) AS {c}" for c in texts.split()]
    return (f"WITH {ctes}\n" if ctes else "") + f"SELECT {', '.join(columns)}\n{body}"
