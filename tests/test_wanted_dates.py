"""Feature rows of wanted dates equal those of the whole history, from fewer hours and files."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dayrisk.plans.panel import PanelConfig, daily_features
from dayrisk.plans.scoring import needed_days, rows_for_dates, stored_rows_for_dates
from dayrisk.sources.hourly_text import read_hourly_table, write_hourly_table

DRIVERS = ("Bz_gsm", "Dst")


@pytest.fixture(scope="module")
def hourly(spark):
    rng = np.random.default_rng(1)
    parts = []
    for series, start, days in (("a", "2019-12-20", 40), ("b", "2018-06-01", 700), (None, "2019-12-25", 30)):
        ts = pd.date_range(start, periods=days * 24, freq="h")
        keep = rng.random(len(ts)) < (0.05 if series == "b" else 0.8)  # a thin series looks back over many days
        parts.append(pd.DataFrame({"series": series, "ts": ts[keep], "Bz_gsm": rng.normal(0, 5, keep.sum()), "Dst": rng.normal(-20, 20, keep.sum())}))
    return spark.createDataFrame(pd.concat(parts), "series string, ts timestamp, Bz_gsm double, Dst double").persist()


@pytest.mark.parametrize("mode", ["rows", "time"])
def test_the_same_rows_from_fewer_hours(spark, hourly, mode):
    config = PanelConfig(drivers=DRIVERS, keys=("series",), block_days=30, gap_mode=mode)
    dates = spark.createDataFrame([(d,) for d in (dt.date(2019, 12, 22), dt.date(2020, 1, 1), dt.date(2020, 1, 20), dt.date(2030, 1, 1))], "date date")
    got = rows_for_dates(hourly, dates, config).toPandas().sort_values(["series", "date"]).reset_index(drop=True)
    there = hourly.select("series", F.to_date("ts").alias("date")).distinct().join(dates, "date")
    whole = daily_features(hourly, config).alias("w").join(there.alias("t"), F.expr("w.series <=> t.series AND w.date = t.date"), "left_semi")
    want = whole.toPandas().sort_values(["series", "date"]).reset_index(drop=True)
    assert len(got) >= 6
    pd.testing.assert_frame_equal(got, want, check_exact=False, atol=1e-9)
    days = needed_days(hourly, dates, config)
    assert days.count() < 0.3 * hourly.select("series", F.to_date("ts")).distinct().count()


def test_files_of_other_years_are_not_opened(spark, hourly, tmp_path):
    config = PanelConfig(drivers=DRIVERS, block_days=30)
    rows = hourly.where("series = 'a' OR (series = 'b' AND ts < '2019-06-01')").drop("series")
    path = str(tmp_path / "hours")
    write_hourly_table(rows, path)
    dates = spark.createDataFrame([(dt.date(2020, 1, 5),), (dt.date(2020, 1, 6),)], "date date")
    got = stored_rows_for_dates(spark, path, dates, config).toPandas().sort_values("date")
    want = rows_for_dates(rows, dates, config).toPandas().sort_values("date")
    pd.testing.assert_frame_equal(got.reset_index(drop=True), want.reset_index(drop=True), atol=1e-9)
    plan = read_hourly_table(spark, path, [2020])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "2020" in plan[plan.index("PartitionFilters"):]
    assert {f.split("year=")[1][:4] for f in read_hourly_table(spark, path, [2020]).inputFiles()} >= {"2020"}
