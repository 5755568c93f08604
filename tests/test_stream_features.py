"""Features of a stream from keyed state against the batch features."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from dayrisk.operators.windows import BLOCK, hourly_features
from dayrisk.streaming.features import row_features, stream_features

SCHEMA = "series string, ts timestamp, Bz_gsm double, Dst double"
START = dt.datetime(2024, 1, 1)


def hours(seed, n, series):
    rng = np.random.default_rng(seed)
    at = np.flatnonzero(rng.random(n) < 0.9)  # with gaps
    value = lambda: None if rng.random() < 0.1 else float(rng.normal(0, 40))
    return [(series, START + dt.timedelta(hours=int(h)), value(), value()) for h in at]


def run(spark, folder, increments, **options):
    """Each increment arrives and is taken by a run of its own; state goes on."""
    for k, rows in enumerate(increments):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        made = stream_features(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), ["Bz_gsm"], **options)
        stream = made.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
        stream.awaitTermination()
        assert stream.exception() is None
    return spark.read.schema(made.schema).parquet(f"{folder}/out").toPandas().sort_values(["series", "ts"], na_position="first").reset_index(drop=True)


def batch(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = hourly_features(df, ["Bz_gsm"], keys=["series"], block_days=30).drop(BLOCK).toPandas()
    return out.sort_values(["series", "ts"], na_position="first").reset_index(drop=True)


def test_increments_out_of_order_and_late_hours(spark, tmp_path):
    rows = hours(1, 90, "a") + hours(2, 90, "b") + hours(3, 60, None)
    order = sorted(rows, key=lambda r: (r[1] + dt.timedelta(hours=(hash(r[1].hour) * 7 % 3))))  # by up to two hours out of order
    parts = [[r for r in order if (r[1] - START).days * 24 + r[1].hour in span] for span in (range(0, 30), range(30, 60), range(60, 100))]
    late = [("a", START + dt.timedelta(hours=2, minutes=30), 999.0, -999.0), (None, START + dt.timedelta(hours=1, minutes=1), 999.0, 0.0)]
    again = [(*r[:2], 777.0, 777.0) for r in parts[1][-2:]]  # a repeated hour that is still open, or passed
    got = run(spark, str(tmp_path), [parts[0], parts[1] + late, parts[2] + again])
    passed = max(r[1] for r in rows) - dt.timedelta(hours=2)
    want = batch(spark, rows)
    want = want[want.ts <= passed].reset_index(drop=True)
    assert got[["series", "ts"]].fillna("").equals(want[["series", "ts"]].fillna("")) and len(got) > 150
    for c in want.columns[2:]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-9, err_msg=c)


def test_a_silent_series_is_forgotten_on_request(spark, tmp_path):
    one = [("a", START + dt.timedelta(hours=h), float(h), 0.0) for h in range(3)]
    other = [("b", START + dt.timedelta(days=20, hours=h), 1.0, 0.0) for h in range(6)]
    back = [("a", START + dt.timedelta(days=21, hours=h), 50.0 + h, 0.0) for h in range(2)] + [("b", START + dt.timedelta(days=22), 1.0, 0.0)]
    got = run(spark, str(tmp_path / "forget"), [one, other, back], forget=86_400)
    kept = run(spark, str(tmp_path / "keep"), [one, other, back])
    first = lambda df: df[(df.series == "a") & (df.ts == START + dt.timedelta(days=21))]["Bz_gsm_lag1h"].iloc[0]
    assert np.isnan(first(got)) and first(kept) == 2.0


@pytest.mark.parametrize("known", [0, 5])
def test_row_features_follow_the_definitions(known):
    rng = np.random.default_rng(4)
    x = np.where(rng.random((40, 2)) < 0.2, np.nan, rng.normal(0, 40, (40, 2)))
    made = row_features(x, known, ["u", "v"], (1, 3), (6,), 1)
    s = pd.Series(x[:, 0])
    before = s.shift(1).rolling(6, min_periods=3)
    np.testing.assert_allclose(made["u_lag3h"], s.shift(3)[known:], atol=0)
    np.testing.assert_allclose(made["u_rmean6h"], before.mean()[known:], atol=1e-9)
    np.testing.assert_allclose(made["u_rstd6h"], before.std()[known:], atol=1e-9)
    change = pd.Series(x[:, 1]).diff()
    np.testing.assert_array_equal(made["phase_main"], ((x[:, 1] <= -30) & (change < 0)).astype(int)[known:])
    assert (made["phase_quiet"] + made["phase_main"] + made["phase_recovery"] == 1).all()


def test_many_series_share_states_and_calls(spark, tmp_path):
    rows = [r for s in range(30) for r in hours(s, 60, f'"{s}"\\')] + hours(99, 60, None)
    parts = [[r for r in rows if (r[1] - START).total_seconds() // 3600 in span] for span in (range(0, 25), range(25, 40), range(40, 60))]
    got = run(spark, str(tmp_path), parts, groups=3)
    held = [r for r in spark.read.format("state-metadata").load(f"{tmp_path}/state").collect()]
    states = spark.read.format("statestore").load(f"{tmp_path}/state").count()
    assert len(held) == 1 and states <= 3  # one for each series before
    want = batch(spark, rows)
    want = want[want.ts <= max(r[1] for r in rows) - dt.timedelta(hours=2)].reset_index(drop=True)
    assert got[["series", "ts"]].fillna("").equals(want[["series", "ts"]].fillna("")) and len(got) > 1000
    for c in want.columns[2:]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-9, err_msg=c)


def test_series_of_one_group_are_forgotten_one_by_one(spark, tmp_path):
    one = [("a", START + dt.timedelta(hours=h), float(h), 0.0) for h in range(3)]
    other = [("b", START + dt.timedelta(days=20, hours=h), 1.0, 0.0) for h in range(6)]
    back = [("a", START + dt.timedelta(days=21, hours=h), 50.0 + h, 0.0) for h in range(2)] + [("b", START + dt.timedelta(days=22), 1.0, 0.0)]
    apart, shared = [run(spark, str(tmp_path / str(n)), [one, other, back], forget=86_400, groups=n) for n in (4096, 1)]
    assert shared.equals(apart) and len(shared) == 11
    assert np.isnan(shared[(shared.series == "a") & (shared.ts == START + dt.timedelta(days=21))]["Bz_gsm_lag1h"].iloc[0])
