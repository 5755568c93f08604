import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dayrisk.functions.scalars import decide, even_grid, grid_index, interval_label, positive_part, southward
from dayrisk.operators.columns import interaction_names, interactions, one_hot
from dayrisk.operators.daily import dominant_phase, fill_calendar, to_daily
from dayrisk.operators.folds import expanding_folds, holdout_cut, stratified_folds
from dayrisk.operators.labels import fold_column, next_label
from dayrisk.operators.windows import in_time_blocks, BLOCK, hourly_features
from dayrisk.plans.panel import FeaturePanel, FittedPanel, PanelConfig, coupling_features, daily_features, feature_groups, fit_panel

START = pd.Timestamp("2020-01-01")


def gappy(seed, n=1500, keep=0.8, jump=None):
    rng = np.random.default_rng(seed)
    hours = np.flatnonzero(rng.random(n) < keep)
    if jump:
        hours = hours[(hours < jump[0]) | (hours > jump[1])]
    frame = pd.DataFrame({"ts": START + pd.to_timedelta(hours, unit="h")})
    for name in ("Bz_gsm", "flow_speed", "flow_pressure", "Dst"):
        values = rng.normal(0, 30, len(frame)).round(1)
        values[rng.random(len(frame)) < 0.1] = np.nan
        frame[name] = values
    return frame


def to_spark(spark, pdf):
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    schema = ", ".join(f"{c} {'timestamp' if c == 'ts' else 'string' if c == 's' else 'double'}" for c in pdf.columns)
    return spark.createDataFrame([tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in r) for r in rows], schema)


def expected_rows(pdf, name):
    s = pdf.set_index("ts")[name]
    out = {f"{name}_lag{k}h": s.shift(k) for k in (1, 3, 6, 24)}
    for w in (6, 24):
        roll = s.shift(1).rolling(w, min_periods=max(2, w // 2))
        out[f"{name}_rmean{w}h"], out[f"{name}_rstd{w}h"] = roll.mean(), roll.std()
    return pd.DataFrame(out)


@pytest.mark.parametrize("block_days, keep, jump", [(366, 0.8, None), (2, 0.8, None), (1, 0.3, None), (1, 0.05, (200, 900)), (3, 0.9, (100, 700))])
def test_blocks_equal_one_window(spark, block_days, keep, jump):
    pdf = gappy(block_days, keep=keep, jump=jump)
    got = hourly_features(to_spark(spark, pdf), ["Bz_gsm", "Dst"], storm_driver=None, block_days=block_days)
    got = got.drop(BLOCK).toPandas().sort_values("ts").set_index("ts")
    assert len(got) == len(pdf)
    for name in ("Bz_gsm", "Dst"):
        want = expected_rows(pdf, name)
        np.testing.assert_allclose(got[want.columns].to_numpy(dtype=float), want.to_numpy(), atol=1e-9)


def test_series_do_not_mix(spark):
    a, b = gappy(1, 300), gappy(2, 300)
    both = pd.concat([a.assign(s="a"), b.assign(s="b")])
    got = hourly_features(to_spark(spark, both), ["Dst"], keys=["s"], storm_driver=None, block_days=1).toPandas()
    for name, pdf in (("a", a), ("b", b)):
        part = got[got.s == name].sort_values("ts").set_index("ts")
        want = expected_rows(pdf, "Dst")
        np.testing.assert_allclose(part[want.columns].to_numpy(dtype=float), want.to_numpy(), atol=1e-9)


def test_time_mode_looks_back_by_the_clock(spark):
    pdf = gappy(3, 400, keep=0.6)
    got = hourly_features(to_spark(spark, pdf), ["Dst"], (3,), (6,), storm_driver=None, block_days=1, gap_mode="time")
    got = got.toPandas().sort_values("ts").set_index("ts")
    grid = pdf.set_index("ts")["Dst"].reindex(pd.date_range(pdf.ts.min(), pdf.ts.max(), freq="h"))
    want = pd.DataFrame({"lag": grid.shift(3), "mean": grid.shift(1).rolling(6, min_periods=3).mean()}).loc[pdf.ts]
    np.testing.assert_allclose(got[["Dst_lag3h", "Dst_rmean6h"]].to_numpy(dtype=float), want.to_numpy(), atol=1e-9)


def test_block_must_exceed_look_back(spark):
    with pytest.raises(ValueError):
        hourly_features(to_spark(spark, gappy(1, 50)), ["Dst"], (1, 48), block_days=1)
    with pytest.raises(ValueError):
        hourly_features(to_spark(spark, gappy(1, 50)), ["Dst"], gap_mode="days")


def test_storm_phase_edges(spark):
    level = [-10.0, -30.0, -40.0, -40.0, None, -50.0, -60.0]
    pdf = pd.DataFrame({"ts": [START + pd.Timedelta(hours=i) for i in range(len(level))], "Dst": level})
    rows = hourly_features(to_spark(spark, pdf), ()).orderBy("ts").collect()
    names = ["quiet", "main", "recovery"]
    got = [names[[r["phase_quiet"], r["phase_main"], r["phase_recovery"]].index(1)] for r in rows]
    # first row and rows next to a gap have no change and count as quiet
    assert got == ["quiet", "main", "main", "recovery", "quiet", "quiet", "main"]


def test_absent_drivers_are_skipped(spark):
    pdf = gappy(5, 100)[["ts", "Bz_gsm"]]
    out = hourly_features(to_spark(spark, pdf), ["Bz_gsm", "AE"])
    assert not [c for c in out.columns if c.startswith(("AE", "phase"))]


def test_daily_collapse_fills_days(spark):
    pdf = gappy(6, 240, keep=0.7, jump=(60, 130))
    daily = to_daily(to_spark(spark, pdf), {"m": F.avg("Dst"), "n": F.count("Dst")}).orderBy("date").toPandas()
    want = pdf.set_index("ts")["Dst"].resample("1D").mean()
    np.testing.assert_allclose(daily["m"].to_numpy(dtype=float), want.to_numpy(), atol=1e-12)
    assert len(daily) == len(want) and daily["n"].isna().sum() == 2


def test_daily_panel_matches_pandas(spark):
    pdf = gappy(7, 900, keep=0.9, jump=(300, 380))
    config = PanelConfig(drivers=("Bz_gsm", "flow_speed", "flow_pressure", "Dst"), include_coupling=True, block_days=5)
    got = daily_features(to_spark(spark, pdf), config).orderBy("date").toPandas().set_index("date")
    s = pdf.set_index("ts")
    want = pd.concat([expected_rows(pdf, d) for d in config.drivers], axis=1).resample("1D").mean()
    e = s.flow_speed * (-s.Bz_gsm).clip(lower=0) * 1e-3
    want["coupling_Ey_mean"], want["coupling_Ey_max"] = e.resample("1D").mean(), e.resample("1D").max()
    want["frac_southward"] = (s.Bz_gsm < 0).resample("1D").mean()
    want["pdyn_shock"] = s.flow_pressure.diff().clip(lower=0).resample("1D").max()
    ddt = s.Dst.diff()
    main, recovery = (s.Dst <= -30) & (ddt < 0), (s.Dst <= -30) & (ddt >= 0)
    for name, flag in (("quiet", ~(main | recovery)), ("main", main), ("recovery", recovery)):
        want[f"phase_{name}"] = flag.astype(int).resample("1D").max()
    angle = 2 * np.pi * want.index.dayofyear.values / 366.0
    want["doy_sin"], want["doy_cos"] = np.sin(angle), np.cos(angle)
    assert set(got.columns) == set(want.columns) and len(want.columns) == 4 * 8 + 3 + 2 + 4
    np.testing.assert_allclose(got[want.columns].to_numpy(dtype=float), want.to_numpy(dtype=float), atol=1e-9)
    alone = coupling_features(to_spark(spark, pdf), block_days=5).orderBy("date").toPandas()
    np.testing.assert_allclose(alone["pdyn_shock"].to_numpy(dtype=float), want["pdyn_shock"].to_numpy(), atol=1e-9)


def test_default_panel_has_85_and_89_columns(spark):
    names = ["B_mag_avg", "Bz_gsm", "flow_speed", "proton_density", "flow_pressure", "Kp_real", "Dst", "AE", "F107", "ap"]
    pdf = pd.DataFrame({"ts": [START + pd.Timedelta(hours=i) for i in range(30)]} | {n: np.arange(30.0) for n in names})
    df = to_spark(spark, pdf)
    assert len(daily_features(df).columns) == 86
    wide = daily_features(df, PanelConfig(include_coupling=True)).columns
    assert len(wide) == 90
    assert {k: len(v) for k, v in feature_groups(wide).items()} == {"lag": 40, "roll": 40, "phase": 3, "season": 2, "coupling": 4}


def test_one_shuffle_serves_windows_and_days(spark):
    pdf = gappy(8, 200)
    rows = hourly_features(to_spark(spark, pdf), ["Dst"], block_days=2)
    daily = to_daily(rows, {"m": F.avg("Dst_lag1h")}, also_by=[BLOCK], fill=False)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    above_window = plan[: plan.index("Window")]
    assert "Exchange" not in above_window


def test_calendar_keeps_series_apart(spark):
    rows = [("a", dt.date(2020, 1, 1), 1), ("a", dt.date(2020, 1, 4), 2), ("b", dt.date(2020, 3, 1), 3)]
    df = spark.createDataFrame(rows, "s string, date date, n int")
    got = {(r["s"], r["date"].day): r["n"] for r in fill_calendar(df, ["s"], fills={"n": 0}).collect()}
    assert got == {("a", 1): 1, ("a", 2): 0, ("a", 3): 0, ("a", 4): 2, ("b", 1): 3}


def test_dominant_phase_prefers_quiet(spark):
    df = spark.createDataFrame([(1, 1, 1), (0, 1, 1), (0, 0, 1), (None, None, None)], "q int, m int, r int")
    got = [r[0] for r in df.select(dominant_phase(F.col("q"), F.col("m"), F.col("r"))).collect()]
    assert got == ["phase_quiet", "phase_main", "phase_recovery", None]


def test_scalar_nulls_and_bins(spark):
    df = spark.createDataFrame([(None,), (-2.0,), (2.0,), (3.0,), (5.3,), (9.5,)], "x double")
    rows = df.select(
        positive_part(F.col("x")).alias("p"), southward(F.col("x")).alias("s"),
        interval_label(F.col("x"), [(-2.0, 2.0, "low"), (2.0, 3.0, "mid"), (3.0, 9.0, "high")]).alias("b"),
    ).collect()
    assert [r["p"] for r in rows] == [None, 0.0, 2.0, 3.0, 5.3, 9.5]
    assert [r["s"] for r in rows] == [0, 1, 0, 0, 0, 0]
    assert [r["b"] for r in rows] == [None, None, "low", "mid", "high", None]


@pytest.mark.parametrize("start, stop, points", [(0.0, 1.0, 11), (0.0, 0.5, 50), (0.05, 0.95, 91)])
def test_grid_index_is_numpy_digitize(spark, start, stop, points):
    grid = even_grid(start, stop, points)
    rng = np.random.default_rng(0)
    values = np.concatenate([grid, np.nextafter(grid, -1), np.nextafter(grid, 2), rng.random(200), [i / 10 for i in range(11)], [-0.2, 1.2]])
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    got = [r["k"] for r in df.select("i", grid_index(F.col("v"), grid).alias("k")).orderBy("i").collect()]
    assert got == list(np.digitize(values, grid) - 1)


def test_decisions(spark):
    df = spark.createDataFrame([(0.5,), (0.56,), (0.44,), (0.55,), (None,)], "p double")
    assert [r[0] for r in df.select(decide(F.col("p"), 0.05)).collect()][:3] == ["ABSTAIN", "ALERT", "NO ALERT"]
    assert df.select(decide(F.col("p"), 0.05).alias("d")).where("d is null").count() == 1


def days(spark, labels):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(i), int(v)) for i, v in enumerate(labels)]
    return spark.createDataFrame(rows, "date date, y int")


def test_label_moves_before_the_fold_is_cut(spark):
    labels = days(spark, [0, 1, 0, 1])
    ahead = next_label(labels, "y").withColumn("fold", fold_column(F.col("date"), {"train": "2020-01-01", "val": "2020-01-03"}))
    rows = ahead.orderBy("date").collect()
    assert [r["target"] for r in rows] == [1, 0, 1, None]
    assert [r["fold"] for r in rows] == ["train", "val", "val", None]


@pytest.mark.parametrize("n, seed", [(30, 0), (47, 1), (100, 2)])
def test_folds(spark, n, seed):
    y = (np.random.default_rng(seed).random(n) < 0.3).astype(int)
    df = days(spark, y)
    parts = [r["part"] for r in holdout_cut(df).orderBy("date").collect()]
    assert parts == ["fit"] * int(0.8 * n) + ["calibrate"] * (n - int(0.8 * n))
    width = n // 6
    tested = [r["test_fold"] for r in expanding_folds(df).orderBy("date").collect()]
    assert tested == [0] * (n - 5 * width) + [k for k in range(1, 6) for _ in range(width)]
    # the textbook dealing-out of class-sorted labels
    codes = np.unique(np.unique(y, return_index=True)[1], return_inverse=True)[1][y]
    order = np.sort(codes)
    want = np.empty(n, dtype=int)
    for k in np.unique(codes):
        quota = [int((order[i::5] == k).sum()) for i in range(5)]
        want[codes == k] = np.repeat(np.arange(5), quota)
    assert [r["cv_fold"] for r in stratified_folds(df, "y").orderBy("date").collect()] == list(want)


def test_columns(spark):
    df = spark.createDataFrame([(2.0, 3.0, 5.0, 1)], "a double, b double, c double, k int")
    row = interactions(df, ["a", "b", "c"]).first()
    assert list(row) == [2.0, 3.0, 5.0, 6.0, 10.0, 15.0]
    assert len(interaction_names([str(i) for i in range(16)])) == 136
    assert list(df.select(*one_hot(F.col("k"), [0, 1, 2], "k")).first()) == [1, 0]


def panel_inputs(spark, seed=9, n=24 * 60):
    pdf = gappy(seed, n, keep=0.95)
    rng = np.random.default_rng(seed)
    labels = [(dt.date(2020, 1, 1) + dt.timedelta(i), bool(v)) for i, v in enumerate(rng.random(n // 24) < 0.3)]
    return pdf, spark.createDataFrame(labels, "date date, any_environmental boolean")


def test_fit_uses_training_rows_only(spark):
    pdf, labels = panel_inputs(spark)
    config = PanelConfig(drivers=("Bz_gsm", "Dst"))
    train = F.col("date") <= F.lit("2020-02-10").cast("date")
    panel = FeaturePanel(config)
    scaled = panel.fit_transform(to_spark(spark, pdf), labels, train).toPandas()
    raw = panel.build(to_spark(spark, pdf), labels).where(train).toPandas()
    for name, _, median, mean, std in panel.fitted.params:
        values = raw[name].astype(float)
        filled = values.fillna(values.median())
        assert median == pytest.approx(values.median(), abs=1e-9)
        assert mean == pytest.approx(filled.mean(), abs=1e-9)
        assert (std or 1.0) == pytest.approx(filled.std(ddof=0) if filled.nunique() > 1 else 1.0, abs=1e-9)
        assert scaled[name].mean() == pytest.approx(0.0, abs=1e-9)
    late = pdf.copy()
    late.loc[late.ts > pd.Timestamp("2020-02-11"), ["Bz_gsm", "Dst"]] = 1e6
    other = FeaturePanel(config)
    other.fit_transform(to_spark(spark, late), labels, train)
    for (name, _, *a), (_, _, *b) in zip(panel.fitted.params, other.fitted.params):
        np.testing.assert_allclose(a, b, atol=1e-9, err_msg=name)


def test_later_hours_do_not_change_a_day(spark):
    pdf, labels = panel_inputs(spark)
    config = PanelConfig(drivers=("Bz_gsm", "Dst"), include_coupling=True)
    cut = pd.Timestamp("2020-02-01")
    late = pdf.copy()
    late.loc[late.ts >= cut, ["Bz_gsm", "flow_speed", "flow_pressure", "Dst"]] = -777.0
    a = daily_features(to_spark(spark, pdf), config).where(F.col("date") < "2020-02-01").orderBy("date").toPandas()
    b = daily_features(to_spark(spark, late), config).where(F.col("date") < "2020-02-01").orderBy("date").toPandas()
    pd.testing.assert_frame_equal(a, b)


def test_fitted_panel_errors_and_round_trip(spark):
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None), (None, 5.0, None), (10.0, 5.0, None)], "a double, b double, c double")
    with pytest.raises(ValueError, match="c"):
        fit_panel(df, ["a", "c"])
    with pytest.raises(RuntimeError):
        FittedPanel().transform(df)
    with pytest.raises(RuntimeError):
        FeaturePanel().transform(df, df)
    fitted = fit_panel(df, ["a", "b"])
    assert fitted.params[0][2] == 2.0 and fitted.params[1][4] == 0.0
    with pytest.raises(KeyError):
        fitted.transform(df.drop("a"))
    assert FittedPanel.from_frame(fitted.to_frame(spark)).params == fitted.params
    assert [r["b"] for r in fitted.transform(df).collect()] == [0.0] * 4


@pytest.mark.parametrize("gap_mode", ["rows", "time"])
def test_rows_of_a_null_series_stay(spark, gap_mode):
    start = dt.datetime(2020, 1, 1)
    rows = [(k, start + dt.timedelta(hours=i), float(i)) for k in ("a", "b", None) for i in range(60)]
    df = spark.createDataFrame(rows, "series string, ts timestamp, v double")
    got = in_time_blocks(df, "ts", 3, ["series"], block_days=1, gap_mode=gap_mode)
    assert got.where("_own").groupBy("series").count().count() == 3 and got.where("_own").count() == 180


def test_hourly_rows_of_many_series_are_dealt_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hour = F.timestamp_seconds(F.lit(1_600_000_000) + F.floor(F.col("id") / 5) * 3600)
        rows = spark.range(40_000).select((F.col("id") % 5).alias("user"), hour.alias("ts"), F.randn(1).alias("Bz_gsm"), F.randn(2).alias("Dst"))
        daily = daily_features(rows, PanelConfig(drivers=("Bz_gsm", "Dst"), keys=("user",), block_days=60))
        daily.collect()
        plan = daily._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan[: plan.index("== Initial Plan")].splitlines() if "Exchange" in line]
        dealt = [line for line in exchanges if "REPARTITION_BY_COL" in line and "ReusedExchange" not in line]
        assert len([line for line in dealt if "_home" in line]) == 1 and len([line for line in dealt if "_block" in line]) == 1
        assert any("ReusedExchange" in line and "Bz_gsm" in line for line in exchanges)
        # what else moves is counts, the last rows of blocks and days
        assert not any("_home" not in line and "Dst" in line for line in exchanges if "ReusedExchange" not in line)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
