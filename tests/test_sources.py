import datetime as dt

import pytest

from dayrisk import session
from dayrisk.constants import CATALOGUE_COLUMNS, DIAGNOSES, HOURLY_FIELDS, ORBITS, SENTINELS
from dayrisk.functions.cleaning import drop_all_null, sentinels_to_null
from dayrisk.operators.labels import class_pivot, coverage_report, daily_event_counts, date_audit
from dayrisk.operators.lookup import describe_codes
from dayrisk.sources.catalogue import clean_catalogue, read_catalogue
from dayrisk.sources.hourly_text import read_hourly_table, read_hourly_text, write_hourly_table


def record(year, doy, hour, **values):
    row = {f: 1.0 for f in HOURLY_FIELDS} | {"year": year, "doy": doy, "hour": hour, "Kp": 23} | values
    return "  ".join(f"{row[f]:>6}" for f in HOURLY_FIELDS)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("hourly")
    for year, days in ((2015, 365), (2016, 366)):
        lines = []
        for doy in range(1, days + 1):
            for hour in range(24):
                extra = {"B_mag_avg": 999.9} if hour == 3 else {}
                lines.append(record(year, doy, hour, **extra))
        (root / f"omni2_{year}.dat").write_text("\n".join(lines) + "\n\n")
    return str(root)


def test_one_year_has_all_its_hours(spark, folder):
    df = read_hourly_text(spark, folder, [2015])
    assert df.count() == 8760
    first, last = df.selectExpr("min(ts) a", "max(ts) b").first()
    assert first == dt.datetime(2015, 1, 1) and last == dt.datetime(2015, 12, 31, 23)
    assert df.select("ts").distinct().count() == 8760
    assert dict(df.dtypes)["ts"] == "timestamp"
    assert not {"year", "doy", "hour"} & set(df.columns)


def test_leap_day_and_year_pruning(spark, folder):
    both = read_hourly_text(spark, folder, [2014, 2015, 2016], wanted=["Dst"])
    assert both.count() == 8760 + 8784
    assert both.columns == ["ts", "Dst"]
    only = read_hourly_text(spark, folder, [2016], wanted=["Dst"])
    assert len(only.inputFiles()) == 1
    assert only.selectExpr("max(ts) m").first()["m"] == dt.datetime(2016, 12, 31, 23)


def test_no_file_at_all_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        read_hourly_text(spark, folder, [1950])


def test_index_is_decoded_and_sentinels_go(spark, folder):
    df = read_hourly_text(spark, folder, [2015], wanted=["B_mag_avg", "Kp_real"])
    low, high, big, missing = df.selectExpr("min(Kp_real)", "max(Kp_real)", "max(abs(B_mag_avg))", "count_if(B_mag_avg is null)").first()
    assert 0 <= low <= high <= 9 and big < 900 and missing == 365


def test_table_round_trip_prunes_years(spark, folder, tmp_path):
    path = str(tmp_path / "hours")
    write_hourly_table(read_hourly_text(spark, folder, wanted=["Dst", "AE"]), path)
    back = read_hourly_table(spark, path, [2016])
    assert back.count() == 8784
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "year#" in plan.split("PartitionFilters")[1][:80]


def test_short_lines_blanks_and_thresholds(spark, tmp_path):
    text = ["\t2015   1  0  5", " " * 8, record(2015, 1, 1, proton_temp=999999.0, Dst=-99999, flow_pressure=98.99, AE=9999)]
    (tmp_path / "omni2_2015.dat").write_text("\n".join(text))
    rows = {r["ts"].hour: r for r in read_hourly_text(spark, str(tmp_path)).collect()}
    assert rows[0]["bartels_rotation"] == 5 and rows[0]["Dst"] is None
    assert rows[1]["proton_temp"] == 999999.0  # its limit is 1e7
    assert rows[1]["Dst"] is None and rows[1]["AE"] is None and rows[1]["flow_pressure"] == 98.99


def test_threshold_is_inclusive_and_symmetric(spark):
    df = spark.createDataFrame([(998.9, 1.0), (999.0, 1.0), (-999.0, 1.0), (float("nan"), 1.0), (None, 1.0)], "B_mag_avg double, other double")
    got = [r["B_mag_avg"] for r in sentinels_to_null(df).collect()]
    assert got == [998.9, None, None, None, None]
    assert len(SENTINELS) == 32 and len(HOURLY_FIELDS) == 55


def test_drop_all_null(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, None)], "id int, a double, b double")
    assert [r["id"] for r in drop_all_null(df, ["a", "b"]).collect()] == [2]


def test_coverage_report(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (None, 3.0), (4.0, None)], "a double, b double")
    rows = coverage_report(df, ["b", "a"]).collect()
    assert [(r["column"], r["missing"], r["present"], r["pct_missing"]) for r in rows] == [("a", 1, 3, 25.0), ("b", 3, 1, 75.0)]


CSV = """VER,EDATE,ADATE,BIRD,STIMEU,DUR,STIMEL,ORBIT,NS,EW,LAT,LON,ATYPE,ADIAG,ACOMMENT
5.0,1986-01-19,1970-02-01, @@sat-1 ,930,1.0,1000,g,N,E,1.0,2.0, pc ,esd,"a, b"
5.0,1986-01-19,1970-02-01,,9999,1.0,1000,G,N,E,1.0,2.0,PC,ECEMP,x
5.0,1986-01-19,never,SAT-3,100,1.0,1000,G,N,E,1.0,2.0,PC,SEU,x
5.0,1986-02-19,1993-03-05,SAT-4,100,1.0,1000,@p,N,E,1.0,2.0,PC, @unk ,x
5.0,1986-02-19,1993-03-06,SAT-5,100,1.0,1000,P,N,E,1.0,2.0,PC,,x
5.0,1986-02-19,1993-03-07,SAT-5,100,1.0,1000,P,N,E,1.0,2.0,PC,SEU,x
"""


@pytest.fixture(scope="module")
def catalogue(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("catalogue") / "events.csv"
    path.write_text(CSV)
    raw = read_catalogue(spark, str(path))
    assert raw.columns == CATALOGUE_COLUMNS
    return raw


def test_catalogue_cleaning(catalogue):
    rows = clean_catalogue(catalogue).orderBy("anomaly_date", "BIRD").collect()
    assert len(rows) == 5
    assert [r["anomaly_date"].year for r in rows] == [1970, 1970, 1993, 1993, 1993]
    first = next(r for r in rows if r["BIRD"] == "SAT-1")
    assert (first["ORBIT"], first["ATYPE"], first["ADIAG"], first["is_environmental"]) == ("G", "PC", "ESD", True)
    assert first["catalog_entry_date"] == dt.date(1986, 1, 19) and first["event_time_utc"] == 930
    assert next(r for r in rows if r["ADIAG"] == "ECEMP")["event_time_utc"] is None
    assert next(r for r in rows if r["ADIAG"] is None)["is_environmental"] is False
    for r in rows:
        assert r["is_environmental"] == (r["ADIAG"] in {"ESD", "ECEMP", "SEU"})


def test_unknown_class_can_be_dropped(catalogue):
    kept = {r["ADIAG"] for r in clean_catalogue(catalogue, keep_unknown=False).collect()}
    assert kept == {"ESD", "ECEMP", "SEU"}  # the row without a class goes too


def test_daily_panel_is_gap_free_and_counts_differ_without_entity(spark, catalogue):
    panel = daily_event_counts(clean_catalogue(catalogue)).orderBy("date").collect()
    days = [r["date"] for r in panel]
    assert days == [days[0] + dt.timedelta(i) for i in range(len(days))]
    assert days[0] == dt.date(1970, 2, 1) and days[-1] == dt.date(1993, 3, 7)
    assert (panel[0]["n_anomalies"], panel[0]["n_esd"], panel[0]["n_ecemp"]) == (2, 1, 0)
    by_day = {r["date"]: r for r in panel}
    unknown = by_day[dt.date(1993, 3, 5)]
    assert (unknown["n_anomalies"], unknown["n_unk"], unknown["any_anomaly"], unknown["any_environmental"]) == (0, 1, False, False)
    assert by_day[dt.date(1993, 3, 7)]["any_environmental"] is True


def test_any_anomaly_without_entity_is_not_environmental(spark):
    events = spark.createDataFrame([(dt.date(2000, 1, 1), "ESD", None, True)], "anomaly_date date, ADIAG string, BIRD string, is_environmental boolean")
    row = daily_event_counts(events).first()
    assert (row["any_anomaly"], row["any_environmental"]) == (True, False)


def test_all_classes_without_fill(spark, catalogue):
    panel = daily_event_counts(clean_catalogue(catalogue), only_environmental=False, fill=False)
    assert {r["date"]: r["n_anomalies"] for r in panel.collect()} == {
        dt.date(1970, 2, 1): 2, dt.date(1993, 3, 5): 1, dt.date(1993, 3, 6): 1, dt.date(1993, 3, 7): 1}


def test_date_audit(catalogue):
    rows = {r["column"]: r for r in date_audit(clean_catalogue(catalogue), ["anomaly_date", "catalog_entry_date"]).collect()}
    assert (rows["catalog_entry_date"]["n_dates"], rows["catalog_entry_date"]["largest_pile"]) == (2, 3)
    assert (rows["anomaly_date"]["n_dates"], rows["anomaly_date"]["largest_date"]) == (4, dt.date(1970, 2, 1))


def test_glossaries(spark):
    df = spark.createDataFrame([("G", "ESD"), ("?", None)], "ORBIT string, ADIAG string")
    named = describe_codes(describe_codes(df, "ORBIT", ORBITS, "orbit"), "ADIAG", DIAGNOSES, "diagnosis").collect()
    assert {r["ORBIT"]: r["orbit"] for r in named} == {"G": "Geostationary", "?": None}


def test_catalogue_goes_by_column_name(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("BIRD,EXTRA,ADIAG,ADATE,ORBIT\nsat-1,x,esd,1970-01-02,g\nsat-2,y,xyz,1970-01-02,p\n")
    raw = read_catalogue(spark, str(path))
    assert raw.columns == ["ADATE", "BIRD", "ORBIT", "ADIAG"]
    events = clean_catalogue(raw)
    rows = {r["BIRD"]: r for r in events.collect()}
    assert rows["SAT-1"]["is_environmental"] and rows["SAT-1"]["ORBIT"] == "G" and rows["SAT-2"]["event_time_utc"] is None
    pivot = class_pivot(events).first()
    assert (pivot["n_esd"], pivot["n_other"]) == (1, 1)
    assert daily_event_counts(events, only_environmental=False, other=True).first()["n_other"] == 1
    raw.write.parquet(str(tmp_path / "events.parquet"))
    assert read_catalogue(spark, str(tmp_path / "events.parquet")).count() == 2
    path.write_text("BIRD,ADIAG\nsat-1,esd\n")
    with pytest.raises(ValueError):
        read_catalogue(spark, str(path))


def test_a_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = lambda self: None
        getConf = lambda self: {}

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
    assert session.is_local("local[8]") and not session.is_local("local-cluster[3,2,1000]")
