"""The two jobs over small header CSV files in the original format."""

import datetime as dt
import os

import pytest

from sluice.plans.admissions import admissions_etl, admissions_etl_reject
from sluice.plans.schemas import ADMISSIONS_HEADERS, ADMISSIONS_OUTPUT, SMART_HOME_HEADERS, SMART_HOME_OUTPUT, SMART_HOME_SOURCE
from sluice.plans.smart_home import smart_home_etl
from sluice.sources.csv import read_text_csv

ADM_HEADER = [ADMISSIONS_HEADERS[c] for c in (
    "name", "age", "gender", "blood_type", "medical_condition", "date_of_admission", "doctor",
    "hospital", "insurance_provider", "billing_amount", "room_number", "admission_type",
    "discharge_date", "medication", "test_results")]

# Invented rows; one hospital holds a comma, one row is repeated, two are blank.
ADM_ROWS = [
    'Ada Stone,30,Female,A+,Diabetes,01-02-2023,Dr One,"Hill, North",Acme,1000.004,101,Urgent,05-02-2023,Aspirin,Normal',
    "Ben Cole,60,Male,O-,Asthma,10-03-2023,Dr Two,Lake Clinic,NA,2000.5,102,Elective,20-03-2023,None,Abnormal",
    "Ben Cole,60,Male,O-,Asthma,10-03-2023,Dr Two,Lake Clinic,NA,2000.5,102,Elective,20-03-2023,None,Abnormal",
    "Cy Park,9,Male,B+,Cancer,28-12-2022,Dr Three,Bay Care,Acme,500,103,Emergency,02-01-2023,Lipitor,Inconclusive",
    ",,,,,,,,,,,,,,",
    ",,,,,,,,,,,,,,",
]


@pytest.fixture(scope="module")
def admissions_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("adm") / "admissions.csv"
    text = "﻿" + ",".join(ADM_HEADER) + "\n" + "\n".join(ADM_ROWS) + "\n"
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_read_text_csv_keeps_text_and_strips_bom(spark, admissions_csv):
    df = read_text_csv(spark, admissions_csv)
    assert df.columns == ADM_HEADER
    assert all(t == "string" for _, t in df.dtypes)
    assert df.count() == 6
    assert df.where(df["Hospital"] == "Hill, North").count() == 1


def test_admissions_etl_on_original_headers(spark, admissions_csv, tmp_path):
    raw = read_text_csv(spark, admissions_csv)
    out = admissions_etl(raw, "20230401120000000", names=ADMISSIONS_HEADERS, staged=str(tmp_path / "stage"))
    assert out.columns == [ADMISSIONS_HEADERS[c] for c in ADMISSIONS_OUTPUT]
    rows = {r["Name"]: r for r in out.collect()}
    assert set(rows) == {"Ada Stone", "Ben Cole", "Cy Park"}  # dup and blanks gone
    ada, ben, cy = rows["Ada Stone"], rows["Ben Cole"], rows["Cy Park"]
    assert ada["Admission Days"] == 4 and cy["Admission Days"] == 5
    assert ada["Date of Admission"] == dt.date(2023, 2, 1)
    assert ben["Insurance Provider"] is None and ben["Medication"] is None
    assert ada["ETL_batch_id"] == 20230401120000000 and ada["ETL_batch_date"] == dt.date(2023, 4, 1)
    # maxima: age 60, billing 2000.5 (typed, not text: '9' > '60' as text)
    assert ben["Risk Score"] == round(0.4 * 60 / 60 + 0.3 * 2000.5 / 2000.5, 2)
    assert ada["Risk Score"] == round(0.4 * 30 / 60 + 0.3 + 0.3 * 1000.0 / 2000.5, 2)
    assert len({r["UUID"] for r in rows.values()}) == 3


def test_admissions_text_maxima(spark, admissions_csv):
    raw = read_text_csv(spark, admissions_csv)
    out = admissions_etl(raw, "20230401120000000", names=ADMISSIONS_HEADERS, text_maxima=True, staged=False)
    cy = out.where(out["Name"] == "Cy Park").first()
    # text maxima are '9' and '500': Cy's own values
    assert cy["Risk Score"] == round(0.4 * 9 / 9 + 0.3 * 500 / 500, 2)


def test_admissions_reject_flow(spark, admissions_csv):
    raw = read_text_csv(spark, admissions_csv)
    out = admissions_etl_reject(raw, "20230401120000000", names=ADMISSIONS_HEADERS, staged=False)
    names = sorted(r["Name"] for r in out.collect())
    assert names == ["Ada Stone", "Cy Park"]  # Ben holds 'NA' and 'None'
    ada = out.where(out["Name"] == "Ada Stone").first()
    assert ada["Billing Amount"] == 1000.0


SMART_HEADER = [SMART_HOME_HEADERS[c] for c in SMART_HOME_SOURCE]


def _reading(epoch, base, summary="Clear", temp="10"):
    values = {c: str(base) for c in SMART_HOME_SOURCE}
    values.update(time=str(epoch), icon="clear-night", summary=summary, temperature=temp)
    return ",".join(values[c] for c in SMART_HOME_SOURCE)


@pytest.fixture(scope="module")
def smart_csv(tmp_path_factory):
    path = tmp_path_factory.mktemp("sh") / "home.csv"
    rows = [
        _reading(1451624400, 0.1),            # 2016-01-01 05:00:00
        _reading(1451624400, 0.1),            # duplicate
        _reading(1451626200, 0.2, "Null"),    # 05:30:00, summary blanked
        _reading(1451628000, 0.3, temp="NA"), # 06:00:00, inclusive bound
        _reading(1451628001, 0.4),            # 06:00:01, outside
        ",".join("" for _ in SMART_HOME_SOURCE),
    ]
    path.write_text(",".join(SMART_HEADER) + "\n" + "\n".join(rows) + "\n", encoding="utf-8")
    return str(path)


def test_smart_home_etl_on_original_headers(spark, smart_csv, tmp_path):
    raw = read_text_csv(spark, smart_csv)
    window = ("2016-01-01 05:00:00", "2016-01-01 06:00:00")
    out = smart_home_etl(raw, "20230401120000000", names=SMART_HOME_HEADERS, window=window, staged=str(tmp_path / "s"))
    assert out.columns == [SMART_HOME_HEADERS[c] for c in SMART_HOME_OUTPUT]
    rows = sorted(out.collect(), key=lambda r: r["time"])
    assert [r["time"] for r in rows] == [
        dt.datetime(2016, 1, 1, 5, 0), dt.datetime(2016, 1, 1, 5, 30), dt.datetime(2016, 1, 1, 6, 0)]
    # nine terms of the house total, three of them totals: 14 base readings
    houses = [r["House overall [kW]"] for r in rows]
    assert houses == pytest.approx([1.4, 2.8, 4.2])
    assert rows[0]["Furnace Total [kW]"] == pytest.approx(0.2)
    assert rows[0]["Kitchen Total [kW]"] == pytest.approx(0.3)
    assert rows[1]["summary"] is None and rows[2]["temperature"] is None
    for r in rows:
        assert r["max_power"] == pytest.approx(4.2) and r["min_power"] == pytest.approx(1.4)
        assert r["avg_power"] == pytest.approx(2.8, abs=1e-12)
    assert "Furnace 1 [kW]" not in out.columns and "Fridge [kW]" not in out.columns


def test_staging_writes_under_checkpoint_dir(spark, admissions_csv):
    from sluice.session import checkpoint_root

    raw = read_text_csv(spark, admissions_csv)
    out = admissions_etl(raw, "20230401120000000", names=ADMISSIONS_HEADERS)
    files = out.inputFiles()
    root = checkpoint_root(spark).replace("file:", "")
    assert files and all(root in f for f in files)
    assert all(os.path.basename(os.path.dirname(f.replace("file:", ""))).startswith("admissions_stage") for f in files)


def test_complete_run_feeds_every_sink_from_one_write(spark, admissions_csv, tmp_path):
    from sluice.plans.runs import run_admissions
    from sluice.sources.csv import read_text_csv

    first = run_admissions(spark, admissions_csv, str(tmp_path / "r1"), batch_id="20230401120000000")
    table = spark.read.parquet(first.table)
    csv_back = read_text_csv(spark, first.csv)
    assert table.count() == csv_back.count() == 3
    assert first.counts == {"read": 6, "distinct": 4, "clean": 3}
    assert sorted(r["UUID"] for r in table.collect()) == sorted(r["UUID"] for r in csv_back.collect())

    # a second run upserts into the first run's table: same keys, newer batch
    second = run_admissions(
        spark, admissions_csv, str(tmp_path / "r2"), batch_id="20230402120000000",
        keyed_previous=first.table, csv=False,
    )
    keyed = spark.read.parquet(second.keyed)
    assert keyed.count() == 3
    assert {r["ETL_batch_id"] for r in keyed.collect()} == {20230402120000000}


def test_smart_home_run_writes_raw_copy_beside_clean(spark, smart_csv, tmp_path):
    from sluice.plans.runs import run_smart_home
    from sluice.sources.csv import read_text_csv

    out = run_smart_home(spark, smart_csv, str(tmp_path / "run"), batch_id="20230401120000000", raw_copy=True)
    raw = read_text_csv(spark, out.raw)
    assert raw.count() == 6  # everything as read, duplicates and blanks included
    assert {r["ETL_batch_id"] for r in raw.collect()} == {"20230401120000000"}
    assert spark.read.parquet(out.table).count() == 4  # clean: dup and blank row gone


def test_trace_counts_come_from_the_jobs_own_run(spark, admissions_csv, smart_csv):
    from sluice.operators import trace_counts

    trace = {}
    out = admissions_etl(read_text_csv(spark, admissions_csv), "20230401120000000",
                         names=ADMISSIONS_HEADERS, staged=False, trace=trace)
    out.write.format("noop").mode("overwrite").save()
    assert trace_counts(trace) == {"read": 6, "distinct": 4, "clean": 3}

    trace = {}
    window = ("2016-01-01 05:00:00", "2016-01-01 06:00:00")
    out = smart_home_etl(read_text_csv(spark, smart_csv), "20230401120000000",
                         names=SMART_HOME_HEADERS, window=window, trace=trace)
    out.write.format("noop").mode("overwrite").save()
    assert trace_counts(trace) == {"in_window": 4, "distinct": 3, "clean": 3}


def test_binary_rounding_reproduces_the_python_score(spark, admissions_csv):
    raw = read_text_csv(spark, admissions_csv)
    out = admissions_etl(raw, "20230401120000000", names=ADMISSIONS_HEADERS, text_maxima=True,
                         rounding="binary", staged=False)
    got = {r["Name"]: r["Risk Score"] for r in out.collect()}
    # text maxima '9' and '500'; by hand 0.4*30/9 + 0.3 + 0.3*1000/500 = 2.2333,
    # 0.4*60/9 + 0.3*2000.5/500 = 3.8669... and 0.4 + 0.3 = 0.7
    assert got == {"Ada Stone": 2.23, "Ben Cole": 3.87, "Cy Park": 0.7}


def test_jobs_never_raise_on_bad_text_under_ansi(spark, tmp_path):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    bad_adm = [
        'Zed,1e400,Male,A+,Diabetes,31-02-2023,Dr,H,Acme,abc,99999999999999999999,Urgent,01-01-2023,X,Normal',
        "Yan,-0,Female,B-,Asthma,2023-01-05,Dr,H,Acme,NaN,12.5,Urgent,05-01-2023,X,Normal",
        "Xi,40,Female,B-,Asthma,01-01-2023,Dr,H,Acme,100,7,Urgent,00-00-0000,X,Normal",
    ]
    bad_adm += [
        "Wim,NaN,Male,B-,Asthma,01-01-2023,Dr,H,Acme,Infinity,7,Urgent,03-01-2023,X,Normal",
        "Vic,20,Male,B-,Asthma,01-01-2023,Dr,H,Acme,-inf,7,Urgent,03-01-2023,X,Normal",
    ]
    path = tmp_path / "bad.csv"
    path.write_text(",".join(ADM_HEADER) + "\n" + "\n".join(bad_adm) + "\n", encoding="utf-8")
    out = admissions_etl(read_text_csv(spark, str(path)), "20230401120000000", names=ADMISSIONS_HEADERS, staged=False)
    rows = {r["Name"]: r for r in out.collect()}
    zed, yan, xi = rows["Zed"], rows["Yan"], rows["Xi"]
    assert zed["Age"] is None and zed["Date of Admission"] is None and zed["Room Number"] is None
    assert zed["Billing Amount"] is None and zed["Risk Score"] is None and zed["Admission Days"] is None
    assert yan["Date of Admission"] is None and yan["Room Number"] is None  # ISO text, '12.5' as int
    assert xi["Discharge Date"] is None and xi["Admission Days"] is None
    # NaN and the infinities are no numbers, and no maximum of other rows
    assert yan["Billing Amount"] is None and rows["Wim"]["Risk Score"] is None and rows["Vic"]["Billing Amount"] is None
    assert xi["Risk Score"] == 0.4 + 0.3

    bad_home = ",".join(["abc"] + ["1e400"] * (len(SMART_HOME_SOURCE) - 1))
    bad_home += "\n" + ",".join(["99999999999999999"] + ["NaN"] * (len(SMART_HOME_SOURCE) - 1))
    bad_home += "\n" + ",".join(["1451624400"] + ["0.5"] * (len(SMART_HOME_SOURCE) - 1))
    hpath = tmp_path / "bad_home.csv"
    hpath.write_text(",".join(SMART_HEADER) + "\n" + bad_home + "\n", encoding="utf-8")
    home = smart_home_etl(read_text_csv(spark, str(hpath)), "20230401120000000", names=SMART_HOME_HEADERS, staged=False)
    by_time = {r["time"]: r for r in home.collect()}
    assert set(by_time) == {None, dt.datetime(2016, 1, 1, 5)}  # 'abc' and an epoch past every calendar are no times
    assert {(r["max_power"], r["min_power"], r["avg_power"]) for r in by_time.values()} == {(7.0, 7.0, 7.0)}


def test_output_types_can_be_overridden(spark, admissions_csv):
    raw = read_text_csv(spark, admissions_csv)
    out = admissions_etl(raw, "20230401120000000", names=ADMISSIONS_HEADERS, staged=False,
                         types={"risk_score": "float", "billing_amount": "float"})
    dtypes = dict(out.dtypes)
    assert dtypes["Risk Score"] == "float" and dtypes["Billing Amount"] == "float"
    assert dtypes["Age"] == "int" and dtypes["ETL_batch_id"] == "bigint"


def test_complete_run_deletes_its_stage_unless_asked_to_keep_it(spark, admissions_csv, smart_csv, tmp_path):
    from sluice.plans.runs import run_admissions, run_smart_home

    for keep, left in ((False, ["table"]), (True, ["_stage", "table"])):
        out = tmp_path / f"adm{keep}"
        run_admissions(spark, admissions_csv, str(out), batch_id="20230401120000000", csv=False, keep_stage=keep)
        assert sorted(os.listdir(out)) == sorted([*left, "_ledger"])
        out = tmp_path / f"sh{keep}"
        run_smart_home(spark, smart_csv, str(out), batch_id="20230401120000000", csv=False, keep_stage=keep)
        assert sorted(os.listdir(out)) == sorted([*left, "_ledger"])
        assert spark.read.parquet(str(out / "table")).count() == 4


def test_values_with_outer_blanks_survive_a_run(spark, tmp_path):
    from sluice.plans.runs import run_admissions

    path = tmp_path / "blanks.csv"
    row = '" Ada ",30,Female,A+,Diabetes,01-02-2023,Dr One,"say ""x"" \\",Acme,1000,101,Urgent,05-02-2023,Aspirin,Normal'
    path.write_text(",".join(ADM_HEADER) + "\n" + row + "\n", encoding="utf-8")
    out = run_admissions(spark, str(path), str(tmp_path / "run"), batch_id="20230401120000000")
    for rows in (spark.read.parquet(out.table), read_text_csv(spark, out.csv)):
        assert [(r["Name"], r["Hospital"]) for r in rows.collect()] == [(" Ada ", 'say "x" \\')]


def test_reject_run_in_the_workflow_layout(spark, admissions_csv, tmp_path):
    from sluice.plans.runs import run_admissions
    from sluice.plans.schemas import ADMISSIONS_WORKFLOW_HEADERS

    out = run_admissions(
        spark, admissions_csv, str(tmp_path / "run"), batch_id="20230401120000000", reject=True, csv=False,
        names=ADMISSIONS_WORKFLOW_HEADERS, text_maxima={"age"}, rounding="binary",
    )
    table = spark.read.parquet(out.table)
    assert table.columns == [
        "uuid", "ETLBatchID", "ETLBatchDate", "Name", "Age", "Gender", "Blood Type", "Medical Condition",
        "Date of Admission", "Doctor", "Hospital", "Insurance Provider", "Billing Amount", "Room Number",
        "Admission Type", "Discharge Date", "Medication", "Test Results", "Admission Days", "Risk Score",
    ]
    # ages as text: '9' is the largest; billing as numbers: 1000
    assert {r["Name"]: r["Risk Score"] for r in table.collect()} == {"Ada Stone": 1.93, "Cy Park": 0.55}


def test_runs_take_a_jdbc_target(spark, admissions_csv, tmp_path, monkeypatch):
    from sluice.plans import runs

    seen = []
    monkeypatch.setattr(runs, "write_jdbc", lambda df, **options: seen.append((df.count(), options)))
    monkeypatch.setenv("JDBC_USER", "u")
    monkeypatch.setenv("JDBC_PASSWORD", "p")
    target = runs.jdbc_target("jdbc:x:y", "t")
    runs.run_admissions(spark, admissions_csv, str(tmp_path / "run"), jdbc=target, csv=False)
    assert seen == [(3, {"url": "jdbc:x:y", "table": "t", "user": "u", "password": "p"})]
    assert runs.jdbc_target(None, None) is None


def test_smart_home_run_prunes_by_day_column(spark, tmp_path):
    from sluice.plans.runs import run_smart_home

    base = tmp_path / "in"
    for day, epoch in (("2016-01-01", 1451624400), ("2016-01-02", 1451710800)):
        (base / f"day={day}").mkdir(parents=True)
        text = ",".join(SMART_HEADER) + "\n" + _reading(epoch, 0.1) + "\n"
        (base / f"day={day}" / "a.csv").write_text(text, encoding="utf-8")
    window = ("2016-01-01 05:00:00", "2016-01-01 06:00:00")
    out = run_smart_home(spark, str(base), str(tmp_path / "run"), window=window, day_col="day", csv=False)
    assert spark.read.parquet(out.table).count() == 1
