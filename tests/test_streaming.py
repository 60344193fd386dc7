"""Incremental runs: each run processes only files it has not seen."""

from sluice.plans.schemas import ADMISSIONS_HEADERS, ADMISSIONS_SOURCE
from sluice.streaming import admissions_job, run_incremental

HEADER = [ADMISSIONS_HEADERS[c] for c in ADMISSIONS_SOURCE]


def _row(name, age, bill):
    return f"{name},{age},Female,A+,Asthma,01-02-2023,Dr A,Clinic,Acme,{bill},101,Urgent,03-02-2023,Aspirin,Normal"


def _land(path, fname, rows):
    path.mkdir(exist_ok=True)
    (path / fname).write_text(",".join(HEADER) + "\n" + "\n".join(rows) + "\n", encoding="utf-8")


def test_available_now_runs_are_incremental(spark, tmp_path):
    landing, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    job = admissions_job(names=ADMISSIONS_HEADERS, staged=False)
    ids = lambda epoch: f"2024010100000{epoch:04d}"

    _land(landing, "a.csv", [_row("Ann", 40, "100.00"), _row("Ann", 40, "100.00"), _row("Bo", 20, "50.00")])
    run_incremental(spark, job, str(landing), HEADER, out, ckpt, batch_id_for=ids)
    first = spark.read.parquet(out)
    assert first.count() == 2  # the duplicate is removed inside the batch
    assert {r.epoch for r in first.select("epoch").distinct().collect()} == {0}

    _land(landing, "b.csv", [_row("Cy", 80, "400.00")])
    run_incremental(spark, job, str(landing), HEADER, out, ckpt, batch_id_for=ids)
    second = spark.read.parquet(out)
    assert second.count() == 3
    cy = second.where(second["Name"] == "Cy").first()
    assert cy["epoch"] == 1 and cy["ETL_batch_id"] == 20240101000000001
    # statistics are per run: Cy is the only row of the second batch
    assert cy["Risk Score"] == 0.7

    run_incremental(spark, job, str(landing), HEADER, out, ckpt, batch_id_for=ids)
    assert spark.read.parquet(out).count() == 3  # nothing new, nothing written


def test_one_run_splits_into_micro_batches(spark, tmp_path):
    landing, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    job = admissions_job(names=ADMISSIONS_HEADERS, staged=False)
    _land(landing, "a.csv", [_row("Ann", 40, "100.00")])
    _land(landing, "b.csv", [_row("Bo", 20, "50.00")])
    run_incremental(
        spark, job, str(landing), HEADER, out, ckpt,
        batch_id_for=lambda epoch: f"2024010100000{epoch:04d}", max_files_per_trigger=1,
    )
    rows = spark.read.parquet(out).collect()
    assert sorted(r.epoch for r in rows) == [0, 1]
    assert len({r["ETL_batch_id"] for r in rows}) == 2
    # each micro-batch is its own run: its only row holds the maxima
    assert {r["Risk Score"] for r in rows} == {0.7}


def test_processing_time_trigger_keeps_running(spark, tmp_path):
    landing, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    job = admissions_job(names=ADMISSIONS_HEADERS, staged=False)
    _land(landing, "a.csv", [_row("Ann", 40, "100.00")])
    query = run_incremental(
        spark, job, str(landing), HEADER, out, ckpt,
        batch_id_for=lambda epoch: f"2024010100000{epoch:04d}", trigger={"processingTime": "1 second"},
    )
    try:
        assert query.isActive
        query.processAllAvailable()
        assert spark.read.parquet(out).count() == 1
    finally:
        query.stop()


def test_a_stream_keeps_no_staged_folder(spark, tmp_path):
    """Each micro-batch stages its rows; after its output is committed the
    stage is gone, however many have run."""
    landing, out, ckpt, stage = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt"), tmp_path / "stage"
    job, seen = admissions_job(names=ADMISSIONS_HEADERS), []

    def watching(batch, batch_id, **staging):
        seen.append(staging["staged"])
        return job(batch, batch_id, **staging)

    for n in range(3):
        _land(landing, f"{n}.csv", [_row(f"P{n}", 40, "100.00")])
    run_incremental(
        spark, watching, str(landing), HEADER, out, ckpt, batch_id_for=lambda e: f"2024010100000{e:04d}",
        max_files_per_trigger=1, stage_dir=str(stage),
    )
    assert spark.read.parquet(out).count() == 3
    assert seen == [f"{stage}/epoch={n}" for n in range(3)] and not list(stage.glob("*"))


def test_a_file_with_other_headers_fails_the_stream(spark, tmp_path):
    import pytest

    landing = tmp_path / "in"
    _land(landing, "a.csv", [_row("Ann", 40, "100.00")])
    (landing / "b.csv").write_text(",".join(reversed(HEADER)) + "\n" + _row("Bo", 20, "50") + "\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header"):
        run_incremental(
            spark, admissions_job(names=ADMISSIONS_HEADERS, staged=False), str(landing), HEADER,
            str(tmp_path / "out"), str(tmp_path / "ckpt"),
        )
