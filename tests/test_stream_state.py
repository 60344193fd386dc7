"""State across micro-batches: repeated rows, folded statistics, step counts."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluice.operators.partials import folded, partial_stats, with_folded_stats
from sluice.operators.stats import with_global_stats
from sluice.plans import catalog
from sluice.plans.admissions import admissions_etl
from sluice.plans.schemas import ADMISSIONS_HEADERS, ADMISSIONS_SOURCE, SMART_HOME_SOURCE
from sluice.plans.smart_home import smart_home_etl
from sluice.sources.csv import read_text_csv
from sluice.streaming import admissions_folded, admissions_job, run_incremental, smart_home_folded
from sluice.streaming.incremental import csv_file_stream, first_time_rows

HEADER = [ADMISSIONS_HEADERS[c] for c in ADMISSIONS_SOURCE]
BATCH = "20240101000000000"


def _row(name, age, bill, insurer="Acme"):
    return f"{name},{age},Female,A+,Asthma,01-02-2023,Dr A,Clinic,{insurer},{bill},101,Urgent,03-02-2023,Aspirin,Normal"


def _land(folder, name, lines, header):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([",".join(header), *lines]) + "\n", encoding="utf-8")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_row_of_two_files_of_two_runs_arrives_once(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "out")
    flow = admissions_folded(ADMISSIONS_HEADERS)

    def run():
        flow.run(spark, str(landing), HEADER, root, batch_id_for=lambda _: BATCH)
        return flow.result(spark, root)

    _land(landing, "a.csv", [_row("Ann", 40, "100.00"), _row("Ann", 40, "100.00"), _row("Bo", 20, "50.00", "NA")], HEADER)
    assert sorted(r["Name"] for r in run().collect()) == ["Ann", "Bo"]
    # The same row again, one that is the same once sentinels are blanked, and a new one.
    _land(landing, "b.csv", [_row("Ann", 40, "100.00"), _row("Bo", 20, "50.00", "None"), _row("Cy", 80, "400.00"), "," * 14], HEADER)
    second = run()
    assert sorted(r["Name"] for r in second.collect()) == ["Ann", "Bo", "Cy"]
    # Scores by the maxima of both runs: equal to one run over all files.
    whole = admissions_etl(read_text_csv(spark, str(landing)), BATCH, names=ADMISSIONS_HEADERS, staged=False)
    assert rows(second) == rows(whole)
    assert rows(run()) == rows(whole)  # nothing new, nothing changed


def test_smart_home_over_five_micro_batches(spark, tmp_path):
    landing, root = tmp_path / "in", str(tmp_path / "out")
    flow = smart_home_folded()
    width = len(SMART_HOME_SOURCE)
    lines = [",".join([str(1451624400 + 60 * (i % 17)), *[f"0.{(i * k) % 97:02d}" for k in range(1, width)]]) for i in range(60)]
    for n in range(5):
        _land(landing, f"f{n}.csv", lines[10 * n : 10 * n + 20], SMART_HOME_SOURCE)
    query = flow.run(spark, str(landing), SMART_HOME_SOURCE, root, batch_id_for=lambda _: BATCH, max_files_per_trigger=1)
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) == 5
    whole = smart_home_etl(read_text_csv(spark, str(landing), SMART_HOME_SOURCE), BATCH, staged=False)
    rounded = [df.withColumn("avg_power", F.round("avg_power", 9)) for df in (flow.result(spark, root), whole)]
    assert rows(rounded[0]) == rows(rounded[1]) and rounded[1].count() == 60
    assert spark.read.parquet(f"{root}/partials").count() == 5


def test_a_micro_batch_that_failed_counts_once(spark, tmp_path, monkeypatch):
    """Rows are written and the partial figures are not: the retry replaces both."""
    from sluice.streaming import incremental

    landing, root = tmp_path / "in", str(tmp_path / "out")
    flow = admissions_folded(ADMISSIONS_HEADERS)
    _land(landing, "a.csv", [_row("Ann", 40, "100.00"), _row("Bo", 20, "50.00")], HEADER)
    monkeypatch.setattr(incremental, "partial_stats", lambda *a: 1 / 0)
    with pytest.raises(Exception):
        flow.run(spark, str(landing), HEADER, root, batch_id_for=lambda _: BATCH)
    monkeypatch.undo()
    flow.run(spark, str(landing), HEADER, root, batch_id_for=lambda _: BATCH)
    whole = admissions_etl(read_text_csv(spark, str(landing)), BATCH, names=ADMISSIONS_HEADERS, staged=False)
    assert rows(flow.result(spark, root)) == rows(whole)


def test_a_watermark_bounds_the_state(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")

    def run(name, lines):
        _land(landing, name, lines, ["k", "at"])
        stream = csv_file_stream(spark, str(landing), ["k", "at"]).withColumn("at", F.to_timestamp("at"))
        query = (
            first_time_rows(stream, ["k"], ("at", "1 hour")).writeStream.format("parquet").outputMode("append")
            .option("path", out).option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return query.recentProgress

    run("a.csv", ["x,2024-01-01 10:00:00", "x,2024-01-01 10:20:00", "y,2024-01-01 10:00:00"])
    progress = run("b.csv", ["x,2024-01-01 10:50:00", "z,2024-01-02 10:00:00"])
    progress = run("c.csv", ["x,2024-01-02 10:05:00"])
    assert [r[0] for r in rows(spark.read.parquet(out).select("k"))] == ["x", "x", "y", "z"]
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 2  # x and y of the day before are gone


def test_step_counts_of_every_epoch(spark, tmp_path):
    landing, out, counts = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "counts")
    files = {"a.csv": [_row("Ann", 40, "1.00")] * 3 + ["," * 14], "b.csv": [_row("Bo", 40, "1.00"), _row("Cy", 1, "2.00")]}
    for name, lines in files.items():
        _land(landing, name, lines, HEADER)
        run_incremental(spark, admissions_job(names=ADMISSIONS_HEADERS), str(landing), HEADER, out, str(tmp_path / "ckpt"),
                        batch_id_for=lambda _: BATCH, stage_dir=str(tmp_path / "stage"), counts_dir=counts)
    got = [(r["epoch"], r["step"], r["rows"]) for r in spark.read.parquet(counts).orderBy("epoch", "position").collect()]
    assert got == [(0, "read", 4), (0, "distinct", 2), (0, "clean", 1), (1, "read", 2), (1, "distinct", 2), (1, "clean", 2)]


def test_folding_equals_the_whole_table(spark):
    values = [None, "1.5", "-2", "NaN", "x", "1e3", "Infinity", "9", "10", ""]
    df = spark.createDataFrame([(v, i % 4) for i, v in enumerate(values * 3)], "v string, part int")
    parts = None
    for n in range(5):  # the last one is empty
        one = partial_stats(df.where(f"part = {n}"), ["v"])
        parts = one if parts is None else parts.union(one)
    stats = {s: ("v", s) for s in ("count", "sum", "avg", "min", "max", "text_max")}
    got = with_folded_stats(spark.range(1), parts, stats).first()
    whole = with_global_stats(df, "v", {s: s for s in ("count", "sum", "avg", "min", "max")}).first()
    assert all(got[s] == pytest.approx(whole[s]) for s in ("count", "sum", "avg", "min", "max")) and got["text_max"] == "9"
    nothing = partial_stats(df.where("false"), ["v"]).agg(folded("v", "avg").alias("a"), folded("v", "count").alias("n")).first()
    assert nothing["a"] is None and nothing["n"] == 0


@pytest.mark.parametrize("name", ["smart_home_stream_folded", "admissions_stream_folded"])
def test_more_rows_land_in_more_files(spark, sf_small, tmp_path, monkeypatch, name):
    """No landed file, which one task writes, grows with the table; the
    micro-batches stay as many and the rows the same."""
    run, landed, epochs = catalog.QUERIES[name], [], []
    want = rows(run(spark, sf_small))

    def scratch(_spark, name):
        path = str(tmp_path / name)
        (landed if name.endswith("_landing") else epochs).append(path)
        return path

    monkeypatch.setattr(catalog, "scratch_path", scratch)
    monkeypatch.setattr(catalog, "STREAM_FILE_ROWS", 100)
    assert rows(run(spark, sf_small)) == want
    lines = [len(f.read_text().splitlines()) - 1 for f in Path(landed[0]).glob("part-*")]
    assert sum(lines) > 1000 and max(lines) <= 110
    assert spark.read.parquet(f"{epochs[0]}/partials").count() == catalog.STREAM_FILES
