"""Runs that are called again after a failure, published versions, and keyed
tables that are merged where they lie."""

import pytest

from sluice.operators.bucketed import create_bucketed, merge_into, merged_with, read_bucketed
from sluice.operators.upsert import BUCKET_COLUMN, create_keyed_table, keyed_upsert, replace_buckets, stage_upsert
from sluice.plans import runs
from sluice.plans.schemas import ADMISSIONS_HEADERS, ADMISSIONS_SOURCE
from sluice.sinks import commits
from sluice.sinks.commits import (
    PublishConflict,
    RunLedger,
    current_version,
    expire_versions,
    publish_version,
    read_published,
)

HEADER = ",".join(ADMISSIONS_HEADERS[c] for c in ADMISSIONS_SOURCE)
BATCH = "20230401120000000"


def line(name, age, bill):
    return f"{name},{age},Female,A+,Asthma,01-02-2023,Dr A,Clinic,Acme,{bill},101,Urgent,03-02-2023,Aspirin,Normal"


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [line(f"P{i}", 20 + i % 60, f"{100 + i}.25") for i in range(40)]
    (folder / "a.csv").write_text("\n".join([HEADER, *rows, rows[0]]) + "\n", encoding="utf-8")
    return str(folder)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- the ledger ----------------------------------------------------------------

SINKS = ["write_once", "publish", "stage_upsert", "replace_buckets", "publish_version", "write_jdbc"]


@pytest.mark.parametrize("when", ["before", "after"])
@pytest.mark.parametrize("failing", SINKS)
def test_a_failed_run_is_called_again(spark, landing, tmp_path, monkeypatch, failing, when):
    """The run dies at each sink in turn, before or after its work; called
    again it completes, and every output is there once."""
    jdbc_rows = []
    out, keyed, published = (str(tmp_path / n) for n in ("run", "keyed", "published"))
    older = spark.createDataFrame([("old", 1)], "row_key string, x int")
    monkeypatch.setattr(runs, "write_jdbc", lambda df, **_: jdbc_rows.append(df.count()))

    def run():
        return runs.run_admissions(
            spark, landing, out, BATCH, keyed_table=keyed, keyed_buckets=4, publish_to=published, jdbc={"url": "u", "table": "t"})

    publish_version(older, published)
    real, calls = getattr(runs, failing), []

    def broken(*args, **kwargs):
        calls.append(1)
        if len(calls) > 1:
            return real(*args, **kwargs)
        if when == "after":
            real(*args, **kwargs)
        raise RuntimeError("the driver dies here")

    monkeypatch.setattr(runs, failing, broken)
    with pytest.raises(RuntimeError):
        run()
    assert RunLedger.unfinished(spark, out) == BATCH
    outputs = run()
    assert RunLedger.unfinished(spark, out) is None
    want = rows(spark.read.parquet(f"{out}/table"))
    assert len(want) == 40 and outputs.counts["read"] == 41
    assert rows(spark.read.parquet(keyed).drop(BUCKET_COLUMN)) == want
    assert outputs.published == current_version(spark, published) == 2
    assert rows(read_published(spark, published)) == want and rows(read_published(spark, published, 1)) == [("old", 1)]
    assert spark.read.option("header", True).csv(f"{out}/csv").count() == 40
    assert jdbc_rows in ([40], [40, 40])  # a full overwrite: repeated only if it died after it
    # A third call finds everything committed and does nothing.
    before = list(jdbc_rows), len(calls)
    again = run()
    assert (list(jdbc_rows), len(calls)) == before and again.counts == outputs.counts and again.published == 2


def test_an_unfinished_run_goes_on_without_its_batch_id(spark, landing, tmp_path, monkeypatch):
    out = str(tmp_path / "run")
    monkeypatch.setattr(runs, "publish", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.run_admissions(spark, landing, out)
    started = RunLedger.unfinished(spark, out)
    monkeypatch.undo()
    assert {r[0] for r in runs.run_admissions(spark, landing, out).rows.select("ETL_batch_id").distinct().collect()} == {int(started)}
    with pytest.raises(FileExistsError):
        runs.run_admissions(spark, landing, out, batch_id="20230401120000001")


def test_no_run_merges_between_the_steps_of_another(spark, landing, tmp_path, monkeypatch):
    keyed = str(tmp_path / "keyed")
    options = {"csv": False, "keyed_table": keyed, "keyed_buckets": 4}
    monkeypatch.setattr(runs, "replace_buckets", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        runs.run_admissions(spark, landing, str(tmp_path / "a"), BATCH, **options)
    monkeypatch.undo()
    with pytest.raises(PublishConflict):
        runs.run_admissions(spark, landing, str(tmp_path / "b"), "20230402120000000", **options)
    runs.run_admissions(spark, landing, str(tmp_path / "a"), BATCH, **options)
    assert commits.held_by(spark, keyed) is None
    runs.run_admissions(spark, landing, str(tmp_path / "b"), "20230402120000000", **options)
    kept = spark.read.parquet(keyed)
    assert kept.count() == 40 and [r[0] for r in kept.select("ETL_batch_id").distinct().collect()] == [20230402120000000]


def test_an_output_of_unknown_origin_is_not_replaced(spark, landing, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "run" / "table"))
    with pytest.raises(FileExistsError):
        runs.run_admissions(spark, landing, str(tmp_path / "run"), BATCH)


# --- versions -------------------------------------------------------------------

def test_readers_keep_the_version_they_hold(spark, tmp_path):
    root = str(tmp_path / "t")
    assert current_version(spark, root) == 0
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    assert publish_version(spark.range(10), root) == 1
    held = read_published(spark, root)
    assert publish_version(spark.range(100, 103), root) == 2
    assert held.count() == 10 and rows(read_published(spark, root)) == [(100,), (101,), (102,)]
    assert expire_versions(spark, root, keep_seconds=3600) == [] and held.count() == 10
    assert expire_versions(spark, root, keep_seconds=0, now=9e12) == [1]
    assert current_version(spark, root) == 2 and read_published(spark, root).count() == 3
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, 1)


def test_of_two_publishers_one_wins(spark, tmp_path):
    root = str(tmp_path / "t")
    publish_version(spark.range(1), root)

    def slow(df, folder):  # another publisher is faster
        df.write.parquet(folder)
        publish_version(spark.range(7), root)

    with pytest.raises(PublishConflict):
        publish_version(spark.range(5), root, write=slow)
    assert read_published(spark, root).count() == 7 and current_version(spark, root) == 2
    assert len(commits.Files(spark, root).names("data")) == 2  # the loser's rows are gone
    with pytest.raises(PublishConflict):
        publish_version(spark.range(5), root, based_on=1)


def test_publishers_at_the_same_time(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path / "t")

    def one(n):
        try:
            return publish_version(spark.range(n + 1), root, based_on=0)
        except PublishConflict:
            return None

    with ThreadPoolExecutor(6) as pool:
        won = list(pool.map(one, range(6)))
    assert [v for v in won if v] == [1] and read_published(spark, root).count() == won.index(1) + 1


def test_a_publisher_that_died_does_not_block(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    publish_version(spark.range(1), root)
    (tmp_path / "t" / "_versions" / f"{2:012d}").write_text("")  # created, never written
    assert current_version(spark, root) == 1
    with pytest.raises(PublishConflict):
        publish_version(spark.range(4), root)
    monkeypatch.setattr(commits, "ABANDONED", -1.0)
    assert publish_version(spark.range(4), root) == 3 and read_published(spark, root).count() == 4
    spark.range(2).write.parquet(f"{root}/data/of-one-that-failed")
    expire_versions(spark, root, keep_seconds=0, now=9e12)
    assert len(commits.Files(spark, root).names("data")) == 1


def test_csv_versions_keep_values(spark, tmp_path):
    df = spark.createDataFrame([(" a,b ", 'x"y'), (None, "z")], "p string, q string")
    publish_version(df, str(tmp_path / "t"), fmt="csv")
    assert rows(read_published(spark, str(tmp_path / "t"))) == rows(df)


# --- keyed tables -----------------------------------------------------------------

SCHEMA = "k string, version long, v string"


def test_bucketed_merge_equals_upsert_and_leaves_the_target_in_place(spark, tmp_path):
    root = str(tmp_path / "t")
    old = spark.createDataFrame([(f"k{i}", 1 + i % 3, f"old{i}") for i in range(300)], SCHEMA)
    batch = spark.createDataFrame(
        [(f"k{i}", 2, f"new{i}") for i in range(250, 400)] + [("k299", 5, None)] + [("hot", j, "x") for j in range(500)], SCHEMA)
    assert create_bucketed(old, root, ["k"], "version", buckets=8) == 1
    held = read_bucketed(spark, root)
    merged = merged_with(held, batch, ["k"], "version")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    scan = plan.index("Bucketed: true")
    target_side = plan[plan.index("SortMergeJoin"):scan]
    assert "Exchange" not in target_side and "SelectedBucketsCount: 8 out of 8" in plan
    assert merge_into(spark, root, batch) == 2
    want = rows(keyed_upsert(old, batch, ["k"], "version"))
    assert rows(read_bucketed(spark, root)) == want and rows(held) == rows(old)
    assert merge_into(spark, root, batch) == 3 and rows(read_bucketed(spark, root)) == want
    files = list((tmp_path / "t").rglob("*.parquet"))
    assert len(files) == 3 * 8  # a file per bucket: the merge keeps the buckets


def test_a_merge_that_another_overtook_is_refused(spark, tmp_path, monkeypatch):
    from sluice.operators import bucketed

    root = str(tmp_path / "t")
    batch = spark.createDataFrame([("b", 2, "y")], SCHEMA)
    create_bucketed(spark.createDataFrame([("a", 1, "x")], SCHEMA), root, ["k"], "version", buckets=2)
    real = bucketed.merged_with

    def overtaken(*args):
        monkeypatch.setattr(bucketed, "merged_with", real)
        merge_into(spark, root, spark.createDataFrame([("c", 3, "z")], SCHEMA))
        return real(*args)

    monkeypatch.setattr(bucketed, "merged_with", overtaken)
    with pytest.raises(PublishConflict):
        merge_into(spark, root, batch)
    merge_into(spark, root, batch)
    assert rows(read_bucketed(spark, root)) == [("a", 1, "x"), ("b", 2, "y"), ("c", 3, "z")]


def test_a_replace_that_died_midway_is_repeated(spark, tmp_path):
    """Whatever an interrupted replace has deleted, the staged rows bring back."""
    import shutil

    path, staged = str(tmp_path / "t"), str(tmp_path / "staged")
    old = spark.createDataFrame([(f"k{i}", 1, "old") for i in range(100)], SCHEMA)
    batch = spark.createDataFrame([(f"k{i}", 2, "new") for i in range(90, 120)], SCHEMA)
    create_keyed_table(old, path, ["k"], "version", 4)
    stage_upsert(spark, path, batch, ["k"], "version", 4, staged)
    for folder in sorted((tmp_path / "t").glob(f"{BUCKET_COLUMN}=*"))[:2]:
        shutil.rmtree(folder)
    replace_buckets(spark, path, staged)
    replace_buckets(spark, path, staged)
    assert rows(spark.read.parquet(path).drop(BUCKET_COLUMN)) == rows(keyed_upsert(old, batch, ["k"], "version"))


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    create_keyed_table(old, path, ["k"], "version", 4)
    stage_upsert(spark, path, old.where("false"), ["k"], "version", 4, str(tmp_path / "s"))
    replace_buckets(spark, path, str(tmp_path / "s"))
    assert rows(spark.read.parquet(path).drop(BUCKET_COLUMN)) == [("a", 1, "x")]
