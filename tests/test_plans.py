"""Plan shape: pushdown, pruning, one stats subquery, no per-row Python."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import reject_sentinel_rows, top_k_counts, with_global_stats
from sluice.plans.catalog import EXTREMES_DAY, QUERIES
from sluice.plans.inspect import plan_problems, plan_text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_cross_product_or_single_task_window(spark, sf_small, name):
    assert plan_problems(QUERIES[name](spark, sf_small)) == []


@pytest.mark.parametrize("name", ["batch_stamp", "dedup_rows", "format_amount", "time_range", "house_overall"])
def test_views_add_no_shuffle_to_the_scan(spark, sf_small, name):
    assert "RoundRobinPartitioning" not in plan_text(QUERIES[name](spark, sf_small), "simple")


def test_day_over_day_delta_reads_the_stage_without_a_window(spark, sf_small):
    text = plan_text(QUERIES["day_over_day_delta"](spark, sf_small))
    assert "Window" not in text and "SinglePartition" not in text
    assert "ReadSchema: struct<time:timestamp_ntz,house_overall:double>" in text


def test_attached_day_is_pushed_to_the_scan(spark, sf_small):
    text = plan_text(QUERIES["day_extremes_attached"](spark, sf_small))
    sub = text[text.index("===== Subqueries =====") :]
    pushed = [line for line in sub.splitlines() if "PushedFilters" in line][0]
    assert f"GreaterThanOrEqual(time,{EXTREMES_DAY}" in pushed and "LessThan(time," in pushed


@pytest.mark.parametrize("name", ["risk_score", "risk_score_text_max", "risk_score_binary", "risk_score_mixed_max"])
def test_scores_read_their_source_once(spark, sf_small, name):
    text = plan_text(QUERIES[name](spark, sf_small))
    scans = [line for line in text.splitlines() if line.startswith("Location:")]
    assert scans and all(name.split("_max")[0][:10] in line and "orders" not in line for line in scans)


def test_window_is_decided_on_numeric_epochs_in_the_scan(spark, tmp_path):
    from sluice.operators.shape import epoch_range

    path = str(tmp_path / "e")
    spark.range(10).selectExpr("id + 1451624400 AS time").write.parquet(path)
    df = epoch_range(spark.read.parquet(path), "time", "2016-01-01 05:00:02", "2016-01-01 05:00:04")
    assert df.count() == 3
    assert "GreaterThanOrEqual(time,1451624402)" in plan_text(df)


def test_window_check_sees_keyless_windows(spark, sf_small):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(100).withColumn("m", F.max("id").over(Window.partitionBy()))
    assert "Window over SinglePartition" in plan_problems(df)


def test_reject_filter_reaches_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "NA"), ("b", "c")], "x string, y string").write.parquet(path)
    text = plan_text(reject_sentinel_rows(spark.read.parquet(path)))
    pushed = [line for line in text.splitlines() if "PushedFilters" in line][0]
    assert "IsNotNull(x)" in pushed and "Not(In(y" in pushed


def test_stats_are_one_subquery_reading_one_column(spark, tmp_path):
    path = str(tmp_path / "s")
    spark.createDataFrame([(1.0, "a"), (2.0, "b")], "v double, s string").write.parquet(path)
    df = with_global_stats(spark.read.parquet(path), "v", {"mx": "max", "mn": "min", "av": "avg"})
    text = plan_text(df)
    assert text.count("Subquery:") == 1
    sub = text[text.index("===== Subqueries =====") :]
    assert "ReadSchema: struct<v:double>" in sub
    assert "Window" not in text


def test_top_k_never_sorts_everything(spark):
    df = spark.range(1000).selectExpr("id % 7 AS k")
    text = plan_text(top_k_counts(df, "k", 3))
    assert "TakeOrderedAndProject" in text
    assert "partial_count" in text


def test_jobs_plan_a_single_stats_subquery(spark, sf_small):
    for name in ("admissions_etl", "smart_home_etl"):
        text = plan_text(QUERIES[name](spark, sf_small))
        assert text.count("Subquery:") == 1, name
        assert "Window" not in text


def _partial_before_exchange(text: str) -> bool:
    """Every hash exchange is fed by a partial (map-side) aggregate."""
    lines = [line.strip(" :+-") for line in text.splitlines()]
    for i, line in enumerate(lines):
        if line.startswith("Exchange hashpartitioning"):
            j = i + 1
            while j < len(lines) and lines[j].startswith(("Sort ", "Project ")):
                j += 1
            node = lines[j] if j < len(lines) else ""
            aggregate = node.startswith(("HashAggregate", "SortAggregate"))
            if not (aggregate and ("partial_" in node or "functions=[]" in node)):
                return False
    return True


def test_grouping_steps_combine_map_side_under_skew(spark):
    from sluice.operators import daily_totals, dedup_rows, keyed_upsert, stage_row_counts

    # a third of the rows are one row / one key
    hot = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS STRING) END AS k",
        "CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS v",
        "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, CASE WHEN id % 3 = 0 THEN 0 ELSE id END) AS ts",
    )
    plans = {
        "dedup": dedup_rows(hot.select("k", "v")),
        "counts": stage_row_counts(hot.select("k")),
        "topk": top_k_counts(hot, "k", 5),
        "daily": daily_totals(hot, "ts", "v"),
        "upsert": keyed_upsert(hot.selectExpr("k", "v", "1 AS b"), hot.selectExpr("k", "v", "2 AS b"), ["k"], "b"),
    }
    for name, df in plans.items():
        text = plan_text(df, "simple")
        assert _partial_before_exchange(text), name
    # the check itself: a ranking window shuffles raw rows (the hot key whole)
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    ranked = hot.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy(F.col("v").desc())))
    assert not _partial_before_exchange(plan_text(ranked.where("rn = 1"), "simple"))
    assert plans["dedup"].where("k = 'hot'").count() == 1
    assert plans["upsert"].where("k = 'hot'").first().b == 2


def test_window_prunes_day_partitions(spark, tmp_path):
    from sluice.plans.schemas import SMART_HOME_SOURCE
    from sluice.plans.smart_home import smart_home_etl

    rows = [
        tuple(["1451624400"] + ["0.1"] * (len(SMART_HOME_SOURCE) - 1)) + ("2016-01-01",),
        tuple(["1451710800"] + ["0.2"] * (len(SMART_HOME_SOURCE) - 1)) + ("2016-01-02",),
    ]
    schema = ", ".join(f"{c} string" for c in SMART_HOME_SOURCE) + ", day string"
    path = str(tmp_path / "by_day")
    spark.createDataFrame(rows, schema).write.partitionBy("day").parquet(path)
    raw = spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))
    window = ("2016-01-01 05:00:00", "2016-01-01 06:00:00")
    out = smart_home_etl(raw, "20240101000000000", window=window, staged=False, day_col="day")
    assert out.count() == 1
    scan = [line for line in plan_text(out).splitlines() if "PartitionFilters" in line]
    assert scan and all("day" in line for line in scan)


def test_after_the_stage_the_jobs_do_not_shuffle(spark, sf_small):
    for name in ("admissions_etl", "smart_home_etl", "global_power_stats"):
        text = plan_text(QUERIES[name](spark, sf_small), "simple")
        assert "Exchange hashpartitioning" not in text, name
        assert "Exchange RoundRobinPartitioning" not in text, name
        # only the statistics subquery's one-row merge crosses tasks
        assert text.count("Exchange SinglePartition") == 1, name


# --- windows from a table, files that don't overlap ------------------------------


def test_windows_of_a_table_prune_days(spark, tmp_path):
    from sluice.operators.shape import in_windows
    from sluice.sinks.files import publish

    path = str(tmp_path / "by_day")
    times = spark.range(10 * 24).selectExpr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, int(id)) AS time")
    publish(times.selectExpr("time", "to_date(time) AS day"), path, partition_by=["day"])
    windows = spark.createDataFrame(
        [("a", "2024-01-02 22:00:00", "2024-01-03 01:00:00"), ("b", "2024-01-03 00:00:00", "2024-01-03 02:00:00"),
         ("c", "2024-01-09 00:00:00", "2024-01-08 00:00:00"), ("d", None, "2024-01-08 00:00:00")],
        "name string, lo string, hi string",
    ).selectExpr("name", "CAST(lo AS TIMESTAMP_NTZ) AS lo", "CAST(hi AS TIMESTAMP_NTZ) AS hi")
    windows.write.parquet(str(tmp_path / "windows"))
    windows = spark.read.parquet(str(tmp_path / "windows"))
    out = in_windows(spark.read.parquet(path), windows, "time", "day")
    got = [r["time"].strftime("%d %H") for r in out.orderBy("time").collect()]
    assert got == ["02 22", "02 23", "03 00", "03 01", "03 02"]  # an overlap gives a row once
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    files = {d: len(list(tmp_path.glob(f"by_day/day=2024-01-{d}/*.parquet"))) for d in ("02", "03")}
    assert _scan_metrics(out)["numFiles"] == sum(files.values()) < len(list(tmp_path.glob("by_day/*/*.parquet")))


def _scan_metrics(df):
    """Metrics of a partitioned file scan of ``df``'s executed plan, else of any."""
    jdf = df._jdf
    jdf.collectToPython()  # runs this plan object, whose metrics are read
    found, stack = {}, [jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        elif name.endswith("QueryStage"):
            stack.append(node.plan())
        elif name.startswith("Scan "):
            metrics = node.metrics()
            for key in ("numFiles", "numPartitions", "numOutputRows"):
                if metrics.contains(key):
                    found[key] = metrics.apply(key).value()
            if "numPartitions" in found:
                return found
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))
    return found


def test_ordered_files_do_not_overlap_and_a_range_skips_some(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    from sluice.sinks.files import publish

    path = str(tmp_path / "ordered")
    df = spark.range(20_000).selectExpr("(id * 7919) % 20000 AS k", "id % 3 AS g").repartition(6)
    publish(df, path, order_by=["k", "g"], num_files=8, options={"parquet.block.size": "32768"})
    ranges = []
    for file in glob.glob(f"{path}/*.parquet"):
        keys = pq.read_table(file)["k"].to_pylist()
        assert keys == sorted(keys)
        ranges.append((keys[0], keys[-1]))
    ranges.sort()
    assert len(ranges) == 8 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    some = spark.read.parquet(path).where("k BETWEEN 5000 AND 5400")
    assert some.count() == 401
    assert _scan_metrics(some)["numOutputRows"] < 4_000  # the row groups of one file or two
    with pytest.raises(ValueError):
        publish(df, path, order_by=["k"], partition_by=["g"])
