"""Registered queries: one per operator of the inventory, plus the jobs.

Every query takes ``(spark, sf_dir)``, reads whole driver tables (through
the derived admissions / smart-home views) and returns a DataFrame whose
column names match the DuckDB text in ``sluice.plans.oracle``. Sink
queries write to a fresh folder under the session's checkpoint directory
and read the written files back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.columns import (
    BLANK_SENTINELS,
    REJECT_SENTINELS,
    epoch_seconds_to_text,
    number,
    round_half_even,
    round_half_up,
)
from sluice.operators.bucketed import create_bucketed, merge_into, read_bucketed
from sluice.operators.clean import (
    blank_sentinels,
    dedup_rows,
    drop_blank_rows,
    reject_sentinel_rows,
    stage_row_counts,
)
from sluice.operators.shape import (
    add_totals,
    cast_by_schema,
    epoch_to_timestamp,
    format_amount,
    in_windows,
    parse_dates,
    reorder_columns,
    round_column,
    stay_days,
    text_to_timestamp,
)
from sluice.operators.stamp import batch_stamp, random_row_id, row_key
from sluice.operators.stats import (
    argmax_column,
    day_extremes,
    day_over_day_delta,
    describe_columns,
    global_stats,
    risk_score,
    top_k_counts,
    with_day_extremes,
)
from sluice.operators.upsert import BUCKET_COLUMN, create_keyed_table, keyed_upsert, upsert_buckets
from sluice.plans.admissions import (
    DATE_FORMAT,
    admissions_clean,
    admissions_etl,
    admissions_etl_reject,
    admissions_rejected,
)
from sluice.plans.schemas import (
    ADMISSIONS_OUTPUT,
    ADMISSIONS_SOURCE,
    ADMISSIONS_TYPES,
    ADMISSIONS_WORKFLOW_HEADERS,
    ADMISSIONS_WORKFLOW_OUTPUT,
    POWER_FIELDS,
    SMART_HOME_SOURCE,
    SMART_HOME_TOTALS,
)
from sluice.plans.smart_home import (
    smart_home_clean,
    smart_home_etl,
    smart_home_timed,
    smart_home_totals,
    smart_home_typed,
    with_power_stats,
)
from sluice.session import scratch_path
from sluice.sinks.commits import publish_version, read_published
from sluice.sinks.files import publish, stage, write_csv, write_unquoted_csv
from sluice.sources.csv import fitting_rows, misfit_lines, read_checked_csv, read_csv_by_name, read_text_csv
from sluice.sources.fixtures import admissions_raw, smart_home_raw
from sluice.sources.tables import read_table
from sluice.streaming.incremental import (
    EPOCH_COLUMN,
    FoldedFlow,
    admissions_folded,
    admissions_job,
    run_incremental,
    smart_home_folded,
    smart_home_job,
)

# Parameters of the registered queries.
BATCH_ID = "20240131123456789"
DAY_SLICE = ("2024-01-05 00:00:00", "2024-01-06 00:00:00")
EXTREMES_DAY = "2024-01-01"
REORDER_FIRST = ("test_results", "name", "age")
PREVIEW_ROWS = 20
TOP_TIMES = 10
PUBLISHED_ROWS_PER_FILE = 1_000_000
UPSERT_RAISE = 1.05
UPSERT_INSERTS = 10_000_000_000  # added to the keys of the batch's new rows
UPSERT_BUCKETS = 16
SHORT_FIELDS = 13  # fields of the lines that are too short
DRIFT_MISSING = ("doctor", "medication")  # columns that one of the files lacks
WINDOWS_FROM = "2024-01-02 05:00:00"
STREAM_FILES = 5
#: Rows of a landed file at most, about: what one task gathers and writes.
STREAM_FILE_ROWS = 250_000
COUNTED_RUNS = 3
# Figures that depend on the order sums are merged in are compared at this scale.
COMPARED_SCALE = 6
# Numeric source columns cast in place; the day-first dates go through
# ``parse_dates`` (a plain cast only reads ISO dates).
SOURCE_CASTS = {"age": "int", "billing_amount": "double", "room_number": "int"}

Query = Callable[[SparkSession, str], DataFrame]


# --- admissions: cleaning and shaping operators ----------------------------

def q_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header CSV read back as text."""
    path = scratch_path(spark, "csv_scan")
    write_csv(admissions_raw(spark, sf_dir), path)
    return read_text_csv(spark, path)


def q_batch_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch id and date stamped on every row."""
    return batch_stamp(admissions_raw(spark, sf_dir), BATCH_ID)


def q_row_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic content key per row."""
    return row_key(admissions_raw(spark, sf_dir), ADMISSIONS_SOURCE)


def q_random_row_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Random ids cannot be compared value by value; their defining
    property can: one distinct id per row."""
    ids = random_row_id(admissions_raw(spark, sf_dir), "uuid")
    return ids.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("uuid").alias("distinct_ids")
    )


def q_reject_sentinel_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows holding a sentinel (or null) dropped."""
    return reject_sentinel_rows(admissions_raw(spark, sf_dir), REJECT_SENTINELS)


def q_blank_sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sentinel text replaced by null."""
    return blank_sentinels(admissions_raw(spark, sf_dir), BLANK_SENTINELS)


def q_drop_blank_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rows blank in every source column dropped."""
    blanked = blank_sentinels(admissions_raw(spark, sf_dir), BLANK_SENTINELS)
    return drop_blank_rows(blanked, ADMISSIONS_SOURCE)


def q_dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate rows removed."""
    return dedup_rows(admissions_raw(spark, sf_dir))


def q_stage_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: row counts after each cleaning stage, one shuffle."""
    return stage_row_counts(admissions_raw(spark, sf_dir), BLANK_SENTINELS)


def q_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-first date text parsed."""
    return parse_dates(admissions_raw(spark, sf_dir), ["date_of_admission", "discharge_date"], DATE_FORMAT)


def q_stay_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole days between admission and discharge."""
    return stay_days(q_parse_dates(spark, sf_dir), "date_of_admission", "discharge_date")


def q_round_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing rounded to cents (decimal HALF_UP)."""
    return round_column(admissions_raw(spark, sf_dir), "billing_amount", 2)


def q_format_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing as grouped text and HALF_EVEN number."""
    df = admissions_raw(spark, sf_dir)
    amount = number("billing_amount")
    return df.select(
        "name",
        "billing_amount",
        format_amount("billing_amount", 2).alias("billing_text"),
        round_half_even(amount, 2).alias("billing_even"),
    )


def q_cast_by_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric source columns cast by a type map."""
    return cast_by_schema(admissions_raw(spark, sf_dir), SOURCE_CASTS)


def q_reorder_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen columns first, the rest after."""
    return reorder_columns(admissions_raw(spark, sf_dir), REORDER_FIRST)


def q_scalar_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, P10: typed maxima of the cleaned rows (one row)."""
    clean = admissions_clean(admissions_raw(spark, sf_dir), distinct=False)
    return global_stats(
        clean,
        {
            "max_age": F.max(F.col("age").try_cast("int")),
            "max_billing": F.max(number("billing_amount")),
        },
    )


def q_text_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: lexicographic maxima of the text columns (one row)."""
    clean = admissions_clean(admissions_raw(spark, sf_dir), distinct=False)
    return global_stats(
        clean,
        {"max_age_text": F.max("age"), "max_billing_text": F.max("billing_amount")},
    )


def _scored(df: DataFrame, name: str, **options) -> DataFrame:
    """Scores over rows staged once: the maxima re-read two columns of them."""
    return risk_score(stage(df, name), "age", "medical_condition", "billing_amount", **options)


def q_risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section 2.10: score over rejected + deduplicated rows, typed maxima."""
    return _scored(admissions_rejected(admissions_raw(spark, sf_dir)), "risk_score")


def q_risk_score_text_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section 2.10, A2: score with text maxima, rounded on decimal digits."""
    return _scored(admissions_clean(admissions_raw(spark, sf_dir)), "risk_score_text", text_maxima=True)


def q_risk_score_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score as the final flow had it, text maxima and binary rounding."""
    df = admissions_clean(admissions_raw(spark, sf_dir))
    return _scored(df, "risk_score_binary", text_maxima=True, rounding="binary")


def q_risk_score_mixed_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Section 2.10: the scheduled flow's maxima, ages as text and billing as numbers."""
    df = round_column(admissions_rejected(admissions_raw(spark, sf_dir)), "billing_amount", 2)
    return _scored(df, "risk_score_mixed", text_maxima={"age"}, rounding="binary", round_billing_first=False)


def q_preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: first rows in a total order (the limit is the feature)."""
    clean = admissions_clean(admissions_raw(spark, sf_dir))
    order = [F.col(c).asc_nulls_last() for c in ADMISSIONS_SOURCE]
    return clean.orderBy(*order).limit(PREVIEW_ROWS)


# --- admissions: sinks (written, then read back) ---------------------------

def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: job output written as CSV and read back typed."""
    path = scratch_path(spark, "csv_roundtrip")
    write_csv(admissions_etl(admissions_raw(spark, sf_dir), BATCH_ID), path)
    back = read_text_csv(spark, path, ADMISSIONS_OUTPUT)
    return cast_by_schema(back, ADMISSIONS_TYPES)


def q_csv_unquoted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: unquoted CSV lines; every part file's first line is the header."""
    path = scratch_path(spark, "csv_unquoted")
    write_unquoted_csv(spark, admissions_raw(spark, sf_dir), path)
    header = ",".join(ADMISSIONS_SOURCE)
    lines = spark.read.text(path)
    head = lines.where(F.col("value") == header).distinct()
    return head.union(lines.where(F.col("value") != header))


def q_csv_unquoted_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: columns without commas, written unquoted in several parts, read
    back as header CSV: every row returns. More rows make more parts, not
    larger ones, as a part is one task's work."""
    path = scratch_path(spark, "csv_unquoted_readback")
    df = admissions_raw(spark, sf_dir).drop("hospital")
    parts = max(5, -(-df.count() // PUBLISHED_ROWS_PER_FILE))
    write_unquoted_csv(spark, df.repartition(parts, "name"), path)
    return read_text_csv(spark, path, df.columns)


def q_repartition_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3, K4: publish to a fixed directory twice; the second replaces."""
    path = scratch_path(spark, "publish")
    clean = stage(admissions_clean(admissions_raw(spark, sf_dir)), "publish_stage")
    for _ in range(2):  # a re-run replaces, never appends
        publish(clean, path, rebalance=True, max_records_per_file=PUBLISHED_ROWS_PER_FILE)
    return spark.read.parquet(path)


def _upsert_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders as the table, and all again as the batch: half of the
    batch's keys are in the table (updates), half are new (inserts)."""
    orders = read_table(spark, sf_dir, "orders")
    existing = orders.select(
        F.col("o_orderkey").alias("key"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.lit(1).cast("bigint").alias("batch"),
    )
    shift = F.when(F.col("o_custkey") % 2 == 0, 0).otherwise(UPSERT_INSERTS)
    incoming = orders.select(
        (F.col("o_orderkey") + shift).alias("key"),
        round_half_even(F.col("o_totalprice") * F.lit(UPSERT_RAISE), 2).alias("amount"),
        F.col("o_orderstatus").alias("status"),
        F.lit(2).cast("bigint").alias("batch"),
    )
    return existing, incoming


def q_keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: newest version per key wins."""
    return keyed_upsert(*_upsert_sides(spark, sf_dir), ["key"], "batch")


def q_keyed_upsert_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the same merge into a bucketed table, touched buckets only."""
    existing, incoming = _upsert_sides(spark, sf_dir)
    path = scratch_path(spark, "keyed_table")
    create_keyed_table(existing, path, ["key"], "batch", UPSERT_BUCKETS)
    upsert_buckets(spark, path, incoming, ["key"], "batch", UPSERT_BUCKETS)
    return spark.read.parquet(path).drop(BUCKET_COLUMN)


def q_admissions_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The final admissions flow (blanking)."""
    return admissions_etl(admissions_raw(spark, sf_dir), BATCH_ID)


def q_admissions_etl_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scheduled admissions flow (rejecting, HALF_EVEN score), with its
    own column names and order."""
    raw = admissions_raw(spark, sf_dir)
    physical = raw.toDF(*[ADMISSIONS_WORKFLOW_HEADERS[c] for c in raw.columns])
    return admissions_etl_reject(
        physical, BATCH_ID, names=ADMISSIONS_WORKFLOW_HEADERS, columns=ADMISSIONS_WORKFLOW_OUTPUT
    )


# --- smart home -------------------------------------------------------------

def _sh_house(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    clean = smart_home_clean(smart_home_raw(spark, sf_dir), distinct=distinct)
    return smart_home_totals(smart_home_typed(clean))


def q_epoch_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch text -> timestamp_ntz."""
    return epoch_to_timestamp(smart_home_raw(spark, sf_dir), "time")


def q_text_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epoch -> 'yyyy-MM-dd HH:mm:ss' text -> timestamp, as the source job did."""
    raw = smart_home_raw(spark, sf_dir).select(
        "use_kw", epoch_seconds_to_text("time").alias("time_text")
    )
    return text_to_timestamp(raw, "time_text", out="time")


def q_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """inclusive one-day slice."""
    return smart_home_timed(smart_home_raw(spark, sf_dir), window=DAY_SLICE)


def q_power_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Circuit totals, parts dropped."""
    typed = smart_home_typed(smart_home_clean(smart_home_raw(spark, sf_dir)))
    return add_totals(typed, SMART_HOME_TOTALS, drop_parts=True)


def q_house_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """House total recomputed from its parts."""
    return _sh_house(spark, sf_dir)


def _compared(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` (by default the average) rounded for the comparison."""
    return df.withColumns({c: round_half_up(c, COMPARED_SCALE) for c in columns or ("avg_power",)})


def _sh_house_staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The house rows written once: statistics attached to every row then
    read the staged table instead of repeating the dedup shuffle."""
    return stage(_sh_house(spark, sf_dir), name)


def q_global_power_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Max / min / avg of the house total attached to every row."""
    return _compared(with_power_stats(_sh_house_staged(spark, sf_dir, "power_stats_stage"))).select(
        "time", "house_overall", "max_power", "min_power", "avg_power"
    )


def q_top_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, O1: ten most frequent times."""
    timed = smart_home_timed(smart_home_raw(spark, sf_dir))
    return top_k_counts(timed, "time", TOP_TIMES)


def q_day_over_day_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily totals and change from the day before."""
    house = _sh_house_staged(spark, sf_dir, "day_delta_stage")
    return _compared(day_over_day_delta(house, "time", "house_overall"), "total", "delta")


def q_day_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's max, min and total (one row)."""
    out = day_extremes(_sh_house(spark, sf_dir), "time", "house_overall", EXTREMES_DAY)
    return _compared(out, "sum_total_overall")


def q_day_extremes_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's max and min attached to every row."""
    house = _sh_house_staged(spark, sf_dir, "day_extremes_stage").select("time", "house_overall")
    return with_day_extremes(house, "time", "house_overall", EXTREMES_DAY)


def q_argmax_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The circuit with the largest reading."""
    return argmax_column(_sh_house(spark, sf_dir, distinct=False), POWER_FIELDS)


def q_describe_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of every number and text column of the readings."""
    return _compared(describe_columns(_sh_house(spark, sf_dir)), "mean", "stddev")


def q_smart_home_etl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smart-home flow over the whole table."""
    return _compared(smart_home_etl(smart_home_raw(spark, sf_dir), BATCH_ID))


def q_smart_home_etl_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smart-home flow over a one-day window."""
    return _compared(smart_home_etl(smart_home_raw(spark, sf_dir), BATCH_ID, window=DAY_SLICE))


# --- incremental (file stream) runs -------------------------------------------

def _stream_through(spark: SparkSession, raw: DataFrame, job, columns, name: str) -> DataFrame:
    """Land ``raw`` as CSV files, run the job over them as one stream run."""
    landing = scratch_path(spark, f"{name}_landing")
    write_csv(raw, landing)
    out = scratch_path(spark, f"{name}_out")
    run_incremental(
        spark, job, landing, columns, out, scratch_path(spark, f"{name}_ckpt"),
        batch_id_for=lambda _epoch: BATCH_ID, stage_dir=scratch_path(spark, f"{name}_stage"),
    )
    return spark.read.parquet(out).drop(EPOCH_COLUMN)


def q_admissions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The admissions flow as one incremental run over landed CSV files."""
    return _stream_through(spark, admissions_raw(spark, sf_dir), admissions_job(), ADMISSIONS_SOURCE, "adm_stream")


def q_smart_home_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smart-home flow as one incremental run over landed CSV files."""
    out = _stream_through(spark, smart_home_raw(spark, sf_dir), smart_home_job(), SMART_HOME_SOURCE, "sh_stream")
    return _compared(out)


# --- input that does not fit ----------------------------------------------------

def _line(columns: Sequence[str]) -> Column:
    """A CSV line of text columns; hospitals hold a comma and are quoted."""
    def quoted(c: str) -> Column:
        return F.when(F.col(c) != "", F.concat(F.lit('"'), c, F.lit('"'))).otherwise("") if c == "hospital" else F.col(c)

    return F.concat_ws(",", *[quoted(c) for c in columns])


def q_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed lines with too few or too many fields or an unclosed quote;
    every line is a fitting row or a misfit with its reason."""
    path = scratch_path(spark, "csv_quarantine")
    last = F.try_to_number("room_number", F.lit("999")).cast("int") % 10
    line = _line(ADMISSIONS_SOURCE)
    lines = admissions_raw(spark, sf_dir).select(
        F.when(last == 3, _line(ADMISSIONS_SOURCE[:SHORT_FIELDS]))
        .when(last == 5, F.concat(line, F.lit(",extra,more")))
        .when(last == 7, F.replace(line, F.lit(' Group"'), F.lit(" Group")))
        .otherwise(line)
        .alias(",".join(ADMISSIONS_SOURCE))
    )
    write_unquoted_csv(spark, lines, path)
    checked = read_checked_csv(spark, path, ADMISSIONS_SOURCE)
    text = F.concat_ws("|", *[F.coalesce(c, F.lit("<null>")) for c in ADMISSIONS_SOURCE])
    fits = fitting_rows(checked).select(F.lit("fits").alias("outcome"), text.alias("line"), F.lit(len(ADMISSIONS_SOURCE)).alias("n_fields"))
    return fits.union(misfit_lines(checked).select("reason", "line", "n_fields"))


def q_csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose headers differ in order and in columns, read by name."""
    raw = admissions_raw(spark, sf_dir)
    part = F.coalesce(F.try_to_number("room_number", F.lit("999")).cast("int") % 3, F.lit(0))
    shapes = [
        list(ADMISSIONS_SOURCE),
        list(reversed(ADMISSIONS_SOURCE)),
        [c for c in ADMISSIONS_SOURCE if c not in DRIFT_MISSING] + ["ward"],
    ]
    paths = [scratch_path(spark, f"csv_by_name_{n}") for n in range(len(shapes))]
    for n, (columns, path) in enumerate(zip(shapes, paths)):
        rows = raw.where(part == n).withColumn("ward", F.concat(F.lit("W"), "room_number"))
        write_csv(rows.select(*columns), path)
    return read_csv_by_name(spark, paths, [*ADMISSIONS_SOURCE, "ward"], required=["name"])


# --- published versions and keyed tables in buckets --------------------------------

def q_publish_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: two versions under one name; a reader of the first keeps it."""
    root = scratch_path(spark, "published")
    raw = admissions_raw(spark, sf_dir)
    publish_version(admissions_clean(raw), root)
    held = read_published(spark, root)
    publish_version(admissions_rejected(raw), root)
    return held.withColumn("version", F.lit(1)).union(read_published(spark, root).withColumn("version", F.lit(2)))


def q_keyed_upsert_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the merge into a table bucketed by key, whose rows aren't shuffled."""
    existing, incoming = _upsert_sides(spark, sf_dir)
    root = scratch_path(spark, "bucketed_table")
    create_bucketed(existing, root, ["key"], "batch", UPSERT_BUCKETS)
    merge_into(spark, root, incoming)
    return read_bucketed(spark, root)


def q_range_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: the orders in files that don't overlap in date, each sorted."""
    path = scratch_path(spark, "range_publish")
    publish(read_table(spark, sf_dir, "orders"), path, order_by=["o_orderdate", "o_orderkey"])
    return spark.read.parquet(path)


# --- windows from a parameter table ------------------------------------------------

def window_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A parameter table: a window of a day and an hour for each region."""
    return read_table(spark, sf_dir, "region").selectExpr(
        "r_regionkey",
        f"TIMESTAMP_NTZ'{WINDOWS_FROM}' + make_dt_interval(int(3 * r_regionkey)) AS lo",
        f"TIMESTAMP_NTZ'{WINDOWS_FROM}' + make_dt_interval(int(3 * r_regionkey + 1), 1) AS hi",
    )


def q_time_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings laid out by day, in the windows of a parameter table
    (those of odd regions); other days' files are not read."""
    path = scratch_path(spark, "by_day")
    timed = smart_home_timed(smart_home_raw(spark, sf_dir)).withColumn("day", F.to_date("time"))
    publish(timed, path, partition_by=["day"])
    windows = window_table(spark, sf_dir).where("r_regionkey % 2 = 1")
    return in_windows(spark.read.parquet(path), windows, "time", "day").drop("day")


# --- state across micro-batches --------------------------------------------------------

def _in_files(raw: DataFrame, spark: SparkSession, name: str) -> tuple[str, int]:
    """``raw`` and a second copy of it dealt out over files, so that equal
    rows lie in different files.

    Returns the folder and the files of a micro-batch, of which there are
    ``STREAM_FILES``: with more rows a micro-batch has more files, not larger
    ones, as a file is one task's work.
    """
    landing = scratch_path(spark, f"{name}_landing")
    a_batch = max(1, -(-2 * raw.count() // (STREAM_FILES * STREAM_FILE_ROWS)))
    write_csv(raw.union(raw).repartition(STREAM_FILES * a_batch), landing)
    return landing, a_batch


def _folded(spark: SparkSession, raw: DataFrame, flow: FoldedFlow, columns: Sequence[str], name: str) -> DataFrame:
    root = scratch_path(spark, name)
    landing, a_batch = _in_files(raw, spark, name)
    flow.run(spark, landing, columns, root, batch_id_for=lambda _epoch: BATCH_ID, max_files_per_trigger=a_batch)
    return flow.result(spark, root)


def q_smart_home_stream_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1, W1-W3 across runs: several micro-batches, a row once, and the
    statistics of all of them."""
    return _compared(
        _folded(spark, smart_home_raw(spark, sf_dir), smart_home_folded(), SMART_HOME_SOURCE, "sh_folded")
    )


def q_admissions_stream_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1, A1 across runs: several micro-batches, scores by all maxima."""
    return _folded(spark, admissions_raw(spark, sf_dir), admissions_folded(), ADMISSIONS_SOURCE, "adm_folded")


def q_stream_step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 in streams: the row counts after each step of every micro-batch."""
    root = scratch_path(spark, "step_counts")
    raw = admissions_raw(spark, sf_dir)
    part = F.coalesce(F.try_to_number("room_number", F.lit("999")).cast("int") % COUNTED_RUNS, F.lit(0))
    for n in range(COUNTED_RUNS):  # one run per landed slice
        write_csv(raw.where(part == n), f"{root}/landing", mode="append")
        run_incremental(
            spark, admissions_job(), f"{root}/landing", ADMISSIONS_SOURCE, f"{root}/rows", f"{root}/checkpoint",
            batch_id_for=lambda _epoch: BATCH_ID, stage_dir=f"{root}/stage", counts_dir=f"{root}/counts",
        )
    return spark.read.parquet(f"{root}/counts").select(EPOCH_COLUMN, "step", "rows")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
