"""Incremental runs of the batch jobs over newly landed CSV files.

A scheduled workflow that re-runs a job whenever new files land is a file
stream with ``trigger(availableNow=True)``: each run processes exactly the
files not seen before (progress is kept in the stream's checkpoint), then
stops. Every micro-batch goes through the same batch job via
``foreachBatch``; its output is written under ``epoch=<n>`` with dynamic
partition overwrite, so a micro-batch that is retried after a failure
replaces its own earlier attempt instead of adding rows (exactly-once
output on top of the at-least-once batch call).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.clean import trace_counts
from sluice.operators.partials import partial_stats, with_folded_stats
from sluice.operators.shape import reorder_columns
from sluice.operators.stamp import new_batch_id
from sluice.session import delete_path, path_exists
from sluice.sources.csv import READ_OPTIONS, text_schema

EPOCH_COLUMN = "epoch"

BatchJob = Callable[..., DataFrame]


def csv_file_stream(
    spark: SparkSession,
    input_dir: str,
    columns: Sequence[str],
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Header CSV files of ``input_dir`` as a stream of text rows.

    A file whose header does not name ``columns`` in order fails the stream.
    """
    reader = spark.readStream.schema(text_schema(columns)).options(**READ_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(input_dir)


def first_time_rows(
    stream: DataFrame, keys: Sequence[str], watermark: tuple[str, str] | None = None
) -> DataFrame:
    """Rows of a stream whose ``keys`` no earlier row of it had, in any
    micro-batch or run of the same checkpoint.

    The keys seen are kept in the query's state store, so a narrow key (the
    row key, not the whole row) keeps it small; with very many keys choose the
    RocksDB provider (``spark.sql.streaming.stateStore.providerClass``), which
    holds them on disk. Without a watermark they are kept for ever.
    ``watermark`` (event time column, delay): only rows within the delay of
    each other are duplicates, and state beyond it goes.
    """
    if watermark is None:
        return stream.dropDuplicates(list(keys))
    column, delay = watermark
    return stream.withWatermark(column, delay).dropDuplicatesWithinWatermark(list(keys))


def _replace_epoch(df: DataFrame, epoch_id: int, path: str) -> None:
    """Write a micro-batch's rows in place of an earlier attempt's."""
    (
        df.withColumn(EPOCH_COLUMN, F.lit(epoch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(EPOCH_COLUMN)
        .parquet(path)
    )


def _writer(
    job: BatchJob,
    output_dir: str,
    batch_id_for: Callable[[int], str],
    stage_dir: str | None,
    partials_dir: str | None = None,
    partial_columns: Sequence[str] = (),
    counts_dir: str | None = None,
) -> Callable[[DataFrame, int], None]:
    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        stage = None if stage_dir is None else f"{stage_dir.rstrip('/')}/epoch={epoch_id}"
        if stage:  # what an attempt that failed may have left
            delete_path(spark, stage)
        options = {} if stage is None else {"staged": stage}
        trace: dict | None = None
        if counts_dir:
            trace = options["trace"] = {}
        out = job(batch, batch_id_for(epoch_id), **options)
        _replace_epoch(out, epoch_id, output_dir)
        if partials_dir:
            folder = f"{output_dir.rstrip('/')}/{EPOCH_COLUMN}={epoch_id}"
            if path_exists(spark, folder):
                written = spark.read.schema(out.schema).parquet(folder)
            else:  # every row had been seen before
                written = spark.createDataFrame([], out.schema)
            _replace_epoch(partial_stats(written, partial_columns), epoch_id, partials_dir)
        if trace is not None:
            steps = [(n, step, rows) for n, (step, rows) in enumerate(trace_counts(trace).items())]
            counts = spark.createDataFrame(steps, "position int, step string, rows bigint").coalesce(1)
            _replace_epoch(counts, epoch_id, counts_dir)
        if stage:
            delete_path(spark, stage)

    return write_batch


def run_incremental(
    spark: SparkSession,
    job: BatchJob,
    input_dir: str,
    columns: Sequence[str],
    output_dir: str,
    checkpoint_dir: str,
    batch_id_for: Callable[[int], str] | None = None,
    max_files_per_trigger: int | None = None,
    wait: bool | None = None,
    trigger: dict | None = None,
    stage_dir: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    distinct_on: Sequence[str] | None = None,
    watermark: tuple[str, str] | None = None,
    partials_dir: str | None = None,
    partial_columns: Sequence[str] = (),
    counts_dir: str | None = None,
) -> StreamingQuery:
    """Process every file not yet seen in ``input_dir`` with ``job``, then stop.

    ``job(batch_df, batch_id)`` is a batch job such as the admissions or
    smart-home flow (whole-table statistics are then per micro-batch, as
    for a scheduled run). ``batch_id_for(epoch)`` names each micro-batch;
    by default the driver clock at the time the micro-batch runs.

    ``trigger`` defaults to ``{"availableNow": True}`` (drain and stop, the
    scheduled-run form, waited for); ``{"processingTime": "5 minutes"}``
    keeps the query running and returns it at once (``wait`` overrides).

    ``stage_dir``: where ``job`` stages a micro-batch (it is called with
    ``staged=<stage_dir>/epoch=<n>``); the folder is deleted once the
    micro-batch's output is committed, so a query that runs for ever keeps
    none. Without it the job stages as it was told to.

    State across micro-batches: ``prepare`` is a narrow step on the stream
    (cleaning, keys) and ``distinct_on`` (with ``watermark``) drops rows that
    any earlier micro-batch had, see ``first_time_rows``. ``partials_dir``:
    each micro-batch leaves one row of ``partial_stats`` of its output's
    ``partial_columns`` there, to be folded over all of them; it is read from
    the committed output, so a lost executor can't count a row twice.

    ``counts_dir``: the job's row counts after each step (``trace=``, observed
    while the micro-batch is written) are stored there per epoch.
    """
    trigger = trigger or {"availableNow": True}
    if wait is None:
        wait = bool(trigger.get("availableNow") or trigger.get("once"))
    stream = csv_file_stream(spark, input_dir, columns, max_files_per_trigger)
    if prepare is not None:
        stream = prepare(stream)
    if distinct_on:
        stream = first_time_rows(stream, distinct_on, watermark)
    write = _writer(
        job, output_dir, batch_id_for or (lambda _: new_batch_id()), stage_dir, partials_dir, partial_columns, counts_dir
    )
    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir).trigger(**trigger).start()
    )
    if wait:
        query.awaitTermination()
    return query


def admissions_job(names: Mapping[str, str] | None = None, **options) -> BatchJob:
    """The admissions flow as a micro-batch job."""
    from sluice.plans.admissions import admissions_etl

    return lambda df, batch_id, **staging: admissions_etl(df, batch_id, names=names, **{**options, **staging})


def smart_home_job(names: Mapping[str, str] | None = None, **options) -> BatchJob:
    """The smart-home flow as a micro-batch job."""
    from sluice.plans.smart_home import smart_home_etl

    return lambda df, batch_id, **staging: smart_home_etl(df, batch_id, names=names, **{**options, **staging})


# --- whole-table figures over all micro-batches --------------------------------


@dataclass(frozen=True)
class FoldedFlow:
    """A flow whose duplicates and whole-table statistics span all runs.

    Rows go through ``prepare`` on the stream, repeated row keys are dropped
    by its state, ``rows`` finishes a micro-batch without statistics, and
    ``read`` attaches the statistics folded over every micro-batch so far.
    """

    prepare: Callable[[DataFrame], DataFrame]
    rows: BatchJob
    read: Callable[[DataFrame, DataFrame], DataFrame]
    key: str
    columns: Sequence[str]

    def run(self, spark: SparkSession, input_dir: str, header: Sequence[str], root: str, **options) -> StreamingQuery:
        """Process the files not seen yet; ``root`` keeps rows, partials,
        counts and checkpoint. ``options`` are those of ``run_incremental``."""
        root = root.rstrip("/")
        return run_incremental(
            spark, self.rows, input_dir, header, f"{root}/rows", f"{root}/checkpoint", prepare=self.prepare,
            distinct_on=[self.key], partials_dir=f"{root}/partials", partial_columns=self.columns, **options,
        )

    def result(self, spark: SparkSession, root: str) -> DataFrame:
        """The rows of all micro-batches with the statistics of all of them."""
        root = root.rstrip("/")
        rows = spark.read.parquet(f"{root}/rows").drop(EPOCH_COLUMN)
        return self.read(rows, spark.read.parquet(f"{root}/partials"))


def smart_home_folded(names: Mapping[str, str] | None = None, window: tuple[str, str] | None = None) -> FoldedFlow:
    """The smart-home flow over all runs: equal to one run over all files."""
    from sluice.plans import smart_home as plan
    from sluice.plans.schemas import SMART_HOME_OUTPUT, resolve

    house = resolve(names, "house_overall")
    stats = {resolve(names, out): (house, stat) for out, stat in plan.POWER_STATS.items()}

    def read(rows: DataFrame, partials: DataFrame) -> DataFrame:
        return reorder_columns(with_folded_stats(rows, partials, stats), [resolve(names, c) for c in SMART_HOME_OUTPUT])

    return FoldedFlow(
        prepare=lambda raw: plan.smart_home_keyed(raw, names, window),
        rows=lambda df, batch_id, **_: plan.smart_home_rows(plan.smart_home_first_seen(df, names), batch_id, names),
        read=read, key=resolve(names, "row_key"), columns=[house],
    )


def admissions_folded(names: Mapping[str, str] | None = None) -> FoldedFlow:
    """The admissions flow over all runs: scores by the maxima of all files."""
    from sluice.plans import admissions as plan
    from sluice.plans.schemas import resolve

    return FoldedFlow(
        prepare=lambda raw: plan.admissions_keyed(raw, names),
        rows=lambda df, batch_id, **_: plan.admissions_rows(plan.admissions_first_seen(df, names), batch_id, names),
        read=lambda rows, partials: plan.admissions_scored(rows, names, partials),
        key=resolve(names, "row_key"), columns=[resolve(names, "age"), resolve(names, "billing_amount")],
    )
