"""File and table sinks.

Writers run on the executors, one file per task; nothing passes through the
driver. A frame that feeds several sinks should be written once and the
written table read back for the others (``write_once``), so nondeterministic
columns agree and the input is not recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import scratch_path
from sluice.sources.csv import CSV_OPTIONS

# Separator and quote of the unquoted writer's one column: control characters
# that text does not hold.
NO_SEPARATOR, NO_QUOTE = "\x01", "\x02"


def write_csv(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    header: bool = True,
    sep: str = ",",
) -> None:
    """Header CSV directory (quoted where needed), one part file per task.

    Leading and trailing blanks are kept (the writer trims them by default).
    The default mode fails if the directory exists, like the source jobs.
    """
    df.write.mode(mode).options(**{**CSV_OPTIONS, "header": header}).option("sep", sep).csv(path)


def unquoted_lines(df: DataFrame, sep: str = ",", null_text: str = "") -> DataFrame:
    """Each row as one text line, values joined by ``sep`` with no quoting.

    A value holding ``sep`` is written as is, so the line may have more
    fields than the header: that is what an unquoted writer produces.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(null_text)) for c in df.columns]
    return df.select(F.concat_ws(sep, *parts).alias("value"))


def write_unquoted_csv(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    sep: str = ",",
    header: bool = True,
    mode: str = "errorifexists",
) -> None:
    """CSV with quoting switched off, the header first in every part file.

    Each line is the one value of a column that is named like the header
    line and written with a separator and a quote that text does not hold
    (U+0001 and U+0002; a value holding them would be quoted).
    """
    lines = unquoted_lines(df, sep).toDF(sep.join(df.columns))
    options = {**CSV_OPTIONS, "header": header, "escape": NO_QUOTE, "quote": NO_QUOTE, "sep": NO_SEPARATOR, "emptyValue": ""}
    lines.write.mode(mode).options(**options).csv(path)


def publish(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    num_files: int | None = None,
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
    max_records_per_file: int | None = None,
    rebalance: bool | None = None,
    options: dict[str, str] | None = None,
    order_by: Sequence[str] | None = None,
) -> None:
    """Publish to a fixed directory, replacing what was there.

    By default the rows are written as they are partitioned (one file per
    task; after a shuffle AQE has already sized those partitions), adding
    no shuffle. ``num_files`` asks for an exact number of part files: a
    round-robin shuffle, so the stage computing the rows keeps its full
    parallelism, unlike ``coalesce``; keep it proportional to the data on
    large outputs. With ``partition_by`` the rows pass through a
    ``rebalance`` hint on those columns (unless ``rebalance=False``): each
    value's rows gather in few files, and AQE splits a value that holds a
    large share of the data over several. Only the partitions present in
    ``df`` are replaced (dynamic partition overwrite), so a batch
    republishes its own days without touching others.
    ``max_records_per_file`` bounds file size. ``order_by``: files that do not
    overlap in these columns, each sorted by them: Spark samples the rows and
    deals them out by range, so a later read of a range skips files and row
    groups by their minima and maxima. Rows of one value share a file unless
    further columns part them. With ``num_files`` that many ranges are made;
    AQE otherwise sizes them. CSV takes the options of
    ``write_csv``.

    Overwriting is not atomic: the old files go before the new ones are
    committed. ``publish_version`` keeps readers from seeing the gap.
    """
    if order_by and partition_by:
        raise ValueError("order_by ranges over the whole table: leave partition_by out")
    if order_by:
        ranged = df.repartitionByRange(num_files, *order_by) if num_files else df.repartitionByRange(*order_by)
        out = ranged.sortWithinPartitions(*order_by)
    elif num_files:
        out = df.repartition(num_files)
    elif partition_by and rebalance is not False:
        out = df.hint("rebalance", *partition_by)
    elif rebalance:
        out = df.hint("rebalance")
    else:
        out = df
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    writer.save(path)


def write_once(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    compression: str | None = None,
) -> DataFrame:
    """Write ``df`` to ``path`` and return the written table.

    Cuts lineage at a durable copy: later sinks read these files instead of
    recomputing (or re-drawing random ids from) the plan.
    """
    writer = df.write.mode("errorifexists").format(fmt)
    if compression:
        writer = writer.option("compression", compression)
    writer.save(path)
    return spark.read.format(fmt).load(path)


def stage(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table and continue from the files.

    The table goes to ``path`` or to a fresh folder under the session's
    checkpoint directory (shared storage on a cluster). Everything after
    this point reads the staged files: a whole-table statistic scans only
    the columns it needs, the rows are not recomputed (no second scan of
    the source, no second shuffle), and a lost executor costs a re-read of
    staged files rather than a replay of the lineage. Staged files are
    zstd-compressed: about a fifth smaller than snappy on these text-heavy
    rows, at the same write and read time.
    """
    spark = df.sparkSession
    return write_once(spark, df, path or scratch_path(spark, name), compression="zstd")


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    mode: str = "overwrite",
    batch_size: int = 10000,
    num_partitions: int | None = None,
    truncate: bool = True,
    options: dict[str, str] | None = None,
) -> None:
    """Write to a relational table over JDBC (default: full overwrite).

    Credentials come from the caller (never from code). ``truncate`` keeps
    the table definition on overwrite; ``num_partitions`` bounds the number
    of concurrent connections the executors open.
    """
    writer = (
        df.write.format("jdbc")
        .mode(mode)
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("truncate", truncate)
    )
    if user is not None:
        writer = writer.option("user", user)
    if password is not None:
        writer = writer.option("password", password)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for key, value in (options or {}).items():
        writer = writer.option(key, value)
    writer.save()
