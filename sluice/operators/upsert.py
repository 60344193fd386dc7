"""Keyed upsert: the newest version of each key wins.

Stands in for a key-value table put: writing a batch to a keyed table
replaces the rows whose key it carries and inserts the rest. Expressed as
``union`` + one aggregation on the key that keeps the row with the
greatest version (sort-based: a struct buffer cannot be hash-aggregated).
The aggregation combines map-side, so a key carried by a third of all rows
reaches its reducer as one row per map task, unlike a ``row_number()``
window that would sort the whole hot key in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import delete_path, scratch_path
from sluice.sinks.commits import Files

BUCKET_COLUMN = "key_bucket"


def keyed_upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    version_col: str,
) -> DataFrame:
    """Merge ``batch`` into ``existing`` by ``keys``, newest version first.

    Per key the row with the greatest ``version_col`` is kept; ties between
    equal versions go to the greatest remaining column values, so the
    result is deterministic. Schemas are matched by name.
    """
    return newest_versions(existing.unionByName(batch), keys, version_col)


def newest_versions(df: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """The row with the greatest version of each key, in one aggregation."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c != version_col]
    best = F.max(F.struct(F.col(version_col), *[F.col(c) for c in rest])).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(
        *keys, *[F.col("_best").getField(c).alias(c) for c in [version_col, *rest]]
    ).select(*df.columns)


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    """The directory a key lives in: its hash modulo ``buckets``."""
    return F.expr(f"CAST(pmod(xxhash64({', '.join(f'`{k}`' for k in keys)}), {buckets}) AS INT)")


def create_keyed_table(df: DataFrame, path: str, keys: Sequence[str], version_col: str, buckets: int) -> None:
    """Write ``df``, newest version per key, as a table of ``buckets`` directories.

    The rows pass a ``rebalance`` hint: a bucket's rows gather in few files,
    and AQE deals a large bucket out to several tasks.
    """
    newest = newest_versions(df, keys, version_col)
    placed = newest.withColumn(BUCKET_COLUMN, key_bucket(keys, buckets))
    placed.hint("rebalance", BUCKET_COLUMN).write.partitionBy(BUCKET_COLUMN).parquet(path)


def stage_upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    version_col: str,
    buckets: int,
    staged: str,
) -> None:
    """Write the merged rows of the buckets that ``batch`` touches to ``staged``.

    Only directories that hold a key of the batch are read. The batch's
    bucket numbers, at most ``buckets``, are all that the driver sees. Where
    there is no table at ``path`` yet, the batch is all of it.
    """
    batch = batch.withColumn(BUCKET_COLUMN, key_bucket(keys, buckets))
    if any(n.startswith(f"{BUCKET_COLUMN}=") for n in Files(spark, path).names("")):
        touched = [r[0] for r in batch.select(BUCKET_COLUMN).distinct().collect()]
        target = spark.read.parquet(path).where(F.col(BUCKET_COLUMN).isin(touched))
    else:
        target = batch.where("false")
    merged = keyed_upsert(target, batch, [*keys, BUCKET_COLUMN], version_col)
    merged.hint("rebalance", BUCKET_COLUMN).write.mode("overwrite").partitionBy(BUCKET_COLUMN).parquet(staged)


def replace_buckets(spark: SparkSession, path: str, staged: str) -> None:
    """Replace the buckets of the table at ``path`` that ``staged`` holds.

    Dynamic partition overwrite: the others keep their files. It can be
    repeated as long as ``staged`` exists, so a failure midway loses nothing.
    """
    if not any(n.startswith(f"{BUCKET_COLUMN}=") for n in Files(spark, staged).names("")):
        return
    (
        spark.read.parquet(staged).hint("rebalance", BUCKET_COLUMN)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET_COLUMN).parquet(path)
    )


def upsert_buckets(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    version_col: str,
    buckets: int,
) -> None:
    """Merge ``batch`` into a table of ``create_keyed_table``, in place.

    The merged rows are staged first (``stage_upsert``), since the directories
    they replace (``replace_buckets``) are those they were read from.
    """
    staged = scratch_path(spark, "upsert")
    stage_upsert(spark, path, batch, keys, version_col, buckets, staged)
    replace_buckets(spark, path, staged)
    delete_path(spark, staged)
