"""Keyed tables that are merged without moving their rows.

The table is written in buckets of its key's hash, sorted by key, so a join on
the key reads it as it lies: the batch alone is shuffled, to the same buckets.
Each merge is a new version under the table's root (``publish_version``), so
readers never see a half merged table and of two mergers one wins.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.columns import ident
from sluice.operators.upsert import newest_versions
from sluice.sinks.commits import current_version, publish_version, version_record


def _write_buckets(keys: Sequence[str], buckets: int):
    def write(df: DataFrame, folder: str) -> None:
        name = f"sluice_write_{uuid.uuid4().hex}"
        (
            df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
            .option("path", folder).option("compression", "zstd").saveAsTable(name)
        )
        df.sparkSession.sql(f"DROP TABLE {name}")  # the files of a table with a path stay

    return write


def create_bucketed(df: DataFrame, root: str, keys: Sequence[str], version_col: str, buckets: int) -> int:
    """Publish ``df``, newest version per key, as version 1 of a bucketed table.

    ``buckets`` is fixed for the table's life; choose it for a bucket to fit a
    task (about table bytes / 256 MB). Keys are unique in the table, so no
    bucket is larger than its share of keys.
    """
    newest = newest_versions(df, keys, version_col).repartition(buckets, *keys)
    return publish_version(newest, root, based_on=0, write=_write_buckets(keys, buckets),
                           extra={"keys": list(keys), "version_col": version_col, "buckets": buckets})


def read_bucketed(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of ``version``, known to Spark as bucketed and sorted."""
    version = current_version(spark, root) if version is None else version
    record = version_record(spark, root, version)
    keys = ", ".join(ident(k) for k in record["keys"])
    columns = ", ".join(f"{ident(f.name)} {f.dataType.simpleString()}" for f in record["schema"].fields)
    name = f"sluice_read_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
        f"INTO {record['buckets']} BUCKETS LOCATION '{record['location']}'"
    )
    return spark.table(name)


def merged_with(existing: DataFrame, batch: DataFrame, keys: Sequence[str], version_col: str) -> DataFrame:
    """``existing`` (one row per key) with ``batch`` merged in, newest first.

    Equal to ``keyed_upsert``, as a full outer join on the key: a bucketed
    ``existing`` is joined where it lies. The batch is reduced to one row per
    key first (map-side combined), so a key that a third of it carries is one
    row in the join.
    """
    rest = [c for c in existing.columns if c not in keys and c != version_col]
    fields = [version_col, *rest]
    fresh = newest_versions(batch.select(*existing.columns), keys, version_col)
    old = existing.select(*keys, F.struct(*fields).alias("_old"))
    new = fresh.select(*keys, F.struct(*fields).alias("_new"))
    best = F.greatest("_old", "_new")
    return (
        old.join(new, list(keys), "full_outer").withColumn("_best", best)
        .select(*keys, *[F.col("_best").getField(c).alias(c) for c in fields]).select(*existing.columns)
    )


def merge_into(spark: SparkSession, root: str, batch: DataFrame, by: str | None = None) -> int:
    """Merge ``batch`` into the bucketed table under ``root`` as its next version.

    The target's rows are read and written in their buckets and never
    shuffled. A merger that finds a later version than the one it started
    from raises ``PublishConflict`` and can merge again: a batch merged twice
    is merged once.
    """
    version = current_version(spark, root)
    record = version_record(spark, root, version)
    merged = merged_with(read_bucketed(spark, root, version), batch, record["keys"], record["version_col"])
    extra = {k: record[k] for k in ("keys", "version_col", "buckets")}
    return publish_version(merged, root, based_on=version, by=by, extra=extra,
                           write=_write_buckets(record["keys"], record["buckets"]))
