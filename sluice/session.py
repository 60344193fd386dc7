"""Session and scratch-space helpers.

Library code never changes session settings. ``build_session`` is for tests,
``bench.py`` and command-line use; on a cluster the caller's session is used
as it is.
"""

from __future__ import annotations

import os
import uuid
import warnings

from pyspark.sql import SparkSession


#: Bytecodes of a method over which HotSpot does not compile it (fixed value).
HOTSPOT_METHOD_LIMIT = 8000


def build_session(
    master: str | None = None,
    app_name: str = "sluice",
    shuffle_partitions: int | None = None,
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with settings suited to these jobs.

    AQE stays on so partition counts are coalesced and skewed shuffle
    partitions are split at run time; the session zone is pinned to UTC so
    timestamps compare equal across engines.
    """
    master = master or os.environ.get("SLUICE_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # HotSpot does not JIT-compile methods over 8000 bytecodes; a fused
        # 30-column cleaning stage generates one, which then runs
        # interpreted. At this limit Spark splits such a stage into
        # per-operator code instead (3.6x faster on the smart-home cleaning).
        .config("spark.sql.codegen.hugeMethodLimit", str(HOTSPOT_METHOD_LIMIT))
        .config("spark.driver.memory", driver_memory)
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions expose no SparkContext
        return None


def sizing_for(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition settings for an input of ``input_bytes``.

    Scan splits and shuffle partitions of about ``partition_bytes`` each, so
    every task's share fits executor memory with room to sort and spill.
    AQE may merge shuffle partitions that come out small but never splits a
    hash partition, so the initial count is set for the full input: for
    100 TB at 256 MB that is 409,600 partitions.
    """
    parts = max(1, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
    }


def warn_of_interpreted_stages(spark: SparkSession) -> bool:
    """Warn if fused stages may exceed what HotSpot compiles (and return that).

    Over ``spark.sql.codegen.hugeMethodLimit`` Spark runs a stage operator by
    operator; a limit above 8000 bytecodes leaves a fused 30-column stage to
    the interpreter.
    """
    limit = int(spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535"))
    if limit > HOTSPOT_METHOD_LIMIT:
        warnings.warn(
            f"spark.sql.codegen.hugeMethodLimit is {limit}: set it to {HOTSPOT_METHOD_LIMIT}, or the wide "
            "cleaning stage runs interpreted, several times slower",
            stacklevel=3,
        )
    return limit > HOTSPOT_METHOD_LIMIT


def checkpoint_root(spark: SparkSession) -> str:
    """The folder for staged tables: ``spark.checkpoint.dir``, else the
    context's checkpoint folder, else a folder of the SQL warehouse.

    A cluster names shared storage in the setting; the warehouse, which
    every executor reaches as well, serves where nothing is set. Settings
    are read, never changed.
    """
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    named = spark.conf.get("spark.checkpoint.dir", None) or current
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints").rstrip("/")


def delete_path(spark: SparkSession, path: str, at_exit: bool = False) -> None:
    """Delete a folder of any file system Spark can write to, now or when the
    session's file system client closes."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if at_exit:
        fs.deleteOnExit(target)
    else:
        fs.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder for written tables.

    Written tables cut lineage the same way ``checkpoint()`` does and
    survive executor loss, because they live in the shared folder. What is
    written there goes when the session ends.
    """
    path = f"{checkpoint_root(spark)}/sluice-scratch/{name}-{uuid.uuid4().hex}"
    if _context(spark) is not None:
        delete_path(spark, path, at_exit=True)
    return path
