"""Shared-storage staging and small column helpers of the operators.

``stage`` cuts lineage with a Parquet table in the folder the cluster shares,
so a lost executor costs a re-read, not a recomputation.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ASCII_SPACE = " \t\n\x0b\x0c\r"  # [\x20\x09-\x0D]
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; if it is unset, a folder of the SQL warehouse,
    which every executor of a cluster reaches as well."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints").rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    The table lives until ``free``, or as long as the session: it is deleted
    when the driver's file system client closes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def free(*staged: DataFrame) -> None:
    """Delete tables of ``stage`` whose readers have all been staged themselves."""
    for df in staged:
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def col(name: str) -> Column:
    """A top-level column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_schema(packed: DataFrame, results: str) -> T.StructType:
    """The struct column ``row`` of ``packed`` and then the result columns."""
    return T.StructType([packed.schema["row"], *T.StructType.fromDDL(results).fields])


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character kept (``lower`` would also fold É)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())
    )


def hash128(text: Column) -> tuple[Column, Column]:
    """Two independently seeded 64-bit hashes: no collisions at corpus size."""
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)
