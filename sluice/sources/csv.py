"""Header CSV sources read as text."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sluice.functions.columns import ident

# Every CSV reader and writer of the package uses these: values keep their
# outer blanks, quotes inside a quoted value are doubled, and a header that
# does not carry the expected names in order is an error, not a relabelling.
CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
READ_OPTIONS = {**CSV_OPTIONS, "enforceSchema": False}


def text_schema(columns: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_text_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    sep: str = ",",
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Header CSV with every column as text.

    ``multi_line=True`` accepts quoted values that contain line breaks, at
    a price: each file is then read whole by one task (no splitting), so
    keep it off for large inputs whose values are single-line.

    With ``columns`` given the reader skips schema inference altogether (one
    pass, splittable), which is what a large input wants; each file's header
    must name these columns in this order, else the read fails. Without it
    only the header line is read to name the columns, never the data
    (``inferSchema`` stays off).
    """
    reader = (
        spark.read.options(**READ_OPTIONS)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
    )
    if columns is not None:
        return reader.schema(text_schema(columns)).csv(path)
    return reader.option("inferSchema", False).csv(path)


# --- lines that do not fit the header ----------------------------------------

MISFIT_COLUMN = "_misfit_line"


def read_checked_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    sep: str = ",",
    encoding: str = "UTF-8",
    misfit_col: str = MISFIT_COLUMN,
) -> DataFrame:
    """Header CSV as text with ``misfit_col``: the raw line where its number
    of fields is not the header's, else null.

    The plain reader cuts a longer line and fills a shorter one, so cells get
    lost or shift without a trace; here such a line keeps all of its text.
    ``fitting_rows`` and ``misfit_lines`` part the two kinds. Every column is
    parsed whatever is selected later (pruning would hide misfits). Empty
    lines are no rows.
    """
    rows = (
        spark.read.options(**READ_OPTIONS)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", misfit_col)
        .option("columnPruning", False)
        .schema(text_schema([*columns, misfit_col]))
        .csv(path)
    )
    # The line is kept with nothing of the first column, so that no query
    # needs the reader's own column alone, which Spark refuses.
    line = F.concat(ident(misfit_col), F.left(F.coalesce(ident(columns[0]), F.lit("")), F.lit(0)))
    return rows.withColumn(misfit_col, line)


def fitting_rows(checked: DataFrame, misfit_col: str = MISFIT_COLUMN) -> DataFrame:
    """The rows of ``read_checked_csv`` that fit the header."""
    return checked.where(F.col(misfit_col).isNull()).drop(misfit_col)


def misfit_lines(checked: DataFrame, sep: str = ",", misfit_col: str = MISFIT_COLUMN) -> DataFrame:
    """The lines that do not: ``file``, ``line``, ``n_fields`` and ``reason``
    (``unclosed quote``, ``short`` or ``long``).

    Fields are counted outside of quotes; a line with an unclosed quote has
    no telling number of fields (null).
    """
    line = F.col("line")
    n_columns = len(checked.columns) - 1
    unclosed = (F.char_length(line) - F.char_length(F.replace(line, F.lit('"'), F.lit("")))) % 2 == 1
    bare = F.regexp_replace(line, '"[^"]*"', "")
    n_fields = F.when(~unclosed, F.size(F.split(bare, re.escape(sep), -1)))
    return (
        checked.where(F.col(misfit_col).isNotNull())
        .select(F.col("_metadata.file_path").alias("file"), F.col(misfit_col).alias("line"))
        .withColumn("n_fields", n_fields)
        .withColumn(
            "reason",
            F.when(unclosed, "unclosed quote").when(F.col("n_fields") < n_columns, "short").otherwise("long"),
        )
    )


# --- files whose headers differ ----------------------------------------------

def file_headers(
    spark: SparkSession, path: str | list[str], sep: str = ",", encoding: str = "UTF-8", threads: int = 32
) -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` by their header line.

    One small read per file through Spark's own file system client (any store
    that Spark reads, compressed files too), so the cost is that of listing,
    whatever the files' sizes. Files without a line are left out.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(uri: str) -> tuple[str, str | None]:
        file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(uri))
        stream = file.getFileSystem(conf).open(file)
        try:
            codec = codecs.getCodec(file)
            source = stream if codec is None else codec.createInputStream(stream)
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, encoding))
            return file.toString(), reader.readLine()
        finally:
            stream.close()

    found: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(threads) as pool:
        for file, line in pool.map(first_line, sorted(spark.read.text(path).inputFiles())):
            if line is not None:
                names = next(csv.reader([line.removeprefix("\ufeff")], delimiter=sep), [])
                found.setdefault(tuple(names), []).append(file)
    return found


def read_csv_by_name(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] | None = None,
    required: Sequence[str] = (),
    sep: str = ",",
    encoding: str = "UTF-8",
    misfit_col: str | None = None,
) -> DataFrame:
    """Header CSV files whose headers may differ, as text, matched by name.

    Each file is read under its own header: columns may come in another
    order, be missing (null in that file's rows) or be new. ``columns``
    chooses and orders the result's columns; by default they are all that
    occur, sorted headers' columns first seen first. A file that lacks a
    ``required`` column, or that names one twice, fails the read.
    ``misfit_col``: also keep lines that do not fit their file's header, as
    ``read_checked_csv`` does.

    One reader per distinct header, not per file.
    """
    headers = file_headers(spark, path, sep, encoding)
    for names, files in headers.items():
        lacking = [c for c in required if c not in names]
        if lacking or len(set(names)) < len(names):
            raise ValueError(f"header of {files[0]} lacks {lacking} or repeats a name: {list(names)}")
    wanted = list(columns) if columns is not None else list(dict.fromkeys(c for names in sorted(headers) for c in names))
    last = [] if misfit_col is None else [misfit_col]
    out = spark.createDataFrame([], text_schema([*wanted, *last]))
    for names, files in sorted(headers.items()):
        if misfit_col is None:
            part = read_text_csv(spark, files, names, sep, encoding)
        else:
            part = read_checked_csv(spark, files, names, sep, encoding, misfit_col)
        kept = [ident(c) for c in [*wanted, *last] if c in {*names, *last}]
        out = out.unionByName(part.selectExpr(*kept), allowMissingColumns=True)
    return out
