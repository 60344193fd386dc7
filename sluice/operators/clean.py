"""Cleaning operators: sentinel rejection and blanking, blank rows, dedup.

Each is one narrow projection or filter, except ``dedup_rows`` and
``stage_row_counts`` which need one hash aggregation. Spark combines
duplicates map-side before the shuffle, so a single row repeated across a
third of the input reaches the reducer as at most one copy per map task.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sluice.functions.columns import (
    BLANK_SENTINELS,
    REJECT_SENTINELS,
    blanked,
    ident,
    sentinel_free_sql,
    sql_text,
)


def _string_columns(df: DataFrame, cols: Sequence[str] | None) -> list[str]:
    if cols is not None:
        return list(cols)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def sentinel_free(cols: Iterable[str], values: Iterable[str] = REJECT_SENTINELS) -> Column:
    """Row predicate: no column is null or equal to a sentinel."""
    return F.expr(sentinel_free_sql(cols, values))


def reject_sentinel_rows(
    df: DataFrame,
    values: Iterable[str] = REJECT_SENTINELS,
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """Drop every row where any column is null or equals a sentinel.

    One conjunctive ``Filter`` (instead of one filter per column and value),
    which Catalyst pushes into the scan when the columns come from a file.
    """
    cols = list(cols) if cols is not None else df.columns
    return df.where(sentinel_free(cols, values))


def rejected_sentinel_rows(
    df: DataFrame,
    values: Iterable[str] = REJECT_SENTINELS,
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """The complement of ``reject_sentinel_rows`` (the rows it drops)."""
    cols = list(cols) if cols is not None else df.columns
    return df.where(~F.coalesce(sentinel_free(cols, values), F.lit(False)))


def blank_sentinels(
    df: DataFrame,
    values: Iterable[str] = BLANK_SENTINELS,
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """Replace sentinel text by null in the string columns (or ``cols``).

    Exact, case-sensitive match, no trimming. One projection for all
    columns; the column order is kept.
    """
    targets = set(_string_columns(df, cols))
    values = list(values)
    return df.select(
        *[blanked(c, values).alias(c) if c in targets else F.col(c) for c in df.columns]
    )


def drop_blank_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every column of ``subset`` is null.

    Pass the source columns as ``subset``: stamped columns (batch id, row
    key) are never null and would keep every row.
    """
    return df.dropna(how="all", subset=list(subset) if subset is not None else None)


def dedup_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Remove exact duplicate rows (over all columns, or over ``subset``).

    Over all columns this is ``distinct``: a partial hash aggregate per map
    task, one shuffle on the row, a final aggregate. Dedup before adding
    row ids or batch stamps, else every row is unique. With a strict
    ``subset`` the kept representative of a group is arbitrary, as in
    ``dropDuplicates``.
    """
    if subset is None or set(subset) >= set(df.columns):
        return df.distinct()
    return df.dropDuplicates(list(subset))


def stage_row_counts(
    df: DataFrame,
    values: Iterable[str] = BLANK_SENTINELS,
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """Row counts after each cleaning stage, in one shuffle.

    Output (one row): ``input_rows`` (as read), ``rows_with_sentinel`` (rows
    holding a sentinel in any column), ``distinct_rows`` (after blanking and
    dedup) and ``clean_rows`` (also dropping all-blank rows). The rows are
    grouped once, by a 128-bit hash of their cells, so the shuffle is narrow
    however wide the table; the final figures are sums over the groups.
    """
    cols = list(cols) if cols is not None else df.columns
    values = list(values)
    listed = ", ".join(sql_text(v) for v in values)
    any_sentinel = " OR ".join(f"coalesce({ident(c)} IN ({listed}), false)" for c in cols)
    flagged = df.select(
        *[blanked(c, values).alias(c) for c in cols],
        F.expr(f"CAST(({any_sentinel}) AS INT)").alias("_has_sentinel"),
    )
    # Hashing skips nulls, so what is null goes in beside the values.
    cells = ", ".join(f"{ident(c)}, isnull({ident(c)})" for c in cols)
    all_blank = " AND ".join(f"isnull({ident(c)})" for c in cols)
    hashed = flagged.selectExpr(
        f"xxhash64({cells}) AS _h1", f"xxhash64(7, {cells}) AS _h2", "_has_sentinel", f"({all_blank}) AS _blank"
    )
    groups = hashed.groupBy("_h1", "_h2").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_has_sentinel").alias("_s"), F.max("_blank").alias("_blank")
    )
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("input_rows"),
        F.coalesce(F.sum("_s"), F.lit(0)).cast("bigint").alias("rows_with_sentinel"),
        F.count(F.lit(1)).cast("bigint").alias("distinct_rows"),
        F.count_if(~F.col("_blank")).cast("bigint").alias("clean_rows"),
    )


Trace = dict[str, Observation]


def traced(df: DataFrame, label: str, trace: Trace | None) -> DataFrame:
    """Count the rows passing this point, as a side effect of the next action.

    The count is collected by the job that runs anyway (``observe``), not by
    an extra action per step. ``trace`` maps labels to observations; read
    the numbers with ``trace_counts`` after the action.
    """
    if trace is None:
        return df
    observation = Observation(label)
    trace[label] = observation
    return df.observe(observation, F.count(F.lit(1)).alias("rows"))


def trace_counts(trace: Trace) -> dict[str, int]:
    """Row counts of a finished trace, in the order the steps were added."""
    return {label: obs.get["rows"] for label, obs in trace.items()}
