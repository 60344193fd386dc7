"""Batch stamps and row keys."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import content_key

# Format and length of a batch id.
BATCH_ID_FORMAT = "%Y%m%d%H%M%S%f"
BATCH_ID_DIGITS = 17  # to the millisecond


def new_batch_id(now: datetime | None = None) -> str:
    """17-digit batch id ``yyyyMMddHHmmssSSS`` from the driver clock."""
    now = now or datetime.now()
    return now.strftime(BATCH_ID_FORMAT)[:BATCH_ID_DIGITS]


def batch_date_of(batch_id: str | int) -> date:
    """The calendar day encoded in a batch id's first eight digits."""
    return datetime.strptime(str(batch_id)[:8], "%Y%m%d").date()


def batch_stamp(
    df: DataFrame,
    batch_id: str | int,
    id_col: str = "etl_batch_id",
    date_col: str = "etl_batch_date",
) -> DataFrame:
    """Add the batch id (bigint) and the batch date derived from it.

    The id is a job argument, so re-running a batch reproduces it, and id
    and date can never disagree across midnight. Both are literals that
    Catalyst folds into the projection.
    """
    batch_id = str(batch_id)
    if not batch_id.isdigit():
        raise ValueError(f"batch id must be digits, got {batch_id!r}")
    return df.withColumns(
        {
            id_col: F.lit(int(batch_id)).cast("bigint"),
            date_col: F.lit(batch_date_of(batch_id)),
        }
    )


def row_key(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    out: str = "row_key",
) -> DataFrame:
    """Add a deterministic content key (md5 of the row's text).

    Recomputing the frame (a second action, a lost executor) gives the same
    keys, unlike a random UUID, so two sinks fed from one frame agree.
    """
    cols = list(cols) if cols is not None else df.columns
    return df.withColumn(out, content_key(cols))


def random_row_id(df: DataFrame, out: str = "uuid") -> DataFrame:
    """Add a random UUID per row (the built-in nondeterministic ``uuid()``).

    Write the frame once and read the written table for further sinks; a
    recomputation draws new ids.
    """
    return df.withColumn(out, F.expr("uuid()"))
