"""Shaping operators: typed casts, column order, dates, epochs, totals.

All are single projections or filters (narrow, no shuffle), written as one
``select`` rather than a loop of ``withColumn`` calls so the analyzed plan
stays small however many columns are touched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import (
    epoch_seconds_to_ntz,
    ntz_literal,
    ntz_to_epoch_seconds,
    number,
    parse_day_first_date,
    round_half_even,
    round_half_up,
    text_to_ntz,
    try_cast,
)


def cast_by_schema(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns by a column -> type map, keeping column order.

    ``try_cast``: text that does not fit the type becomes null instead of
    failing the job (ANSI mode on) or depending on the session (ANSI off).
    Columns missing from the frame are an error; unmapped ones pass through.
    """
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"cast_by_schema: no such columns {missing}")
    return df.select(
        *[try_cast(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def reorder_columns(df: DataFrame, desired: Sequence[str]) -> DataFrame:
    """``desired`` first, in that order, then every other column as it was."""
    rest = [c for c in df.columns if c not in set(desired)]
    return df.select(*[F.col(c) for c in desired], *[F.col(c) for c in rest])


def parse_dates(df: DataFrame, cols: Sequence[str], fmt: str = "dd-MM-yyyy") -> DataFrame:
    """Replace text columns by dates parsed with ``fmt``; bad text -> null."""
    targets = set(cols)
    return df.select(
        *[parse_day_first_date(c, fmt).alias(c) if c in targets else F.col(c) for c in df.columns]
    )


def stay_days(df: DataFrame, start: str, end: str, out: str = "admission_days") -> DataFrame:
    """Whole days from ``start`` to ``end`` (end - start) as int."""
    return df.withColumn(out, F.datediff(F.col(end), F.col(start)))


def round_column(df: DataFrame, col: str, scale: int = 2, half_even: bool = False) -> DataFrame:
    """Numeric rounding of a (text or numeric) column to ``scale`` decimals.

    Text is cast first; rounding is on decimal digits, HALF_UP by default.
    """
    fn = round_half_even if half_even else round_half_up
    return df.withColumn(col, fn(number(col), scale))


def format_amount(c: str | Column, scale: int = 2) -> Column:
    """Text form of a number: thousands separators, HALF_EVEN to ``scale``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.format_number(number(col), scale)


def epoch_to_timestamp(df: DataFrame, col: str = "time", out: str | None = None) -> DataFrame:
    """Epoch-second text -> ``timestamp_ntz`` (UTC wall clock)."""
    return df.withColumn(out or col, epoch_seconds_to_ntz(col))


def text_to_timestamp(
    df: DataFrame, col: str, fmt: str = "yyyy-MM-dd HH:mm:ss", out: str | None = None
) -> DataFrame:
    """Formatted timestamp text -> ``timestamp_ntz``; bad text -> null."""
    return df.withColumn(out or col, text_to_ntz(col, fmt))


def time_range(
    df: DataFrame, col: str, lo: str, hi: str, day_col: str | None = None
) -> DataFrame:
    """Rows with ``lo <= col <= hi`` (inclusive); bounds are timestamp text.

    Bounds become typed ``timestamp_ntz`` literals, so the comparison is
    between timestamps (not text) and needs no session time zone.

    ``day_col`` names a plain date column the input is laid out by (a
    ``date=...`` partition directory or a sorted date column). The window's
    days are then also required of it: a predicate on a source column, which
    Spark turns into partition pruning or row-group skipping, whereas the
    timestamp itself is usually derived (parsed from text) and cannot prune.
    """
    out = df.where(F.col(col).between(ntz_literal(lo), ntz_literal(hi)))
    return out if day_col is None else day_prune(out, day_col, lo, hi)


def in_windows(
    df: DataFrame, windows: DataFrame, time_col: str, day_col: str, lo: str = "lo", hi: str = "hi"
) -> DataFrame:
    """Rows of ``df`` whose ``time_col`` lies in any of the ``windows``
    (a parameter table with inclusive timestamp bounds ``lo`` and ``hi``).

    ``day_col`` is the date column that ``df`` is laid out by. The windows
    are spread over the days they touch and joined on the day, so Spark reads
    the small table first and then only its days' directories (dynamic
    partition pruning), and a row is compared with the windows of its day
    only. Windows that overlap return a row once. Bounds that are null or the
    wrong way round hold nothing.

    The table of windows is broadcast only where Spark finds it small enough
    (``spark.sql.autoBroadcastJoinThreshold``); pruning needs that.
    """
    days = (
        windows.where(F.col(lo) <= F.col(hi))
        .select(
            F.col(lo).alias("__lo"), F.col(hi).alias("__hi"),
            F.explode(F.sequence(F.to_date(lo), F.to_date(hi))).alias("__day"),
        )
    )
    inside = (F.col(day_col) == F.col("__day")) & F.col(time_col).between(F.col("__lo"), F.col("__hi"))
    return df.join(days, inside, "left_semi")


def epoch_range(df: DataFrame, col: str, lo: str, hi: str) -> DataFrame:
    """Rows whose epoch seconds lie in ``[lo, hi]`` (timestamp text, UTC).

    Decided on the raw column, before any time is built from it: one integer
    comparison a row, and a predicate a scan can push down where the column
    is stored as a number.
    """
    first, last = (ntz_to_epoch_seconds(ntz_literal(t)) for t in (lo, hi))
    return df.where(F.col(col).try_cast("bigint").between(first, last))


def day_prune(df: DataFrame, day_col: str, lo: str, hi: str) -> DataFrame:
    """Keep rows whose ``day_col`` date lies in the days of ``[lo, hi]``.

    A predicate on a plain (partition or sorted) date column, so the scan
    skips whole directories or row groups.
    """
    first, last = F.lit(lo[:10]).cast("date"), F.lit(hi[:10]).cast("date")
    return df.where(F.col(day_col).between(first, last))


def add_totals(
    df: DataFrame,
    totals: Mapping[str, Sequence[str]],
    drop_parts: bool = True,
) -> DataFrame:
    """Add ``out = part1 + part2 + ...`` per entry; optionally drop parts.

    Plain ``+``: a null part makes the total null, as in the source job.
    """
    added = df.withColumns(
        {out: reduce(lambda a, b: a + b, [F.col(p) for p in parts]) for out, parts in totals.items()}
    )
    if not drop_parts:
        return added
    parts = {p for ps in totals.values() for p in ps}
    return added.drop(*[p for p in parts if p not in totals])


def replace_with_sum(df: DataFrame, out: str, parts: Sequence[str]) -> DataFrame:
    """Overwrite (or add) ``out`` with the left-to-right sum of ``parts``."""
    return df.withColumn(out, reduce(lambda a, b: a + b, [F.col(p) for p in parts]))
