"""Aggregates and derived metrics.

Whole-table statistics are attached to rows through a *scalar subquery*: a
one-row aggregate (partial aggregation per task, then a single row per task
to a final merge) that Spark runs once and injects as a literal into the
row projection. That replaces both the driver round trip (``collect()``
then ``lit``) and the un-partitioned window ``over ()``, which would move
the whole table into one task. What reaches the tasks is that one row,
embedded in their projection, so its size is bounded however large the
input.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from sluice.functions.columns import (
    ntz_literal,
    number,
    round_binary_half_even,
    round_half_even,
    round_half_up,
)
from sluice.plans.schemas import RISK_CONDITION, RISK_WEIGHTS

_AGGS = {
    "max": F.max,
    "min": F.min,
    "avg": F.avg,
    "sum": F.sum,
    "count": F.count,
    "stddev": F.stddev_samp,
}


def global_stats(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """One-row aggregate ``{alias: aggregate expression}`` over ``df``."""
    return df.agg(*[e.alias(name) for name, e in exprs.items()])


STATS_COLUMN = "__stats"


def with_scalar_stats(df: DataFrame, exprs: Mapping[str, Column], of: DataFrame | None = None) -> DataFrame:
    """Attach the aggregates of ``global_stats`` to every row of ``df``.

    They are taken over ``of`` where it is given, else over ``df`` itself.

    One scalar subquery computes all of them as a struct; it is attached as
    a single column before the fields are read, so Spark plans the
    subquery once (reading a field of the subquery expression in several
    places would plan one subquery per place). The struct column is
    dropped again.
    """
    packed = (df if of is None else of).select(F.struct(*[e.alias(n) for n, e in exprs.items()]).alias("s")).scalar()
    staged = df.withColumn(STATS_COLUMN, packed)
    fields = {name: F.col(STATS_COLUMN).getField(name) for name in exprs}
    return staged.withColumns(fields).drop(STATS_COLUMN)


def with_global_stats(
    df: DataFrame,
    value_col: str,
    stats: Mapping[str, str],
) -> DataFrame:
    """Attach whole-table statistics of ``value_col`` to every row.

    ``stats`` maps output column -> aggregate name (max, min, avg, sum,
    count, stddev). Non-finite values take no part.
    """
    value = number(value_col)
    return with_scalar_stats(df, {out: _AGGS[fn](value) for out, fn in stats.items()})


def risk_score(
    df: DataFrame,
    age: str,
    condition: str,
    billing: str,
    out: str = "risk_score",
    max_age: Column | float | None = None,
    max_billing: Column | float | None = None,
    text_maxima: bool | Collection[str] = False,
    round_billing_first: bool = True,
    scale: int = 2,
    half_even: bool = False,
    rounding: str | None = None,
) -> DataFrame:
    """``0.4*age/max_age + 0.3*[condition] + 0.3*billing/max_billing``.

    Maxima default to the typed maxima of ``df`` itself (one scalar
    subquery). ``text_maxima=True`` takes the maxima of the *text* columns
    (lexicographic: '99' beats '100'), as the final admissions job did;
    ``text_maxima={"age"}`` only that of the ages, as the scheduled one did.
    Text that is no finite number is no maximum. A null input or a zero
    maximum gives a null score.

    ``rounding`` (of the billing amounts and of the score): ``"half_up"``
    (default) or ``"half_even"`` on decimal digits, or ``"binary"``: Python's
    ``round`` on the double, which reproduces a row-at-a-time Python
    implementation of the score bit for bit. ``half_even=True`` is
    ``rounding="half_even"``.
    """
    w_age, w_cond, w_bill = RISK_WEIGHTS
    age_d, bill_d = number(age), number(billing)
    as_text = {"age", "billing"} if text_maxima is True else set(text_maxima or ())
    if as_text - {"age", "billing"}:
        raise ValueError(f"text_maxima: 'age' and 'billing' can be named, not {sorted(as_text)}")

    def largest(column: str, value: Column, name: str) -> Column:
        return F.max(F.when(value.isNotNull(), F.col(column).cast("string")) if name in as_text else value)

    # Maxima not given are computed over ``df`` in one scalar subquery and
    # attached as temporary columns.
    candidates = {"__max_age": largest(age, age_d, "age"), "__max_billing": largest(billing, bill_d, "billing")}
    given = {"__max_age": max_age, "__max_billing": max_billing}
    computed = {name: e for name, e in candidates.items() if given[name] is None}
    if computed:
        df = with_scalar_stats(df, computed)

    def maximum(name: str) -> Column:
        value = given[name]
        col = F.col(name) if value is None else value if isinstance(value, Column) else F.lit(value)
        return col.try_cast("double")

    ma, mb = maximum("__max_age"), maximum("__max_billing")
    rounding = rounding or ("half_even" if half_even else "half_up")
    rounder = {
        "half_up": round_half_up,
        "half_even": round_half_even,
        "binary": round_binary_half_even,
    }[rounding]
    if round_billing_first:
        pre = round_half_up if rounding != "binary" else round_binary_half_even
        bill_d, mb = pre(bill_d, 2), pre(mb, 2)
    flag = F.when(F.col(condition) == RISK_CONDITION, 1).otherwise(0)
    score = (
        F.try_divide(age_d, ma) * F.lit(w_age)
        + flag * F.lit(w_cond)
        + F.try_divide(bill_d, mb) * F.lit(w_bill)
    )
    return df.withColumn(out, rounder(score, scale)).drop(*computed)


def top_k_counts(df: DataFrame, key: str, k: int = 10, count_col: str = "count") -> DataFrame:
    """The ``k`` most frequent values of ``key`` with their counts.

    Ties are broken by the key so the result is a total order. The plan is
    a partial/final hash aggregate and a ``TakeOrderedAndProject`` (each
    task keeps its own top k), never a global sort.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_col))
    return counts.orderBy(F.col(count_col).desc(), F.col(key).asc_nulls_last()).limit(k)


def daily_totals(
    df: DataFrame,
    ts_col: str,
    value_col: str,
    day_col: str = "day",
    total_col: str = "total",
) -> DataFrame:
    """Sum of ``value_col`` per calendar day of ``ts_col``, as a double.

    One row per day, and one for readings without a time: the result grows
    with the calendar span, not with the number of readings.
    """
    return df.groupBy(F.to_date(F.col(ts_col)).alias(day_col)).agg(F.sum(number(value_col)).alias(total_col))


def day_over_day_delta(df: DataFrame, ts_col: str, value_col: str) -> DataFrame:
    """Daily totals and the change from the previous calendar day.

    ``delta = total(day) - total(day - 1)``: positive when the later day used
    more (the source subtracts the later day from the earlier one). It is
    null when the day before has no readings. The totals are joined with
    themselves on the day before; pass a staged or plain table, over which
    both sides of the join are one narrow scan each.
    """
    days = daily_totals(df, ts_col, value_col)
    before = days.select(F.date_add("day", 1).alias("day"), F.col("total").alias("_before"))
    return days.join(before, "day", "left").select("day", "total", (F.col("total") - F.col("_before")).alias("delta"))


def _day_bounds(day: str) -> tuple[Column, Column]:
    lo = ntz_literal(f"{day} 00:00:00")
    return lo, F.timestamp_add("DAY", F.lit(1), lo)


def day_extremes(
    df: DataFrame,
    ts_col: str,
    value_col: str,
    day: str,
) -> DataFrame:
    """Max, min and total of ``value_col`` over one calendar day (one row).

    The day is a half-open timestamp range (a predicate a file scan can
    push down), not ``to_date(ts) = day``.
    """
    lo, hi = _day_bounds(day)
    ts = F.col(ts_col)
    return (
        df.where((ts >= lo) & (ts < hi))
        .agg(
            F.max(value_col).alias("max_total_overall"),
            F.min(value_col).alias("min_total_overall"),
            F.sum(number(value_col)).alias("sum_total_overall"),
        )
        .select(F.lit(day).cast("date").alias("day"), "*")
    )


def with_day_extremes(
    df: DataFrame,
    ts_col: str,
    value_col: str,
    day: str,
    prefix: str = "total_overall_day",
) -> DataFrame:
    """Attach one day's max and min of ``value_col`` to every row.

    The day's figures come from a single scalar subquery whose scan the
    day's timestamp range is pushed to; the rows themselves are not filtered.
    """
    lo, hi = _day_bounds(day)
    ts = F.col(ts_col)
    exprs = {f"max_{prefix}": F.max(value_col), f"min_{prefix}": F.min(value_col)}
    return with_scalar_stats(df, exprs, of=df.where((ts >= lo) & (ts < hi)))


def argmax_column(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Which of ``fields`` holds the largest value, and that value.

    One pass computes every column's maximum (a one-row aggregate); the row
    is then unpivoted to (field, value) and the top one kept, ties going to
    the first field name.
    """
    maxima = df.agg(*[F.max(number(f)).alias(f) for f in fields])
    long = maxima.unpivot([], list(fields), "field", "value")
    return (
        long.where(F.col("value").isNotNull())
        .orderBy(F.col("value").desc(), F.col("field").asc())
        .limit(1)
    )


def describable(df: DataFrame) -> list[str]:
    """The columns ``describe`` covers: numbers and text, in order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (NumericType, StringType))]


def describe_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count / mean / stddev / min / max per column, one row per column.

    ``cols`` defaults to every number and text column. A single aggregation
    pass computes all statistics of all columns (``describe`` semantics,
    sample standard deviation); only the one-row result is reshaped. Text
    has a count, ``min_text`` and ``max_text``; numbers have ``min`` and
    ``max``. What does not apply is null. Non-finite numbers are left out.
    """
    cols = describable(df) if cols is None else list(cols)
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    none = {"double": F.lit(None).cast("double"), "string": F.lit(None).cast("string")}
    aggs, rows = [], []
    for i, c in enumerate(cols):
        v = F.col(c) if c in text else number(c)
        aggs += [F.count(v).alias(f"c{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}")]
        if c not in text:
            aggs += [F.avg(v).alias(f"m{i}"), F.stddev_samp(v).alias(f"s{i}")]
        low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        rows.append(F.struct(
            F.lit(c).alias("column"),
            F.col(f"c{i}").alias("count"),
            (none["double"] if c in text else F.col(f"m{i}")).alias("mean"),
            (none["double"] if c in text else F.col(f"s{i}")).alias("stddev"),
            (none["double"] if c in text else low).alias("min"),
            (none["double"] if c in text else high).alias("max"),
            (low if c in text else none["string"]).alias("min_text"),
            (high if c in text else none["string"]).alias("max_text"),
        ))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
