"""Smart-home power job: clean readings, derive totals, whole-table stats.

Flow: epoch text -> timestamp -> optional time window -> blank sentinels ->
dedup -> drop all-blank rows -> row key + batch stamp -> typed casts ->
circuit totals (parts dropped) -> recomputed house total -> max / min /
average house total attached to every row -> output order.

The whole-table statistics come from one scalar subquery (a one-row
aggregate) rather than an un-partitioned window, so no stage ever holds the
whole table in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from sluice.functions.columns import (
    BLANK_SENTINELS_SMART_HOME,
    content_key,
    epoch_seconds_to_ntz,
    unless_sentinel,
)
from sluice.operators.clean import Trace, blank_sentinels, dedup_rows, drop_blank_rows, traced
from sluice.operators.shape import (
    add_totals,
    cast_by_schema,
    day_prune,
    epoch_range,
    epoch_to_timestamp,
    reorder_columns,
    replace_with_sum,
)
from sluice.operators.stamp import batch_stamp, row_key
from sluice.operators.stats import with_global_stats
from sluice.sinks.files import stage
from sluice.plans.schemas import (
    HOUSE_OVERALL_PARTS,
    SMART_HOME_OUTPUT,
    SMART_HOME_SOURCE,
    SMART_HOME_TOTALS,
    SMART_HOME_TYPES,
    resolve,
)

# The global statistics attached to each row.
POWER_STATS = {"max_power": "max", "min_power": "min", "avg_power": "avg"}


def _n(names: Mapping[str, str] | None):
    return lambda c: resolve(names, c)


def smart_home_timed(
    raw: DataFrame,
    names: Mapping[str, str] | None = None,
    window: tuple[str, str] | None = None,
    day_col: str | None = None,
) -> DataFrame:
    """Source columns with ``time`` as ``timestamp_ntz``, optionally windowed.

    The window is decided on the raw epoch seconds. With ``day_col`` (a date
    column the input files are laid out by) it also prunes files before any
    text is parsed.
    """
    n = _n(names)
    if window is not None:
        raw = epoch_range(raw, n("time"), *window)
        raw = raw if day_col is None else day_prune(raw, day_col, *window)
    return epoch_to_timestamp(raw.select(*[n(c) for c in SMART_HOME_SOURCE]), n("time"))


def smart_home_clean(
    raw: DataFrame,
    names: Mapping[str, str] | None = None,
    window: tuple[str, str] | None = None,
    sentinels=BLANK_SENTINELS_SMART_HOME,
    day_col: str | None = None,
    trace: Trace | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Timed readings with sentinels blanked, duplicates and blank rows gone.

    ``distinct=False`` leaves duplicates in, and the shuffle out: for maxima
    and minima, which they don't change.
    ``trace`` (a dict) collects row counts after the window, dedup and the
    blank-row drop, as a side effect of the job's own run.
    """
    n = _n(names)
    src = [n(c) for c in SMART_HOME_SOURCE]
    df = traced(smart_home_timed(raw, names, window, day_col), "in_window", trace)
    df = blank_sentinels(df, sentinels)
    df = traced(dedup_rows(df) if distinct else df, "distinct", trace)
    return traced(drop_blank_rows(df, src), "clean", trace)


def smart_home_keyed(
    raw: DataFrame,
    names: Mapping[str, str] | None = None,
    window: tuple[str, str] | None = None,
    sentinels=BLANK_SENTINELS_SMART_HOME,
) -> DataFrame:
    """Readings as read, with the row key of their cleaned form: all that a
    stream needs to drop what it has seen (``smart_home_first_seen`` then
    cleans the rest)."""
    n = _n(names)
    src = [n(c) for c in SMART_HOME_SOURCE]
    if window is not None:
        raw = epoch_range(raw, n("time"), *window)
    cells = [epoch_seconds_to_ntz(c) if c == n("time") else unless_sentinel(c, sentinels) for c in src]
    return raw.select(*src).withColumn(n("row_key"), content_key(cells))


def smart_home_first_seen(
    keyed: DataFrame, names: Mapping[str, str] | None = None, sentinels=BLANK_SENTINELS_SMART_HOME
) -> DataFrame:
    """Distinct rows of ``smart_home_keyed``, cleaned."""
    n = _n(names)
    src = [n(c) for c in SMART_HOME_SOURCE]
    timed = epoch_to_timestamp(keyed, n("time"))
    return drop_blank_rows(blank_sentinels(timed, sentinels, [c for c in src if c != n("time")]), src)


def smart_home_rows(
    keyed: DataFrame, batch_id: str | int, names: Mapping[str, str] | None = None, types: Mapping[str, str] | None = None
) -> DataFrame:
    """Keyed distinct readings, stamped and typed, with their totals: all of
    the flow but the whole-table statistics."""
    n = _n(names)
    df = batch_stamp(keyed, batch_id, n("etl_batch_id"), n("etl_batch_date"))
    return smart_home_totals(smart_home_typed(df, names, types), names)


def smart_home_typed(
    df: DataFrame,
    names: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """Readings cast by the type map (bad numbers -> null); ``types``
    overrides entries (logical name -> type)."""
    n = _n(names)
    type_map = {**SMART_HOME_TYPES, **(types or {})}
    return cast_by_schema(df, {n(c): t for c, t in type_map.items()})


def smart_home_totals(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Circuit totals replace their parts; the house total is recomputed."""
    n = _n(names)
    totals = {n(out): [n(p) for p in parts] for out, parts in SMART_HOME_TOTALS.items()}
    df = add_totals(df, totals, drop_parts=True)
    return replace_with_sum(df, n("house_overall"), [n(p) for p in HOUSE_OVERALL_PARTS])


def with_power_stats(df: DataFrame, names: Mapping[str, str] | None = None) -> DataFrame:
    """Attach max / min / average of the house total to every row."""
    n = _n(names)
    stats = {n(out): fn for out, fn in POWER_STATS.items()}
    return with_global_stats(df, n("house_overall"), stats)


def smart_home_etl(
    raw: DataFrame,
    batch_id: str | int,
    names: Mapping[str, str] | None = None,
    window: tuple[str, str] | None = None,
    staged: bool | str = True,
    day_col: str | None = None,
    trace: Trace | None = None,
    types: Mapping[str, str] | None = None,
    sentinels=BLANK_SENTINELS_SMART_HOME,
) -> DataFrame:
    """The whole flow; 33 output columns (``SMART_HOME_OUTPUT``).

    ``staged``: write the cleaned, typed rows once (to this path, or to the
    checkpoint folder when ``True``) and take the statistics and the output
    rows from the written table. The average needs the deduplicated rows,
    so without a stage the statistics subquery would repeat the scan and
    the dedup shuffle. ``day_col``: a date column the input is laid out by;
    with a ``window`` it prunes files before any text is parsed.
    """
    n = _n(names)
    df = smart_home_prepared(raw, batch_id, names, window, day_col, trace, types, sentinels)
    if staged:
        df = stage(df, "smart_home_stage", staged if isinstance(staged, str) else None)
    df = with_power_stats(df, names)
    return reorder_columns(df, [n(c) for c in SMART_HOME_OUTPUT])


def smart_home_prepared(
    raw: DataFrame,
    batch_id: str | int,
    names: Mapping[str, str] | None = None,
    window: tuple[str, str] | None = None,
    day_col: str | None = None,
    trace: Trace | None = None,
    types: Mapping[str, str] | None = None,
    sentinels=BLANK_SENTINELS_SMART_HOME,
) -> DataFrame:
    """The rows ``smart_home_etl`` stages: cleaned, keyed, stamped, typed,
    with circuit totals and the recomputed house total."""
    n = _n(names)
    src = [n(c) for c in SMART_HOME_SOURCE]
    df = smart_home_clean(raw, names, window, sentinels, day_col=day_col, trace=trace)
    return smart_home_rows(row_key(df, src, out=n("row_key")), batch_id, names, types)
