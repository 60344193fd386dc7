"""Hospital admissions job: clean, derive length of stay and risk score.

Two flows over the same operators:

* ``admissions_etl`` (the final flow): blank sentinels -> dedup -> drop
  all-blank rows -> parse dates -> stay days -> row key + batch stamp ->
  risk score -> typed casts -> output order.
* ``admissions_etl_reject`` (the scheduled-workflow flow): reject any row
  holding a sentinel -> dedup -> dates -> stay days -> billing rounded ->
  risk score rounded HALF_EVEN -> casts -> output order.

Deliberate fixes to the source flows: dedup runs on the source columns
before row ids are added (else it removes nothing), blank rows are judged
on the source columns only, maxima are typed (not text) unless asked, the
batch id is a ``bigint`` argument, and row ids are content keys.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import BLANK_SENTINELS, REJECT_SENTINELS, content_key, unless_sentinel
from sluice.operators.clean import (
    Trace,
    blank_sentinels,
    dedup_rows,
    drop_blank_rows,
    reject_sentinel_rows,
    traced,
)
from sluice.operators.partials import with_folded_stats
from sluice.operators.shape import cast_by_schema, parse_dates, reorder_columns, round_column, stay_days
from sluice.operators.stamp import batch_stamp, row_key
from sluice.operators.stats import risk_score
from sluice.sinks.files import stage
from sluice.plans.schemas import ADMISSIONS_OUTPUT, ADMISSIONS_SOURCE, ADMISSIONS_TYPES, resolve

DATE_FORMAT = "dd-MM-yyyy"


def _n(names: Mapping[str, str] | None):
    return lambda c: resolve(names, c)


def admissions_clean(
    raw: DataFrame,
    names: Mapping[str, str] | None = None,
    sentinels=BLANK_SENTINELS,
    trace: Trace | None = None,
    distinct: bool = True,
) -> DataFrame:
    """Blank sentinels, drop exact duplicates, drop all-blank rows.

    ``trace`` (a dict) collects row counts after reading, dedup and the
    blank-row drop, as a side effect of the job's own run.
    ``distinct=False`` leaves duplicates in, and the shuffle out: for maxima
    and minima, which they don't change.
    """
    n = _n(names)
    src = [n(c) for c in ADMISSIONS_SOURCE]
    df = blank_sentinels(traced(raw.select(*src), "read", trace), sentinels, src)
    df = traced(dedup_rows(df) if distinct else df, "distinct", trace)
    return traced(drop_blank_rows(df, src), "clean", trace)


def admissions_rejected(
    raw: DataFrame,
    names: Mapping[str, str] | None = None,
    sentinels=REJECT_SENTINELS,
    trace: Trace | None = None,
) -> DataFrame:
    """Keep only rows free of sentinels, then drop exact duplicates."""
    n = _n(names)
    src = [n(c) for c in ADMISSIONS_SOURCE]
    df = traced(raw.select(*src), "read", trace)
    df = traced(reject_sentinel_rows(df, sentinels, src), "sentinel_free", trace)
    return traced(dedup_rows(df), "distinct", trace)


def _prepare(
    df: DataFrame,
    batch_id: str | int,
    names: Mapping[str, str] | None,
    round_billing: bool = False,
) -> DataFrame:
    """Cleaned rows -> keyed, dated and stamped rows (what gets staged)."""
    n = _n(names)
    # The key is taken over the cleaned source text, before any parsing.
    df = row_key(df, [n(c) for c in ADMISSIONS_SOURCE], out=n("row_key"))
    return admissions_rows(df, batch_id, names, round_billing)


def admissions_rows(
    df: DataFrame,
    batch_id: str | int,
    names: Mapping[str, str] | None = None,
    round_billing: bool = False,
) -> DataFrame:
    """Keyed distinct rows, dated and stamped: all of the flow but the score."""
    n = _n(names)
    if round_billing:
        df = round_column(df, n("billing_amount"), 2)
    df = parse_dates(df, [n("date_of_admission"), n("discharge_date")], DATE_FORMAT)
    df = stay_days(df, n("date_of_admission"), n("discharge_date"), n("admission_days"))
    return batch_stamp(df, batch_id, n("etl_batch_id"), n("etl_batch_date"))


def _score(
    df: DataFrame,
    names: Mapping[str, str] | None,
    text_maxima: bool | Collection[str],
    half_even: bool,
    rounding: str | None = None,
    types: Mapping[str, str] | None = None,
    columns: Sequence[str] = ADMISSIONS_OUTPUT,
    **maxima: Column,
) -> DataFrame:
    """Stamped rows -> scored, typed rows in output order."""
    n = _n(names)
    df = risk_score(
        df,
        n("age"),
        n("medical_condition"),
        n("billing_amount"),
        out=n("risk_score"),
        text_maxima=text_maxima,
        half_even=half_even,
        rounding=rounding,
        **maxima,
    ).drop("__age", "__billing")
    type_map = {**ADMISSIONS_TYPES, **(types or {})}
    df = cast_by_schema(df, {n(c): t for c, t in type_map.items()})
    return reorder_columns(df, [n(c) for c in columns])


def _finish(
    df: DataFrame,
    batch_id: str | int,
    names: Mapping[str, str] | None,
    text_maxima: bool | Collection[str],
    half_even: bool,
    round_billing: bool = False,
    staged: bool | str = True,
    rounding: str | None = None,
    types: Mapping[str, str] | None = None,
    columns: Sequence[str] = ADMISSIONS_OUTPUT,
) -> DataFrame:
    df = _prepare(df, batch_id, names, round_billing)
    if staged:
        df = stage(df, "admissions_stage", staged if isinstance(staged, str) else None)
    return _score(df, names, text_maxima, half_even, rounding, types, columns)


def admissions_prepared(
    raw: DataFrame,
    batch_id: str | int,
    names: Mapping[str, str] | None = None,
    sentinels=BLANK_SENTINELS,
) -> DataFrame:
    """The rows ``admissions_etl`` stages: cleaned, keyed, dated, stamped."""
    return _prepare(admissions_clean(raw, names, sentinels), batch_id, names)


def admissions_keyed(
    raw: DataFrame, names: Mapping[str, str] | None = None, sentinels=BLANK_SENTINELS
) -> DataFrame:
    """Rows as read, with the row key of their cleaned form: all that a stream
    needs to drop what it has seen (``admissions_first_seen`` cleans the rest)."""
    n = _n(names)
    src = [n(c) for c in ADMISSIONS_SOURCE]
    return raw.select(*src).withColumn(n("row_key"), content_key([unless_sentinel(c, sentinels) for c in src]))


def admissions_first_seen(
    keyed: DataFrame, names: Mapping[str, str] | None = None, sentinels=BLANK_SENTINELS
) -> DataFrame:
    """Distinct rows of ``admissions_keyed``, cleaned."""
    n = _n(names)
    src = [n(c) for c in ADMISSIONS_SOURCE]
    return drop_blank_rows(blank_sentinels(keyed, sentinels, src), src)


def admissions_scored(
    rows: DataFrame,
    names: Mapping[str, str] | None = None,
    maxima: DataFrame | None = None,
    types: Mapping[str, str] | None = None,
    columns: Sequence[str] = ADMISSIONS_OUTPUT,
) -> DataFrame:
    """``admissions_rows`` scored and in output order; with ``maxima`` (rows
    of ``partial_stats``) by the maxima of all batches together."""
    n = _n(names)
    if maxima is None:
        return _score(rows, names, False, half_even=False, types=types, columns=columns)
    stats = {"__age": (n("age"), "max"), "__billing": (n("billing_amount"), "max")}
    return _score(
        with_folded_stats(rows, maxima, stats), names, False, half_even=False, types=types, columns=columns,
        max_age=F.col("__age"), max_billing=F.col("__billing"),
    )


def admissions_etl(
    raw: DataFrame,
    batch_id: str | int,
    names: Mapping[str, str] | None = None,
    sentinels=BLANK_SENTINELS,
    text_maxima: bool | Collection[str] = False,
    staged: bool | str = True,
    trace: Trace | None = None,
    rounding: str | None = None,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """The final admissions flow; 20 output columns (``ADMISSIONS_OUTPUT``).

    ``staged``: write the cleaned, stamped rows once (to this path, or to
    the checkpoint folder when ``True``) and derive maxima and scores from
    the written table; ``False`` keeps one lazy plan, in which the maxima
    subquery re-reads the source. ``rounding="binary"`` (with
    ``text_maxima=True``) reproduces the source's Python score function
    bit for bit; the default rounds on decimal digits, HALF_UP. ``types``
    overrides entries of the output type map (logical name -> type), e.g.
    ``{"risk_score": "float", "billing_amount": "float"}`` for the
    single-precision columns of the source's output.
    """
    df = admissions_clean(raw, names, sentinels, trace)
    return _finish(
        df, batch_id, names, text_maxima, half_even=False, staged=staged, rounding=rounding,
        types=types,
    )


def admissions_etl_reject(
    raw: DataFrame,
    batch_id: str | int,
    names: Mapping[str, str] | None = None,
    sentinels=REJECT_SENTINELS,
    staged: bool | str = True,
    trace: Trace | None = None,
    rounding: str | None = None,
    types: Mapping[str, str] | None = None,
    text_maxima: bool | Collection[str] = False,
    columns: Sequence[str] = ADMISSIONS_OUTPUT,
) -> DataFrame:
    """The scheduled-workflow flow: sentinel rows rejected, not blanked.

    The score is rounded HALF_EVEN on decimal digits; ``rounding="binary"``
    rounds on the binary double as the source's ``format_number`` did, and
    ``text_maxima={"age"}`` takes the source's maxima (ages as text). With
    ``names=ADMISSIONS_WORKFLOW_HEADERS`` and
    ``columns=ADMISSIONS_WORKFLOW_OUTPUT`` the result has that job's own
    column names and order.
    """
    df = admissions_rejected(raw, names, sentinels, trace)
    return _finish(
        df, batch_id, names, text_maxima=text_maxima, half_even=True, round_billing=True,
        staged=staged, rounding=rounding, types=types, columns=columns,
    )
