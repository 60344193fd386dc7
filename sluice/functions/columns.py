"""Column-expression helpers shared by the operators.

All helpers return native Catalyst expressions (no Python UDFs), so they
fuse into whole-stage codegen and behave the same with ANSI mode on or off.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: sentinel lists the cleaning steps must match -------------
# Rejection list of the scheduled admissions job (row dropped if any column
# equals one of these, case-sensitive, no trimming).
REJECT_SENTINELS = ("", "null", "NA", "None")
# Blanking list of the final admissions job (value replaced by null).
BLANK_SENTINELS = ("", "NA", "None")
# Blanking list of the smart-home job.
BLANK_SENTINELS_SMART_HOME = ("", "NA", "Null", "None")
# ---------------------------------------------------------------------------

SENTINEL_PRESETS = {
    "reject": REJECT_SENTINELS,
    "blank": BLANK_SENTINELS,
    "smart_home": BLANK_SENTINELS_SMART_HOME,
}

# A null's part of the content key; every other part begins with a digit.
KEY_NULL_TOKEN = "N"

EPOCH_NTZ = "1970-01-01 00:00:00"
# Epoch seconds of 0001-01-01 00:00:00 and 9999-12-31 23:59:59, the range in
# which every engine can name the time.
EPOCH_SECONDS = (-62135596800, 253402300799)


# Helpers given column *names* build one SQL expression string per result
# (parsed once on the JVM side); the same helper given a Column composes
# Column calls. Both give the same Catalyst expression. Building from text
# keeps the number of driver round trips per column at one, which matters
# for the 30-column projections of these jobs.


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ident(name: str) -> str:
    """A column name quoted for SQL text (spaces, brackets, backticks)."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A string literal for SQL text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in_list(values: Iterable[str]) -> str:
    return ", ".join(sql_text(v) for v in values)


def is_sentinel(c: str | Column, values: Iterable[str]) -> Column:
    """True when the value equals one of ``values``; null stays null."""
    return _col(c).isin(list(values))


def blanked_sql(name: str, values: Iterable[str]) -> str:
    q = ident(name)
    return f"CASE WHEN {q} IN ({_in_list(values)}) THEN NULL ELSE {q} END"


def blanked(c: str | Column, values: Iterable[str]) -> Column:
    """The value, or null when it equals one of ``values``."""
    if isinstance(c, str):
        return F.expr(blanked_sql(c, values))
    return F.when(c.isin(list(values)), F.lit(None)).otherwise(c)


def unless_sentinel(name: str, values: Iterable[str]) -> Column:
    """``blanked`` inside a larger expression such as a key. It is spelled
    another way on purpose: Catalyst carries a key's definition along as a
    constraint and would keep two versions of it for every column that is
    later blanked by the same expression, doubling their number each time."""
    q = ident(name)
    return F.expr(f"CASE WHEN {q} NOT IN ({_in_list(values)}) THEN {q} END")


def sentinel_free_sql(names: Iterable[str], values: Iterable[str]) -> str:
    """SQL predicate: no column is null or equal to a sentinel."""
    listed = _in_list(values)
    return " AND ".join(f"({ident(n)} IS NOT NULL AND {ident(n)} NOT IN ({listed}))" for n in names)


def content_key(cols: Iterable[str | Column]) -> Column:
    """Deterministic row key: md5 over the values of ``cols``.

    Each value goes in as its length, a colon and its text, a null as ``N``,
    so different rows never make the same text, whatever their cells hold.
    Equal rows get equal keys in every action and on every executor, so a
    frame written to two sinks carries the same ids in both.
    """
    cols = list(cols)
    if all(isinstance(c, str) for c in cols):
        texts = [f"CAST({ident(c)} AS STRING)" for c in cols]
        parts = ", ".join(
            f"coalesce(concat(CAST(char_length({t}) AS STRING), ':', {t}), {sql_text(KEY_NULL_TOKEN)})" for t in texts
        )
        return F.expr(f"md5(concat({parts}))")
    texts = [_col(c).cast("string") for c in cols]
    parts = [
        F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit(":"), t), F.lit(KEY_NULL_TOKEN)) for t in texts
    ]
    return F.md5(F.concat(*parts))


def finite(c: Column) -> Column:
    """A floating-point value, or null if it is NaN or infinite.

    Both sort above every number, so a single such cell would become the
    maximum, and the score, of all rows.
    """
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def number(c: str | Column) -> Column:
    """Text (or a number) as a finite double; anything else is null."""
    return finite(_col(c).try_cast("double"))


def try_cast(c: str | Column, type_name: str) -> Column:
    """``try_cast``: a value that does not fit the type becomes null, and so
    do NaN and the infinities of a floating-point type."""
    if type_name in ("double", "float"):
        if isinstance(c, str):
            cast = f"try_cast({ident(c)} AS {type_name})"
            return F.expr(f"CASE WHEN abs({cast}) < double('Infinity') THEN {cast} END")
        return finite(c.try_cast(type_name))
    if isinstance(c, str):
        return F.expr(f"try_cast({ident(c)} AS {type_name})")
    return c.try_cast(type_name)


def round_half_up(c: str | Column, scale: int) -> Column:
    """HALF_UP rounding of a double on its decimal digits.

    Spark's ``round`` works on the shortest decimal text of the double (1.005
    -> 1.01), once and at any magnitude; NaN and infinities stay.
    """
    return F.round(_col(c).try_cast("double"), scale)


def round_half_even(c: str | Column, scale: int) -> Column:
    """HALF_EVEN (banker's) rounding of a double on its decimal digits."""
    return F.bround(_col(c).try_cast("double"), scale)


def round_binary_half_even(c: str | Column, scale: int) -> Column:
    """HALF_EVEN on the binary double, as ``format_number`` rounds.

    ``2.675 -> 2.67`` (the double is just below the tie), ``0.125 -> 0.12``
    (an exact tie goes to even). The ``format_number`` text, without its
    thousands separators, is read back, so this is the rounding of the
    source's ``format_number(score, 2)`` exactly. It also equals Python's
    ``round(x, scale)`` on every value tested (all x.xx5 and x.xxx5 up to
    100, 4,000 random values) except a value of exactly half a unit at three
    or more places (``±0.0005`` at 3, ``±0.00005`` at 4): ``DecimalFormat``
    takes it for an exact tie and gives 0, Python gives one unit.
    """
    col = F.col(c) if isinstance(c, str) else c
    text = F.regexp_replace(F.format_number(col.try_cast("double"), scale), ",", "")
    return text.try_cast("double")


def parse_day_first_date(c: str | Column, fmt: str = "dd-MM-yyyy") -> Column:
    """Text in ``fmt`` -> date; text that does not parse becomes null."""
    if isinstance(c, str):
        return F.expr(f"try_to_date({ident(c)}, {sql_text(fmt)})")
    return F.try_to_date(c, fmt)


def epoch_seconds_to_ntz(c: str | Column) -> Column:
    """Epoch seconds (number or text) -> ``timestamp_ntz`` in UTC.

    Independent of the session time zone: the seconds are added to the
    epoch as a zone-less timestamp. Text that is not an integer, and seconds
    outside the years 1 to 9999, -> null.
    """
    seconds = _col(c).try_cast("bigint")
    named = F.when(seconds.between(*EPOCH_SECONDS), seconds)
    return F.timestamp_add("SECOND", named, F.lit(EPOCH_NTZ).cast("timestamp_ntz"))


def epoch_seconds_to_text(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds -> formatted UTC text (``from_unixtime`` without the
    session time zone)."""
    return F.date_format(epoch_seconds_to_ntz(c), fmt)


def ntz_to_epoch_seconds(c: str | Column) -> Column:
    """``timestamp_ntz`` -> whole epoch seconds (fraction dropped)."""
    return F.timestamp_diff("SECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _col(c))


def text_to_ntz(c: str | Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Formatted text -> ``timestamp_ntz``; bad text -> null.

    The strict parser only sees text the lenient one accepted, so ANSI mode
    never raises on bad input.
    """
    text = _col(c)
    parses = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
    return F.to_timestamp_ntz(F.when(parses, text), F.lit(fmt))


def ntz_literal(text: str) -> Column:
    """A ``timestamp_ntz`` literal from ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.lit(text).cast("timestamp_ntz")
