"""Statistics that add up: one row of partial figures per batch.

A batch keeps count, sum, least, greatest and greatest text of its columns;
folding the rows of any number of batches gives the figures of all of them
together, without reading their data again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.columns import number
from sluice.operators.stats import with_scalar_stats

_PARTS = ("n", "sum", "min", "max", "text")


def _part(column: str, part: str) -> str:
    return f"{part}:{column}"


def partial_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the partial figures of ``columns``.

    Values that are no finite numbers take no part, as in ``with_global_stats``;
    the greatest text is that of the values that are.
    """
    aggregates = []
    for c in columns:
        value = number(c)
        text = F.when(value.isNotNull(), F.col(c).cast("string"))
        for part, e in zip(_PARTS, (F.count(value), F.sum(value), F.min(value), F.max(value), F.max(text))):
            aggregates.append(e.alias(_part(c, part)))
    return df.agg(*aggregates)


def folded(column: str, stat: str) -> Column:
    """An aggregate over rows of ``partial_stats``: ``count``, ``sum``,
    ``avg``, ``min``, ``max`` or ``text_max`` of all batches together."""
    part = {p: F.col(f"`{_part(column, p)}`") for p in _PARTS}
    return {
        "count": F.sum(part["n"]),
        "sum": F.sum(part["sum"]),
        "avg": F.try_divide(F.sum(part["sum"]), F.sum(part["n"])),
        "min": F.min(part["min"]),
        "max": F.max(part["max"]),
        "text_max": F.max(part["text"]),
    }[stat]


def with_folded_stats(df: DataFrame, partials: DataFrame, stats: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Attach folded statistics (output name -> (column, stat)) to every row."""
    return with_scalar_stats(df, {out: folded(c, stat) for out, (c, stat) in stats.items()}, of=partials)
