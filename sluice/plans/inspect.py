"""Plan inspection through the public ``explain`` output."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


# Operators that mean per-row Python, a cross product or a whole-table
# single task; none of them belongs in these jobs' plans.
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def single_partition_windows(df: DataFrame) -> int:
    """How many ``Window`` operators read a single-partition exchange."""
    lines = plan_text(df, "simple").splitlines()
    count = 0
    for i, line in enumerate(lines):
        if line.lstrip(" :+-").startswith("Window "):
            below = next((x for x in lines[i + 1 :] if "Exchange" in x), "")
            count += "SinglePartition" in below
    return count


def plan_problems(df: DataFrame) -> list[str]:
    """Names of unwanted operators in the physical plan (empty = clean)."""
    text = plan_text(df)
    found = [op for op in FORBIDDEN if op in text]
    if single_partition_windows(df):
        found.append("Window over SinglePartition")
    return found
