"""Property tests over generated text rows (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sluice.operators import (
    blank_sentinels,
    dedup_rows,
    drop_blank_rows,
    keyed_upsert,
    reject_sentinel_rows,
    rejected_sentinel_rows,
    risk_score,
)

CELL = st.one_of(st.none(), st.sampled_from(["", "NA", "None", "null", "Null", "x", "y", "7"]))
ROWS = st.lists(st.tuples(CELL, CELL, CELL), min_size=0, max_size=25)
SCHEMA = "a string, b string, c string"
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@SETTINGS
@given(rows=ROWS)
def test_cleaning_properties(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    blanked = blank_sentinels(df)
    assert _rows(blank_sentinels(blanked)) == _rows(blanked)  # idempotent
    deduped = dedup_rows(df)
    assert _rows(dedup_rows(deduped)) == _rows(deduped)
    assert deduped.count() == len(set(rows))
    kept, dropped = reject_sentinel_rows(df), rejected_sentinel_rows(df)
    assert kept.count() + dropped.count() == len(rows)  # a partition of the input
    assert set(_rows(kept)) <= set(rows)
    clean = drop_blank_rows(blanked)
    assert all(any(v is not None for v in r) for r in clean.collect())


@SETTINGS
@given(
    ages=st.lists(st.integers(min_value=0, max_value=120), min_size=1, max_size=20),
    bills=st.lists(st.floats(min_value=0, max_value=1e6, allow_nan=False), min_size=1, max_size=20),
)
def test_score_in_unit_interval(spark, ages, bills):
    n = min(len(ages), len(bills))
    rows = [(str(ages[i]), "Diabetes" if i % 2 else "Asthma", f"{bills[i]:.2f}") for i in range(n)]
    df = spark.createDataFrame(rows, "age string, cond string, bill string")
    for r in risk_score(df, "age", "cond", "bill").collect():
        if r.risk_score is not None:
            assert 0.0 <= r.risk_score <= 1.0


@SETTINGS
@given(
    old=st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["p", "q", "r"])), max_size=15),
    new=st.lists(st.tuples(st.integers(0, 8), st.sampled_from(["p", "q", "r"])), max_size=15),
)
def test_upsert_properties(spark, old, new):
    existing = spark.createDataFrame([(k, v, 1) for k, v in old], "key int, v string, batch int")
    batch = spark.createDataFrame([(k, v, 2) for k, v in new], "key int, v string, batch int")
    once = keyed_upsert(existing, batch, ["key"], "batch")
    twice = keyed_upsert(once, batch, ["key"], "batch")
    assert _rows(once) == _rows(twice)  # idempotent
    got = {r.key: (r.v, r.batch) for r in once.collect()}
    assert len(got) == once.count()  # one row per key
    for k, _ in new:
        assert got[k] == (max(v for kk, v in new if kk == k), 2)  # newest wins, ties by value
    for k, _ in old:
        if k not in {kk for kk, _ in new}:
            assert got[k][1] == 1


@SETTINGS
@given(keys=st.lists(st.sampled_from("abcdefgh"), min_size=1, max_size=60), k=st.integers(1, 5))
def test_top_k_equals_counter(spark, keys, k):
    from collections import Counter

    from sluice.operators import top_k_counts

    df = spark.createDataFrame([(x,) for x in keys], "key string")
    got = [(r.key, r["count"]) for r in top_k_counts(df, "key", k).collect()]
    want = sorted(Counter(keys).items(), key=lambda kv: (-kv[1], kv[0]))[:k]
    assert got == want


@SETTINGS
@given(
    readings=st.lists(
        st.tuples(st.integers(0, 9 * 24 * 3600), st.integers(0, 999)), min_size=1, max_size=40
    )
)
def test_day_over_day_delta_equals_python(spark, readings):
    import datetime as dt
    from collections import defaultdict

    import pytest

    from sluice.operators import day_over_day_delta

    start = dt.datetime(2024, 2, 27)  # spans the leap day
    rows = [(start + dt.timedelta(seconds=s), v / 1000) for s, v in readings]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, v double")
    got = {r.day: (r.total, r.delta) for r in day_over_day_delta(df, "ts", "v").collect()}
    totals = defaultdict(float)
    for ts, v in rows:
        totals[ts.date()] += v
    assert set(got) == set(totals)
    for d, t in totals.items():
        before = totals.get(d - dt.timedelta(days=1))
        assert got[d][0] == pytest.approx(t, abs=1e-9)
        assert got[d][1] == (None if before is None else pytest.approx(t - before, abs=1e-9))


@SETTINGS
@given(rows=ROWS)
def test_stage_counts_equal_python(spark, rows):
    from sluice.functions.columns import BLANK_SENTINELS
    from sluice.operators import stage_row_counts

    df = spark.createDataFrame(rows, SCHEMA)
    got = stage_row_counts(df).first().asDict()
    blank = [tuple(None if v in BLANK_SENTINELS else v for v in r) for r in rows]
    distinct = set(blank)
    want = {
        "input_rows": len(rows),
        "rows_with_sentinel": sum(any(v in BLANK_SENTINELS for v in r) for r in rows),
        "distinct_rows": len(distinct),
        "clean_rows": sum(any(v is not None for v in r) for r in distinct),
    }
    assert got == want


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(*[st.one_of(st.none(), st.integers(0, 50).map(float)) for _ in range(3)]),
        min_size=1,
        max_size=15,
    )
)
def test_argmax_column_equals_python(spark, rows):
    from sluice.operators import argmax_column

    df = spark.createDataFrame(rows, "p double, q double, r double")
    maxima = {f: max((r[i] for r in rows if r[i] is not None), default=None) for i, f in enumerate("pqr")}
    present = {f: m for f, m in maxima.items() if m is not None}
    got = argmax_column(df, ["p", "q", "r"]).collect()
    if not present:
        assert got == []
    else:
        best = max(present.values())
        field = min(f for f, m in present.items() if m == best)
        assert [(g.field, g.value) for g in got] == [(field, best)]


KEY_CELL = st.one_of(st.none(), st.sampled_from(["", "|", "<null>", "N", "1:a", "a", "a|b", "b|c", ":", "0:"]), st.text(max_size=3))


@SETTINGS
@given(rows=st.lists(st.tuples(KEY_CELL, KEY_CELL, KEY_CELL), min_size=1, max_size=40, unique=True))
def test_different_rows_have_different_keys_and_all_survive_an_upsert(spark, rows):
    from sluice.operators import row_key

    keyed = row_key(spark.createDataFrame(rows, SCHEMA))
    assert keyed.select("row_key").distinct().count() == len(rows)
    batch = keyed.selectExpr("*", "1 AS batch")
    merged = keyed_upsert(batch.limit(0), batch, ["row_key"], "batch")
    assert _rows(merged.select("a", "b", "c")) == sorted(rows, key=repr)
