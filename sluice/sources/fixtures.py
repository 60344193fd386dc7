"""Reference-shaped dirty inputs derived from the driver tables.

The driver tables are clean (no nulls, no duplicate rows), so the cleaning
operators would run on nothing. These two views re-shape whole tables into
the text records the jobs expect: every value is text, with sentinels,
exact duplicate rows and all-blank rows mixed in. Each is one full scan, a
per-row ``explode`` of the copies and one projection, so its size grows with
the table. The expressions are SQL text (one ``selectExpr`` per view), the
same text the DuckDB oracle uses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.plans.schemas import (
    ADMISSIONS_SOURCE,
    SMART_HOME_POWER_READINGS,
    SMART_HOME_SOURCE,
    SMART_HOME_WEATHER_READINGS,
)
from sluice.sources.tables import read_table


def _cases(key: str, labels: list[str]) -> str:
    """labels[key % len(labels)] as a CASE expression."""
    n = len(labels)
    whens = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(labels[:-1]))
    return f"CASE {key} % {n} {whens} ELSE '{labels[-1]}' END"


ADMISSIONS_EXPRS = {
    "name": "concat('Patient ', CAST(u AS STRING))",
    "age": "CAST(18 + u % 83 AS STRING)",
    "gender": "CASE WHEN u % 2 = 0 THEN 'Female' ELSE 'Male' END",
    "blood_type": _cases("u", ["A+", "B-", "AB+", "O-"]),
    "medical_condition": _cases(
        "k", ["Diabetes", "Asthma", "Obesity", "Arthritis", "Hypertension", "Cancer"]
    ),
    "date_of_admission": "date_format(d, 'dd-MM-yyyy')",
    "doctor": "concat('Doctor ', CAST(u % 97 AS STRING))",
    "hospital": "concat('Hospital ', CAST(u % 31 AS STRING), ', Group')",
    "insurance_provider": "CASE WHEN k % 23 = 0 THEN '' ELSE concat('Insurer ', CAST(u % 5 AS STRING)) END",
    "billing_amount": "CASE WHEN k % 43 = 0 THEN 'NaN' WHEN k % 53 = 0 THEN 'Infinity' ELSE CAST(CAST(p AS DECIMAL(12,2)) AS STRING) END",
    "room_number": "CAST(101 + k % 400 AS STRING)",
    "admission_type": _cases("k", ["Elective", "Urgent", "Emergency"]),
    "discharge_date": "date_format(date_add(d, CAST(1 + k % 30 AS INT)), 'dd-MM-yyyy')",
    "medication": "CASE WHEN k % 29 = 0 THEN 'Null' ELSE concat('Drug ', CAST(k % 5 AS STRING)) END",
    "test_results": (
        "CASE WHEN k % 11 = 0 THEN 'NA' WHEN k % 13 = 0 THEN 'None' WHEN k % 17 = 0 THEN 'null' "
        "WHEN k % 2 = 0 THEN 'Normal' ELSE 'Abnormal' END"
    ),
}
assert tuple(ADMISSIONS_EXPRS) == ADMISSIONS_SOURCE


def _with_copies(scan: DataFrame, key: str, dup_mod: int, dup_rem: int, blank_mod: int, exprs) -> DataFrame:
    """Text rows from one scan: each row once, a second copy of the rows with
    ``key % dup_mod = dup_rem``, and an all-blank row per ``key % blank_mod = 0``.

    The copies come from one ``explode`` of a per-row copy list (0 = the row,
    1 = its duplicate, 2 = a blank twin), so the table is scanned once.
    """
    copies = (
        f"filter(array(0, CASE WHEN {key} % {dup_mod} = {dup_rem} THEN 1 END, "
        f"CASE WHEN {key} % {blank_mod} = 0 THEN 2 END), c -> c IS NOT NULL)"
    )
    rows = scan.selectExpr("*", f"explode({copies}) AS _copy")
    return rows.selectExpr(
        *[f"CASE WHEN _copy = 2 THEN '' ELSE {e} END AS {n}" for n, e in exprs.items()]
    )


def admissions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15 text columns of hospital admissions, one row per order.

    Extra copies: every order with key % 10 = 3 appears twice; one all-blank
    row per 500 orders. Sentinels: '' insurer (key % 23), 'Null' medication
    (key % 29), 'NA' / 'None' / 'null' test results (key % 11, 13, 17), and
    the billing texts 'NaN' (key % 43) and 'Infinity' (key % 53).
    """
    orders = read_table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "o_custkey AS u", "CAST(o_orderdate AS DATE) AS d", "o_totalprice AS p"
    )
    return _with_copies(orders, "k", 10, 3, 500, ADMISSIONS_EXPRS)


def _smart_home_exprs() -> dict[str, str]:
    exprs = {
        "time": "CASE WHEN event_id % 1009 = 500 THEN '99999999999999999' "
        "ELSE CAST(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts) AS STRING) END",
        "use_kw": "CAST(CAST(value AS DECIMAL(12,2)) AS STRING)",
    }
    for n, name in enumerate(SMART_HOME_POWER_READINGS):
        exprs[name] = f"concat('0.', lpad(CAST(event_id * {7 + 2 * n} % 1000 AS STRING), 3, '0'))"
    for n, name in enumerate(SMART_HOME_WEATHER_READINGS):
        exprs[name] = f"CAST(event_id * {43 + 2 * n} % 1009 AS STRING)"
    exprs["cloud_cover"] = f"CASE WHEN event_id % 53 = 0 THEN 'cloudy' ELSE {exprs['cloud_cover']} END"
    exprs["well"] = f"CASE WHEN event_id % 61 = 0 THEN 'NaN' WHEN event_id % 67 = 0 THEN '-Infinity' ELSE {exprs['well']} END"
    exprs["temperature"] = "CASE WHEN event_id % 37 = 0 THEN 'NA' ELSE CAST(event_id % 101 AS STRING) END"
    exprs["icon"] = "event_type"
    exprs["summary"] = "CASE WHEN event_id % 41 = 0 THEN 'Null' WHEN event_id % 43 = 0 THEN '' ELSE event_type END"
    return {name: exprs[name] for name in SMART_HOME_SOURCE}


SMART_HOME_EXPRS = _smart_home_exprs()


def smart_home_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """32 text columns of smart-home readings, one row per event.

    ``time`` is epoch seconds as text. Extra copies: event_id % 9 = 4 rows
    twice; one all-blank row per 400 events. Sentinels: 'NA' temperature
    (id % 37), 'Null' / '' summary (id % 41, 43), 'cloudy' cloud cover
    (id % 53) for the failed numeric cast, 'NaN' and '-Infinity' well readings
    (id % 61, 67), and an epoch beyond every calendar (id % 1009).

    Power columns use odd multipliers from 7 upwards (mod 1000, shown as
    0.xxx kW); weather columns continue from 43 (mod 1009).
    """
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    return _with_copies(events, "event_id", 9, 4, 400, SMART_HOME_EXPRS)
