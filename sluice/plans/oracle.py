"""DuckDB SQL oracles, one per registered query.

Each text runs in DuckDB over the same Parquet tables (pre-registered as
views) and must return the same rows and column names as the Spark query.
The derived views are rebuilt here as CTEs. Rounding goes through decimals
on both sides, so ties and last-bit differences of double sums cannot make
the engines disagree.
"""

from __future__ import annotations

from sluice.functions.columns import (
    BLANK_SENTINELS,
    BLANK_SENTINELS_SMART_HOME,
    EPOCH_SECONDS,
    KEY_NULL_TOKEN,
    REJECT_SENTINELS,
)
from sluice.plans import catalog as C
from sluice.plans.schemas import (
    ADMISSIONS_OUTPUT,
    ADMISSIONS_SOURCE,
    ADMISSIONS_WORKFLOW_HEADERS,
    ADMISSIONS_WORKFLOW_OUTPUT,
    HOUSE_OVERALL_PARTS,
    POWER_FIELDS,
    SMART_HOME_OUTPUT,
    SMART_HOME_POWER_READINGS,
    SMART_HOME_SOURCE,
    SMART_HOME_TOTALS,
    SMART_HOME_TYPES,
    SMART_HOME_WEATHER_READINGS,
    resolve,
)

DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
EXACT_DECIMAL = "DECIMAL(38,18)"


def _lst(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _q(c: str) -> str:
    return '"' + c + '"'


def _exact(expr: str) -> str:
    """The shortest decimal text of a double, as a decimal."""
    return f"TRY_CAST(CAST({expr} AS VARCHAR) AS {EXACT_DECIMAL})"


def round_up(expr: str, scale: int) -> str:
    return f"CAST(round({_exact(expr)}, {scale}) AS DOUBLE)"


def round_even(expr: str, scale: int) -> str:
    return f"CAST(round_even({_exact(expr)}, {scale}) AS DOUBLE)"


def round_binary(expr: str, scale: int) -> str:
    return f"CAST(format('{{:.{scale}f}}', {expr}) AS DOUBLE)"


def num(expr: str, kind: str = "DOUBLE") -> str:
    """Text as a number; NaN and the infinities are null."""
    cast = f"TRY_CAST({expr} AS {kind})"
    return f"CASE WHEN isfinite({cast}) THEN {cast} END" if kind == "DOUBLE" else cast


def epoch_sql(c: str = "time") -> str:
    seconds = f"TRY_CAST({c} AS BIGINT)"
    low, high = EPOCH_SECONDS
    return f"make_timestamp(CASE WHEN {seconds} BETWEEN {low} AND {high} THEN {seconds} END * 1000000)"


def blank_sql(c: str, values) -> str:
    return f"CASE WHEN {_q(c)} IN ({_lst(values)}) THEN NULL ELSE {_q(c)} END"


def key_sql(cols) -> str:
    texts = [f"CAST({_q(c)} AS VARCHAR)" for c in cols]
    parts = [f"coalesce(CAST(length({t}) AS VARCHAR) || ':' || {t}, '{KEY_NULL_TOKEN}')" for t in texts]
    return f"md5({' || '.join(parts)})"


def all_null_sql(cols) -> str:
    return " AND ".join(f"{_q(c)} IS NULL" for c in cols)


def date_sql(c: str) -> str:
    return f"CAST(try_strptime({_q(c)}, '%d-%m-%Y') AS DATE)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# --- derived views -----------------------------------------------------------

ADMISSIONS_RAW = """adm_b AS (
  SELECT o_orderkey AS k, o_custkey AS u, CAST(o_orderdate AS DATE) AS d,
         CAST(o_orderdate AS DATE) + CAST(1 + o_orderkey % 30 AS INTEGER) AS x,
         o_totalprice AS p
  FROM orders),
adm_r AS (
  SELECT k,
    concat('Patient ', CAST(u AS VARCHAR)) AS name,
    CAST(18 + u % 83 AS VARCHAR) AS age,
    CASE WHEN u % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CASE u % 4 WHEN 0 THEN 'A+' WHEN 1 THEN 'B-' WHEN 2 THEN 'AB+' ELSE 'O-' END AS blood_type,
    CASE k % 6 WHEN 0 THEN 'Diabetes' WHEN 1 THEN 'Asthma' WHEN 2 THEN 'Obesity'
      WHEN 3 THEN 'Arthritis' WHEN 4 THEN 'Hypertension' ELSE 'Cancer' END AS medical_condition,
    strftime(d, '%d-%m-%Y') AS date_of_admission,
    concat('Doctor ', CAST(u % 97 AS VARCHAR)) AS doctor,
    concat('Hospital ', CAST(u % 31 AS VARCHAR), ', Group') AS hospital,
    CASE WHEN k % 23 = 0 THEN '' ELSE concat('Insurer ', CAST(u % 5 AS VARCHAR)) END AS insurance_provider,
    CASE WHEN k % 43 = 0 THEN 'NaN' WHEN k % 53 = 0 THEN 'Infinity'
      ELSE CAST(CAST(p AS DECIMAL(12,2)) AS VARCHAR) END AS billing_amount,
    CAST(101 + k % 400 AS VARCHAR) AS room_number,
    CASE k % 3 WHEN 0 THEN 'Elective' WHEN 1 THEN 'Urgent' ELSE 'Emergency' END AS admission_type,
    strftime(x, '%d-%m-%Y') AS discharge_date,
    CASE WHEN k % 29 = 0 THEN 'Null' ELSE concat('Drug ', CAST(k % 5 AS VARCHAR)) END AS medication,
    CASE WHEN k % 11 = 0 THEN 'NA' WHEN k % 13 = 0 THEN 'None' WHEN k % 17 = 0 THEN 'null'
      WHEN k % 2 = 0 THEN 'Normal' ELSE 'Abnormal' END AS test_results
  FROM adm_b),
admissions_raw AS (
  SELECT * EXCLUDE (k) FROM (
    SELECT * FROM adm_r
    UNION ALL SELECT * FROM adm_r WHERE k % 10 = 3
    UNION ALL SELECT k, """ + ", ".join("''" for _ in ADMISSIONS_SOURCE) + """ FROM adm_r WHERE k % 500 = 0))"""


def _smart_home_raw() -> str:
    cols = [
        "CASE WHEN event_id % 1009 = 500 THEN '99999999999999999' "
        "ELSE CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END AS time",
        "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS use_kw",
    ]
    power = {
        n: f"concat('0.', lpad(CAST(event_id * {7 + 2 * i} % 1000 AS VARCHAR), 3, '0')) AS {n}"
        for i, n in enumerate(SMART_HOME_POWER_READINGS)
    }
    weather = {
        n: f"CAST(event_id * {43 + 2 * i} % 1009 AS VARCHAR) AS {n}"
        for i, n in enumerate(SMART_HOME_WEATHER_READINGS)
    }
    weather["cloud_cover"] = (
        "CASE WHEN event_id % 53 = 0 THEN 'cloudy' ELSE CAST(event_id * 53 % 1009 AS VARCHAR) END AS cloud_cover"
    )
    well = power["well"].removesuffix(" AS well")
    power["well"] = (
        f"CASE WHEN event_id % 61 = 0 THEN 'NaN' WHEN event_id % 67 = 0 THEN '-Infinity' ELSE {well} END AS well"
    )
    other = {
        "temperature": "CASE WHEN event_id % 37 = 0 THEN 'NA' ELSE CAST(event_id % 101 AS VARCHAR) END AS temperature",
        "icon": "event_type AS icon",
        "summary": "CASE WHEN event_id % 41 = 0 THEN 'Null' WHEN event_id % 43 = 0 THEN '' ELSE event_type END AS summary",
    }
    by_name = {**power, **weather, **other}
    cols += [by_name[n] for n in SMART_HOME_SOURCE[2:]]
    blanks = ", ".join("''" for _ in SMART_HOME_SOURCE)
    return (
        "sh_r AS (SELECT event_id,\n    " + ",\n    ".join(cols) + "\n  FROM events),\n"
        "smart_home_raw AS (\n  SELECT * EXCLUDE (event_id) FROM (\n"
        "    SELECT * FROM sh_r\n"
        "    UNION ALL SELECT * FROM sh_r WHERE event_id % 9 = 4\n"
        f"    UNION ALL SELECT event_id, {blanks} FROM sh_r WHERE event_id % 400 = 0))"
    )


SMART_HOME_RAW = _smart_home_raw()

ADM = list(ADMISSIONS_SOURCE)
SH = list(SMART_HOME_SOURCE)

ADM_CLEAN = (
    "adm_clean AS (SELECT * FROM (SELECT DISTINCT "
    + ", ".join(f"{blank_sql(c, BLANK_SENTINELS)} AS {_q(c)}" for c in ADM)
    + " FROM admissions_raw) WHERE NOT (" + all_null_sql(ADM) + "))"
)

ADM_REJECT = (
    "adm_reject AS (SELECT DISTINCT * FROM admissions_raw WHERE "
    + " AND ".join(f"{_q(c)} IS NOT NULL AND {_q(c)} NOT IN ({_lst(REJECT_SENTINELS)})" for c in ADM)
    + ")"
)


def _risk(src: str, out: str, as_text: tuple[str, ...] = (), rounder=round_up, pre=round_up) -> str:
    """CTE ``out``: ``src`` plus ``risk_score`` (maxima taken over ``src``)."""

    def largest(c: str) -> str:
        return f"max(CASE WHEN {num(c)} IS NOT NULL THEN {c} END)" if c in as_text else f"max({num(c)})"

    maxima = f"SELECT {largest('age')} AS ma, {largest('billing_amount')} AS mb FROM {src}"
    bill, mbill = (pre(num(c), 2) if pre else num(c) for c in ("s.billing_amount", "m.mb"))
    score = (
        f"({num('s.age')} / {num('m.ma')}) * 0.4::DOUBLE"
        " + (CASE WHEN s.medical_condition = 'Diabetes' THEN 1 ELSE 0 END) * 0.3::DOUBLE"
        f" + ({bill} / {mbill}) * 0.3::DOUBLE"
    )
    rounded = rounder(score, 2)
    return (
        f"{out}_m AS ({maxima}),\n"
        f"{out} AS (SELECT s.*, {rounded} AS risk_score FROM {src} s CROSS JOIN {out}_m m)"
    )


def _adm_final(src: str, key: str | None = None, columns=ADMISSIONS_OUTPUT, names=None) -> str:
    """Final select of the admissions job over a scored CTE ``src``.

    ``key`` names a row-key column already present in ``src``; by default
    the key is computed here over the cleaned source text.
    """
    exprs = {
        "etl_batch_id": f"CAST({C.BATCH_ID} AS BIGINT)",
        "etl_batch_date": f"DATE '{C.BATCH_ID[:4]}-{C.BATCH_ID[4:6]}-{C.BATCH_ID[6:8]}'",
        "row_key": _q(key) if key else key_sql(ADM),
        "age": "TRY_CAST(age AS INTEGER)",
        "date_of_admission": date_sql("date_of_admission"),
        "billing_amount": num("billing_amount"),
        "room_number": "TRY_CAST(room_number AS INTEGER)",
        "discharge_date": date_sql("discharge_date"),
        "admission_days": "CAST(date_diff('day', "
        + date_sql("date_of_admission") + ", " + date_sql("discharge_date") + ") AS INTEGER)",
        "risk_score": "risk_score",
    }
    cols = [f"{exprs.get(c, _q(c))} AS {_q(resolve(names, c))}" for c in columns]
    return "SELECT " + ",\n  ".join(cols) + f"\nFROM {src}"


def _adm_etl_sql() -> str:
    return _with(ADMISSIONS_RAW, ADM_CLEAN, _risk("adm_clean", "adm_scored")) + _adm_final("adm_scored")


def _adm_etl_reject_sql() -> str:
    # The row key is taken over the text before billing is rounded.
    keyed = "adm_keyed AS (SELECT *, " + key_sql(ADM) + " AS row_key FROM adm_reject)"
    rounded = (
        "adm_rounded AS (SELECT * REPLACE ("
        + round_up(num("billing_amount"), 2)
        + " AS billing_amount) FROM adm_keyed)"
    )
    scored = _risk("adm_rounded", "adm_scored", rounder=round_even)
    return _with(ADMISSIONS_RAW, ADM_REJECT, keyed, rounded, scored) + _adm_final(
        "adm_scored", "row_key", ADMISSIONS_WORKFLOW_OUTPUT, ADMISSIONS_WORKFLOW_HEADERS
    )


def _risk_mixed_sql() -> str:
    rounded = (
        "adm_rounded AS (SELECT * REPLACE (" + round_up(num("billing_amount"), 2) + " AS billing_amount) FROM adm_reject)"
    )
    scored = _risk("adm_rounded", "adm_scored", ("age",), round_binary, None)
    return _with(ADMISSIONS_RAW, ADM_REJECT, rounded, scored) + "SELECT * FROM adm_scored"


# --- smart home ---------------------------------------------------------------

def _sh_timed(window: tuple[str, str] | None = None) -> str:
    rest = ", ".join(_q(c) for c in SH if c != "time")
    where = ""
    if window is not None:
        where = f" WHERE time BETWEEN TIMESTAMP '{window[0]}' AND TIMESTAMP '{window[1]}'"
    return (
        f"sh_timed AS (SELECT * FROM (SELECT {epoch_sql()} AS time, "
        + rest + " FROM smart_home_raw)" + where + ")"
    )


SH_CLEAN = (
    "sh_clean AS (SELECT * FROM (SELECT DISTINCT time, "
    + ", ".join(f"{blank_sql(c, BLANK_SENTINELS_SMART_HOME)} AS {_q(c)}" for c in SH if c != "time")
    + " FROM sh_timed) WHERE NOT (" + all_null_sql(SH) + "))"
)


def _sh_typed(src: str, out: str, extra: str = "") -> str:
    cols = ["time"] + [
        f"{num(_q(c), DUCK_TYPES[SMART_HOME_TYPES[c]])} AS {_q(c)}" for c in SH if c != "time"
    ]
    return f"{out} AS (SELECT " + ", ".join(cols) + extra + f" FROM {src})"


def _sum(parts) -> str:
    return " + ".join(_q(p) for p in parts)


def _sh_totals(src: str, out: str) -> str:
    dropped = sorted({p for ps in SMART_HOME_TOTALS.values() for p in ps})
    adds = ", ".join(f"{_sum(parts)} AS {_q(o)}" for o, parts in SMART_HOME_TOTALS.items())
    return (
        f"{out}_t AS (SELECT * EXCLUDE ({', '.join(_q(c) for c in dropped)}), {adds} FROM {src}),\n"
        f"{out} AS (SELECT * REPLACE ({_sum(HOUSE_OVERALL_PARTS)} AS house_overall) FROM {out}_t)"
    )


def _sh_house_ctes(window=None) -> list[str]:
    return [
        SMART_HOME_RAW,
        _sh_timed(window),
        SH_CLEAN,
        _sh_typed("sh_clean", "sh_typed"),
        _sh_totals("sh_typed", "sh_house"),
    ]


def _sh_stats(src: str) -> str:
    return (
        "sh_stats AS (SELECT max(house_overall) AS max_power, min(house_overall) AS min_power, "
        + round_up("avg(house_overall)", 6) + f" AS avg_power FROM {src})"
    )


def _smart_home_etl_sql(window=None) -> str:
    keyed = "sh_keyed AS (SELECT *, " + key_sql(SH) + " AS row_key FROM sh_clean)"
    ctes = [
        SMART_HOME_RAW,
        _sh_timed(window),
        SH_CLEAN,
        keyed,
        _sh_typed("sh_keyed", "sh_typed", extra=", row_key"),
        _sh_totals("sh_typed", "sh_house"),
        _sh_stats("sh_house"),
    ]
    exprs = {
        "etl_batch_id": f"CAST({C.BATCH_ID} AS BIGINT)",
        "etl_batch_date": f"DATE '{C.BATCH_ID[:4]}-{C.BATCH_ID[4:6]}-{C.BATCH_ID[6:8]}'",
    }
    cols = [f"{exprs.get(c, _q(c))} AS {_q(c)}" for c in SMART_HOME_OUTPUT]
    return _with(*ctes) + "SELECT " + ", ".join(cols) + " FROM sh_house CROSS JOIN sh_stats"


# --- the oracle map ---------------------------------------------------------------

def _adm(select: str, *ctes: str) -> str:
    return _with(ADMISSIONS_RAW, *ctes) + select


def _sh(select: str, window=None, extra=()) -> str:
    return _with(*_sh_house_ctes(window), *extra) + select


def _describe() -> str:
    dropped = {p for ps in SMART_HOME_TOTALS.values() for p in ps}
    parts = []
    for c in [*[c for c in SH if c != "time" and c not in dropped], *SMART_HOME_TOTALS]:
        count = f"SELECT '{c}' AS \"column\", count({_q(c)}) AS \"count\", "
        none = "CAST(NULL AS DOUBLE)"
        if SMART_HOME_TYPES.get(c) == "string":
            parts.append(
                count + f'{none} AS "mean", {none} AS "stddev", {none} AS "min", {none} AS "max", '
                f"min({_q(c)}) AS min_text, max({_q(c)}) AS max_text FROM sh_house"
            )
        else:
            parts.append(
                count + round_up(f"avg({_q(c)})", C.COMPARED_SCALE) + ' AS "mean", '
                + round_up(f"stddev_samp({_q(c)})", C.COMPARED_SCALE) + ' AS "stddev", '
                + f'min({_q(c)}) AS "min", max({_q(c)}) AS "max", '
                "CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM sh_house"
            )
    return "\nUNION ALL ".join(parts)


def _argmax() -> str:
    parts = [f"SELECT '{c}' AS field, max({_q(c)}) AS value FROM sh_house" for c in POWER_FIELDS]
    return (
        "SELECT field, value FROM (" + "\nUNION ALL ".join(parts) + ") "
        "WHERE value IS NOT NULL ORDER BY value DESC, field ASC LIMIT 1"
    )


def _upsert() -> str:
    return f"""WITH e AS (
  SELECT o_orderkey AS key, o_totalprice AS amount, o_orderstatus AS status, CAST(1 AS BIGINT) AS batch
  FROM orders),
b AS (
  SELECT o_orderkey + CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE {C.UPSERT_INSERTS} END AS key, {round_even(f"o_totalprice * {C.UPSERT_RAISE}::DOUBLE", 2)} AS amount,
         o_orderstatus AS status, CAST(2 AS BIGINT) AS batch
  FROM orders),
u AS (SELECT * FROM e UNION ALL SELECT * FROM b)
SELECT key, amount, status, batch FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY batch DESC, amount DESC, status DESC) AS rn
  FROM u) WHERE rn = 1"""


_ROOM = "TRY_CAST(room_number AS INTEGER)"


def _quarantine_sql() -> str:
    def line(cols) -> str:
        texts = [
            "CASE WHEN hospital <> '' THEN '\"' || hospital || '\"' ELSE '' END" if c == "hospital" else _q(c) for c in cols
        ]
        return "concat_ws(',', " + ", ".join(texts) + ")"

    whole, short = line(ADM), line(ADM[: C.SHORT_FIELDS])
    fits = "concat_ws('|', " + ", ".join(f"coalesce(nullif({_q(c)}, ''), '<null>')" for c in ADM) + ")"
    return _adm(f"""SELECT
  CASE {_ROOM} % 10 WHEN 3 THEN 'short' WHEN 5 THEN 'long' WHEN 7 THEN 'unclosed quote' ELSE 'fits' END AS outcome,
  CASE {_ROOM} % 10 WHEN 3 THEN {short} WHEN 5 THEN {whole} || ',extra,more'
    WHEN 7 THEN replace({whole}, ' Group"', ' Group') ELSE {fits} END AS line,
  CASE {_ROOM} % 10 WHEN 3 THEN {C.SHORT_FIELDS} WHEN 5 THEN {len(ADM) + 2} WHEN 7 THEN NULL ELSE {len(ADM)} END AS n_fields
FROM admissions_raw""")


def _by_name_sql() -> str:
    third = f"coalesce({_ROOM} % 3, 0) = 2"
    cols = [
        f"CASE WHEN {third} THEN NULL ELSE nullif({_q(c)}, '') END AS {_q(c)}" if c in C.DRIFT_MISSING
        else f"nullif({_q(c)}, '') AS {_q(c)}"
        for c in ADM
    ]
    return _adm("SELECT " + ", ".join(cols) + f", CASE WHEN {third} THEN 'W' || room_number END AS ward FROM admissions_raw")


def _versions_sql() -> str:
    return _adm(
        "SELECT *, 1 AS version FROM adm_clean UNION ALL SELECT *, 2 AS version FROM adm_reject", ADM_CLEAN, ADM_REJECT
    )


def _windows_sql() -> str:
    return _with(SMART_HOME_RAW, _sh_timed()) + f"""SELECT * FROM sh_timed t WHERE EXISTS (
  SELECT 1 FROM region WHERE r_regionkey % 2 = 1 AND t.time BETWEEN
    TIMESTAMP '{C.WINDOWS_FROM}' + to_days(CAST(3 * r_regionkey AS INTEGER))
    AND TIMESTAMP '{C.WINDOWS_FROM}' + to_days(CAST(3 * r_regionkey + 1 AS INTEGER)) + INTERVAL 1 HOUR)"""


def _step_counts_sql() -> str:
    blank = ", ".join(f"{blank_sql(c, BLANK_SENTINELS)} AS {_q(c)}" for c in ADM)
    counted = f"""landed AS (SELECT CAST(coalesce({_ROOM} % {C.COUNTED_RUNS}, 0) AS INTEGER) AS epoch, * FROM admissions_raw),
uniq AS (SELECT DISTINCT epoch, {blank} FROM landed)"""
    return _adm(f"""SELECT epoch, 'read' AS step, count(*) AS rows FROM landed GROUP BY epoch
UNION ALL SELECT epoch, 'distinct', count(*) FROM uniq GROUP BY epoch
UNION ALL SELECT epoch, 'clean', count(*) FILTER (NOT ({all_null_sql(ADM)})) FROM uniq GROUP BY epoch""", counted)


def oracle_queries() -> dict[str, str]:
    adm_cols = ", ".join(_q(c) for c in ADM)
    blanked = ", ".join(f"{blank_sql(c, BLANK_SENTINELS)} AS {_q(c)}" for c in ADM)
    parsed = ", ".join(
        f"{date_sql(c)} AS {_q(c)}" if c in ("date_of_admission", "discharge_date") else _q(c) for c in ADM
    )
    typed = {"age": "INTEGER", "billing_amount": "DOUBLE", "room_number": "INTEGER"}
    cast_cols = ", ".join(
        f"{num(_q(c), typed[c])} AS {_q(c)}" if c in typed else _q(c) for c in ADM
    )
    rest = [c for c in ADM if c not in C.REORDER_FIRST]
    reordered = ", ".join(_q(c) for c in [*C.REORDER_FIRST, *rest])
    header = ",".join(ADM)
    lines = "concat_ws(',', " + ", ".join(f"coalesce({_q(c)}, '')" for c in ADM) + ")"
    has_sentinel = " OR ".join(f"coalesce({_q(c)} IN ({_lst(BLANK_SENTINELS)}), false)" for c in ADM)
    blanked_all_null = all_null_sql(ADM)
    order_all = ", ".join(f"{_q(c)} ASC NULLS LAST" for c in ADM)
    sh_rest = ", ".join(_q(c) for c in SH if c != "time")
    lo, hi = C.DAY_SLICE

    return {
        "csv_scan": _adm(
            "SELECT " + ", ".join(f"nullif({_q(c)}, '') AS {_q(c)}" for c in ADM) + " FROM admissions_raw"
        ),
        "batch_stamp": _adm(
            f"SELECT *, CAST({C.BATCH_ID} AS BIGINT) AS etl_batch_id, "
            f"DATE '{C.BATCH_ID[:4]}-{C.BATCH_ID[4:6]}-{C.BATCH_ID[6:8]}' AS etl_batch_date FROM admissions_raw"
        ),
        "row_key": _adm(f"SELECT *, {key_sql(ADM)} AS row_key FROM admissions_raw"),
        "random_row_id": _adm("SELECT count(*) AS row_count, count(*) AS distinct_ids FROM admissions_raw"),
        "reject_sentinel_rows": _adm(
            "SELECT * FROM admissions_raw WHERE "
            + " AND ".join(f"{_q(c)} IS NOT NULL AND {_q(c)} NOT IN ({_lst(REJECT_SENTINELS)})" for c in ADM)
        ),
        "blank_sentinels": _adm(f"SELECT {blanked} FROM admissions_raw"),
        "drop_blank_rows": _adm(
            f"SELECT * FROM (SELECT {blanked} FROM admissions_raw) WHERE NOT ({blanked_all_null})"
        ),
        "dedup_rows": _adm("SELECT DISTINCT * FROM admissions_raw"),
        "stage_row_counts": _adm(
            "SELECT CAST(sum(n) AS BIGINT) AS input_rows, CAST(sum(s) AS BIGINT) AS rows_with_sentinel, "
            "CAST(count(*) AS BIGINT) AS distinct_rows, "
            f"CAST(count(*) FILTER (WHERE NOT ({blanked_all_null})) AS BIGINT) AS clean_rows "
            f"FROM (SELECT {adm_cols}, count(*) AS n, sum(f) AS s FROM "
            f"(SELECT {blanked}, CAST(({has_sentinel}) AS INTEGER) AS f FROM admissions_raw) "
            f"GROUP BY ALL)"
        ),
        "parse_dates": _adm(f"SELECT {parsed} FROM admissions_raw"),
        "stay_days": _adm(
            f"SELECT *, CAST(date_diff('day', date_of_admission, discharge_date) AS INTEGER) AS admission_days "
            f"FROM (SELECT {parsed} FROM admissions_raw)"
        ),
        "round_billing": _adm(
            "SELECT * REPLACE (" + round_up(num("billing_amount"), 2)
            + " AS billing_amount) FROM admissions_raw"
        ),
        "format_amount": _adm(
            "SELECT name, billing_amount, "
            f"format('{{:,.2f}}', {num('billing_amount')}) AS billing_text, "
            + round_even(num("billing_amount"), 2) + " AS billing_even FROM admissions_raw"
        ),
        "cast_by_schema": _adm(f"SELECT {cast_cols} FROM admissions_raw"),
        "reorder_columns": _adm(f"SELECT {reordered} FROM admissions_raw"),
        "scalar_max": _adm(
            "SELECT max(TRY_CAST(age AS INTEGER)) AS max_age, "
            f"max({num('billing_amount')}) AS max_billing FROM adm_clean",
            ADM_CLEAN,
        ),
        "text_max": _adm(
            "SELECT max(age) AS max_age_text, max(billing_amount) AS max_billing_text FROM adm_clean",
            ADM_CLEAN,
        ),
        "risk_score": _adm("SELECT * FROM adm_scored", ADM_REJECT, _risk("adm_reject", "adm_scored")),
        "risk_score_text_max": _adm(
            "SELECT * FROM adm_scored", ADM_CLEAN, _risk("adm_clean", "adm_scored", ("age", "billing_amount"))
        ),
        "risk_score_binary": _adm(
            "SELECT * FROM adm_scored", ADM_CLEAN,
            _risk("adm_clean", "adm_scored", ("age", "billing_amount"), round_binary, round_binary),
        ),
        "risk_score_mixed_max": _risk_mixed_sql(),
        "preview_rows": _adm(
            f"SELECT * FROM adm_clean ORDER BY {order_all} LIMIT {C.PREVIEW_ROWS}", ADM_CLEAN
        ),
        "csv_roundtrip": _adm_etl_sql(),
        "csv_unquoted_lines": _adm(
            f"SELECT '{header}' AS value UNION ALL SELECT {lines} AS value FROM admissions_raw"
        ),
        "csv_unquoted_readback": _adm(
            "SELECT " + ", ".join(f"nullif({_q(c)}, '') AS {_q(c)}" for c in ADM if c != "hospital")
            + " FROM admissions_raw"
        ),
        "repartition_publish": _adm("SELECT * FROM adm_clean", ADM_CLEAN),
        "keyed_upsert": _upsert(),
        "keyed_upsert_bucketed": _upsert(),
        "admissions_etl": _adm_etl_sql(),
        "admissions_etl_reject": _adm_etl_reject_sql(),
        "epoch_to_timestamp": _with(SMART_HOME_RAW)
        + f"SELECT {epoch_sql()} AS time, {sh_rest} FROM smart_home_raw",
        "text_to_timestamp": _with(SMART_HOME_RAW)
        + "SELECT use_kw, time_text, CAST(try_strptime(time_text, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS time "
        f"FROM (SELECT use_kw, strftime({epoch_sql()}, '%Y-%m-%d %H:%M:%S') "
        "AS time_text FROM smart_home_raw)",
        "time_range": _with(SMART_HOME_RAW, _sh_timed(C.DAY_SLICE)) + "SELECT * FROM sh_timed",
        "power_totals": _with(SMART_HOME_RAW, _sh_timed(), SH_CLEAN, _sh_typed("sh_clean", "sh_typed"))
        + "SELECT * EXCLUDE ("
        + ", ".join(_q(c) for c in sorted({p for ps in SMART_HOME_TOTALS.values() for p in ps}))
        + "), "
        + ", ".join(f"{_sum(parts)} AS {_q(o)}" for o, parts in SMART_HOME_TOTALS.items())
        + " FROM sh_typed",
        "house_overall": _sh("SELECT * FROM sh_house"),
        "global_power_stats": _with(*_sh_house_ctes(), _sh_stats("sh_house"))
        + "SELECT time, house_overall, max_power, min_power, avg_power FROM sh_house CROSS JOIN sh_stats",
        "top_times": _with(SMART_HOME_RAW, _sh_timed())
        + f"SELECT time, count(*) AS count FROM sh_timed GROUP BY time "
        f"ORDER BY count DESC, time ASC NULLS LAST LIMIT {C.TOP_TIMES}",
        "day_over_day_delta": _sh(
            f"SELECT t.day, {round_up('t.total', C.COMPARED_SCALE)} AS total, "
            f"{round_up('(t.total - p.total)', C.COMPARED_SCALE)} AS delta "
            f"FROM sh_days t LEFT JOIN sh_days p ON t.day = p.day + INTERVAL 1 DAY",
            extra=[
                f"sh_days AS (SELECT CAST(time AS DATE) AS day, "
                "sum(house_overall) AS total FROM sh_house GROUP BY 1)"
            ],
        ),
        "day_extremes": _sh(
            f"SELECT DATE '{C.EXTREMES_DAY}' AS day, max(house_overall) AS max_total_overall, "
            f"min(house_overall) AS min_total_overall, "
            f"{round_up('sum(house_overall)', C.COMPARED_SCALE)} AS sum_total_overall "
            f"FROM sh_house WHERE time >= TIMESTAMP '{C.EXTREMES_DAY} 00:00:00' "
            f"AND time < TIMESTAMP '{C.EXTREMES_DAY} 00:00:00' + INTERVAL 1 DAY"
        ),
        "day_extremes_attached": _sh(
            "SELECT time, house_overall, d.max_total_overall_day, d.min_total_overall_day FROM sh_house CROSS JOIN "
            "(SELECT max(house_overall) AS max_total_overall_day, min(house_overall) AS min_total_overall_day "
            f"FROM sh_house WHERE time >= TIMESTAMP '{C.EXTREMES_DAY} 00:00:00' "
            f"AND time < TIMESTAMP '{C.EXTREMES_DAY} 00:00:00' + INTERVAL 1 DAY) d"
        ),
        "argmax_column": _sh(_argmax()),
        "describe_power": _sh(_describe()),
        "smart_home_etl": _smart_home_etl_sql(),
        "smart_home_stream": _smart_home_etl_sql(),
        "smart_home_stream_folded": _smart_home_etl_sql(),
        "admissions_stream_folded": _adm_etl_sql(),
        "stream_step_counts": _step_counts_sql(),
        "csv_quarantine": _quarantine_sql(),
        "csv_by_name": _by_name_sql(),
        "publish_versions": _versions_sql(),
        "keyed_upsert_in_place": _upsert(),
        "range_publish": "SELECT * FROM orders",
        "time_windows": _windows_sql(),
        "admissions_stream": _adm_etl_sql(),
        "smart_home_etl_window": _smart_home_etl_sql((lo, hi)),
    }
