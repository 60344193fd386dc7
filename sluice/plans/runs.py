"""Complete runs of the two jobs: read CSV, transform, write every sink.

The job result is written once as Parquet; every other sink (CSV directory,
keyed table, published version, JDBC table) is fed from that written table, so
all sinks carry the same rows and ids and the job is not recomputed per sink.
Each sink has a commit record in the run's ledger: a run that died is called
again and does only what is missing.

Command line::

    python -m sluice admissions --input DIR --output DIR \\
        [--batch-id 17DIGITS] [--headers original|snake|workflow] [--keyed-previous DIR] \\
        [--text-maxima age billing] [--rounding half_up|half_even|binary] \\
        [--keyed-table DIR --keyed-buckets N] [--publish-to DIR] [--quarantine | --by-name] \\
        [--jdbc-url URL --jdbc-table TABLE]
    python -m sluice smart_home --input DIR --output DIR \\
        [--window "2016-01-01 05:00:00" "2016-01-01 06:00:00"] [--day-col COLUMN]

A JDBC user and password are read from the environment (``JDBC_USER``,
``JDBC_PASSWORD``), never from the command line.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluice.operators.clean import trace_counts
from sluice.operators.stamp import batch_stamp, new_batch_id, row_key
from sluice.operators.upsert import keyed_upsert, replace_buckets, stage_upsert
from sluice.plans.admissions import admissions_etl, admissions_etl_reject
from sluice.plans.schemas import (
    ADMISSIONS_HEADERS,
    ADMISSIONS_OUTPUT,
    ADMISSIONS_SOURCE,
    ADMISSIONS_WORKFLOW_HEADERS,
    ADMISSIONS_WORKFLOW_OUTPUT,
    SMART_HOME_HEADERS,
    SMART_HOME_SOURCE,
    resolve,
)
from sluice.plans.smart_home import smart_home_etl
from sluice.session import delete_path, path_exists, warn_of_interpreted_stages
from sluice.sinks.commits import (
    RunLedger,
    current_version,
    held_by,
    hold_table,
    publish_version,
    published_by,
    release_table,
)
from sluice.sinks.files import publish, write_jdbc, write_once
from sluice.sources.csv import (
    MISFIT_COLUMN,
    fitting_rows,
    misfit_lines,
    read_checked_csv,
    read_csv_by_name,
    read_text_csv,
)


@dataclass
class RunOutputs:
    table: str
    csv: str | None
    keyed: str | None
    rows: DataFrame
    raw: str | None = None
    counts: dict[str, int] | None = None
    quarantine: str | None = None
    published: int | None = None


class _Run:
    """One run: its output directory, batch id, ledger and trace.

    Every sink is an action of the ledger that replaces what an earlier
    attempt left, so a run that died anywhere is called again with the same
    arguments and does what is missing, once. Without a batch id the run that
    was left unfinished in the directory goes on, else a new one starts.
    """

    def __init__(self, spark: SparkSession, output_dir: str, batch_id: str | None):
        self.spark, self.out = spark, output_dir.rstrip("/")
        self.batch_id = str(batch_id or RunLedger.unfinished(spark, self.out) or new_batch_id())
        if RunLedger.holds_other(spark, self.out, self.batch_id) or (
            RunLedger.started(spark, self.out, self.batch_id) is None and path_exists(spark, f"{self.out}/table")
        ):
            raise FileExistsError(f"{self.out} holds the outputs of another run")
        self.ledger = RunLedger(spark, self.out, self.batch_id)
        self.trace: dict = {}
        self.misfits: Observation | None = None
        self.stage = f"{self.out}/_stage"

    def table(self, result: Callable[[str], DataFrame]) -> DataFrame:
        """The result, computed (staged at the path it is given) and written
        unless an earlier attempt did."""
        path = f"{self.out}/table"

        def write() -> dict:
            for left in (path, self.stage):
                delete_path(self.spark, left)
            write_once(self.spark, result(self.stage), path)
            misfits = {} if self.misfits is None else {"misfits": self.misfits.get["misfits"]}
            return {"counts": trace_counts(self.trace) | misfits}

        self.counts = self.ledger.sink("table", write)["counts"]
        return self.spark.read.parquet(path)

    def finish(self, keep_stage: bool) -> None:
        if not keep_stage:
            delete_path(self.spark, self.stage)
        self.ledger.finish()


def _input(
    run: _Run, input_path: str | Sequence[str], columns: Sequence[str], quarantine: bool, by_name: bool
) -> tuple[DataFrame, DataFrame | None]:
    """The input's rows, and the lines that do not fit where those are kept."""
    path = input_path if isinstance(input_path, str) else list(input_path)
    if by_name and quarantine:
        raise ValueError("lines are checked against one header: choose quarantine or by_name")
    if by_name:
        return read_csv_by_name(run.spark, path), None
    if not quarantine:
        return read_text_csv(run.spark, path), None
    checked = read_checked_csv(run.spark, path, columns)
    run.misfits = Observation("misfits")
    seen = checked.observe(run.misfits, F.count_if(F.col(MISFIT_COLUMN).isNotNull()).alias("misfits"))
    return fitting_rows(seen), misfit_lines(checked)


def _quarantine(run: _Run, misfits: DataFrame | None) -> str | None:
    """Write the misfits apart, if the run that read the rows saw any: only
    then is the input read a second time."""
    if misfits is None or not run.counts["misfits"]:
        return None
    path = f"{run.out}/quarantine"
    run.ledger.sink("quarantine", lambda: publish(misfits, path))
    return path


def _sinks(
    run: _Run,
    written: DataFrame,
    key: str,
    version: str,
    csv: bool,
    keyed_previous: str | None,
    jdbc: Mapping[str, str] | None,
    keyed_table: str | None = None,
    keyed_buckets: int = 64,
    publish_to: str | None = None,
) -> RunOutputs:
    spark, out, sink = run.spark, run.out, run.ledger.sink
    outputs = RunOutputs(f"{out}/table", None, None, written, counts=run.counts)
    if csv:
        outputs.csv = f"{out}/csv"
        sink("csv", lambda: publish(written, outputs.csv, fmt="csv"))
    if keyed_previous is not None:
        outputs.keyed = f"{out}/keyed"
        previous = spark.read.parquet(keyed_previous)
        sink("keyed", lambda: publish(keyed_upsert(previous, written, [key], version), outputs.keyed))
    if keyed_table is not None:
        # Two steps, so that a failure while directories are replaced leaves
        # the merged rows to replace them from; no other run may merge between.
        outputs.keyed, merged = keyed_table, f"{out}/_merged"
        if run.ledger.committed("keyed_replace") is None:
            hold_table(spark, keyed_table, run.batch_id)
        sink("keyed_merge", lambda: stage_upsert(spark, keyed_table, written, [key], version, keyed_buckets, merged))
        sink("keyed_replace", lambda: replace_buckets(spark, keyed_table, merged))
        delete_path(spark, merged)
        if held_by(spark, keyed_table) == run.batch_id:
            release_table(spark, keyed_table)
    if publish_to is not None:
        based_on = sink("publish_base", lambda: {"version": current_version(spark, publish_to)})["version"]

        def publish_next() -> dict:
            # An attempt that died after its commit has published already.
            mine = published_by(spark, publish_to, run.batch_id, after=based_on)
            return {"version": mine or publish_version(written, publish_to, based_on=based_on, by=run.batch_id)}

        outputs.published = sink("publish", publish_next)["version"]
    if jdbc:
        sink("jdbc", lambda: write_jdbc(written, **jdbc))
    return outputs


def run_admissions(
    spark: SparkSession,
    input_path: str | Sequence[str],
    output_dir: str,
    batch_id: str | None = None,
    names: Mapping[str, str] | None = ADMISSIONS_HEADERS,
    reject: bool = False,
    csv: bool = True,
    keyed_previous: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    sentinels: Collection[str] | None = None,
    text_maxima: bool | Collection[str] = False,
    rounding: str | None = None,
    types: Mapping[str, str] | None = None,
    keep_stage: bool = False,
    quarantine: bool = False,
    by_name: bool = False,
    **keyed,
) -> RunOutputs:
    """Admissions CSV in, cleaned and scored table out (plus sinks).

    ``keyed_previous``: a Parquet table from an earlier run; the new rows
    are upserted into it by row key (newest batch wins) and written to
    ``<output>/keyed``. ``keyed_table``: a table of ``create_keyed_table``
    (with ``keyed_buckets``) that the rows are upserted into in place; only
    the buckets they touch are rewritten. ``publish_to``: the root of a table
    under one name, of which the rows become the next version
    (``publish_version``). ``jdbc``: keyword arguments of ``write_jdbc``.
    ``quarantine``: lines that do not fit the header go to
    ``<output>/quarantine`` instead of being cut or filled up. ``by_name``:
    the files' headers may differ (``read_csv_by_name``).
    A run that failed can be called again: what it has committed is kept.
    ``sentinels``, ``text_maxima``, ``rounding`` and ``types`` are those of
    the job. ``names=ADMISSIONS_WORKFLOW_HEADERS`` gives that job's column
    order as well. The stage is deleted once every sink is written, unless
    ``keep_stage``.
    """
    warn_of_interpreted_stages(spark)
    run = _Run(spark, output_dir, batch_id)
    header = [resolve(names, c) for c in ADMISSIONS_SOURCE]
    raw, misfits = _input(run, input_path, header, quarantine, by_name)
    job = admissions_etl_reject if reject else admissions_etl
    options = {"text_maxima": text_maxima, "rounding": rounding, "types": types}
    if sentinels is not None:
        options["sentinels"] = tuple(sentinels)
    if reject:
        workflow = names is not None and dict(names) == ADMISSIONS_WORKFLOW_HEADERS
        options["columns"] = ADMISSIONS_WORKFLOW_OUTPUT if workflow else ADMISSIONS_OUTPUT
    # the stage lives with the run's outputs: one directory per run
    written = run.table(lambda stage: job(raw, run.batch_id, names=names, trace=run.trace, staged=stage, **options))
    outputs = _sinks(
        run, written, resolve(names, "row_key"), resolve(names, "etl_batch_id"), csv, keyed_previous, jdbc, **keyed
    )
    outputs.quarantine = _quarantine(run, misfits)
    run.finish(keep_stage)
    return outputs


def run_smart_home(
    spark: SparkSession,
    input_path: str | Sequence[str],
    output_dir: str,
    batch_id: str | None = None,
    names: Mapping[str, str] | None = SMART_HOME_HEADERS,
    window: tuple[str, str] | None = None,
    csv: bool = True,
    keyed_previous: str | None = None,
    jdbc: Mapping[str, str] | None = None,
    raw_copy: bool = False,
    day_col: str | None = None,
    sentinels: Collection[str] | None = None,
    types: Mapping[str, str] | None = None,
    keep_stage: bool = False,
    quarantine: bool = False,
    by_name: bool = False,
    **keyed,
) -> RunOutputs:
    """Smart-home CSV in, cleaned readings with totals and stats out.

    ``day_col``: a date column the input is laid out by (``day=...`` folders
    count as columns); a ``window`` then skips the other days' files. The
    stage is deleted once every sink is written, unless ``keep_stage``.
    The sinks, ``quarantine`` and ``by_name`` are those of ``run_admissions``.

    ``raw_copy``: also write the input as read, stamped with the batch id,
    date and row key, to ``<output>/raw`` (CSV), beside the clean table.
    """
    warn_of_interpreted_stages(spark)
    run = _Run(spark, output_dir, batch_id)
    header = [resolve(names, c) for c in SMART_HOME_SOURCE]
    raw, misfits = _input(run, input_path, header, quarantine, by_name)
    options = {} if sentinels is None else {"sentinels": tuple(sentinels)}
    written = run.table(
        lambda stage: smart_home_etl(
            raw, run.batch_id, names=names, window=window, trace=run.trace, staged=stage, day_col=day_col, types=types,
            **options,
        )
    )
    outputs = _sinks(
        run, written, resolve(names, "row_key"), resolve(names, "etl_batch_id"), csv, keyed_previous, jdbc, **keyed
    )
    if raw_copy:
        stamped = batch_stamp(
            row_key(raw, raw.columns, resolve(names, "row_key")),
            run.batch_id, resolve(names, "etl_batch_id"), resolve(names, "etl_batch_date"),
        )
        outputs.raw = f"{run.out}/raw"
        run.ledger.sink("raw", lambda: publish(stamped, outputs.raw, fmt="csv"))
    outputs.quarantine = _quarantine(run, misfits)
    run.finish(keep_stage)
    return outputs


def jdbc_target(url: str | None, table: str | None) -> dict[str, str] | None:
    """Arguments of ``write_jdbc``; user and password from the environment."""
    if not url:
        return None
    user, password = os.environ.get("JDBC_USER"), os.environ.get("JDBC_PASSWORD")
    return {"url": url, "table": table, "user": user, "password": password}


def main(argv: Sequence[str] | None = None) -> None:
    from sluice.session import build_session

    parser = argparse.ArgumentParser(prog="python -m sluice")
    parser.add_argument("job", choices=["admissions", "admissions_reject", "smart_home"])
    parser.add_argument("--input", required=True, nargs="+")
    parser.add_argument("--output", required=True)
    parser.add_argument("--batch-id", help="of the run; left out, an unfinished run of the output goes on")
    parser.add_argument("--headers", choices=["original", "snake", "workflow"], default="original")
    parser.add_argument("--window", nargs=2, metavar=("FROM", "TO"))
    parser.add_argument("--day-col", help="smart_home: date column the input is laid out by")
    parser.add_argument("--sentinels", nargs="*", help="texts that count as missing")
    parser.add_argument("--text-maxima", nargs="*", choices=["age", "billing"], default=[])
    parser.add_argument("--rounding", choices=["half_up", "half_even", "binary"])
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-table")
    parser.add_argument("--keyed-previous")
    parser.add_argument("--keyed-table", help="upsert into this bucketed table, in place")
    parser.add_argument("--keyed-buckets", type=int, default=64)
    parser.add_argument("--publish-to", help="publish as the next version of the table at this root")
    parser.add_argument("--quarantine", action="store_true", help="keep lines that do not fit the header apart")
    parser.add_argument("--by-name", action="store_true", help="the files' headers may differ")
    parser.add_argument("--no-csv", action="store_true")
    parser.add_argument("--keep-stage", action="store_true")
    parser.add_argument("--raw-copy", action="store_true", help="smart_home: also write the stamped input")
    args = parser.parse_args(argv)
    if bool(args.jdbc_url) != bool(args.jdbc_table):
        parser.error("--jdbc-url and --jdbc-table go together")
    if args.headers == "workflow" and args.job != "admissions_reject":
        parser.error("--headers workflow is for admissions_reject")

    spark = build_session(app_name=f"sluice-{args.job}")
    common = {
        "csv": not args.no_csv, "keyed_previous": args.keyed_previous, "keep_stage": args.keep_stage,
        "keyed_table": args.keyed_table, "keyed_buckets": args.keyed_buckets, "publish_to": args.publish_to,
        "quarantine": args.quarantine, "by_name": args.by_name,
        "sentinels": args.sentinels, "jdbc": jdbc_target(args.jdbc_url, args.jdbc_table),
    }
    if args.job == "smart_home":
        outputs = run_smart_home(
            spark, args.input, args.output, args.batch_id,
            names=SMART_HOME_HEADERS if args.headers == "original" else None,
            window=tuple(args.window) if args.window else None, day_col=args.day_col,
            raw_copy=args.raw_copy, **common,
        )
    else:
        headers = {"original": ADMISSIONS_HEADERS, "workflow": ADMISSIONS_WORKFLOW_HEADERS}
        outputs = run_admissions(
            spark, args.input, args.output, args.batch_id, names=headers.get(args.headers),
            reject=args.job == "admissions_reject", text_maxima=args.text_maxima, rounding=args.rounding, **common,
        )
    print(
        f"table={outputs.table} csv={outputs.csv} keyed={outputs.keyed} published={outputs.published} "
        f"quarantine={outputs.quarantine} rows={outputs.counts}"
    )
    spark.stop()


if __name__ == "__main__":
    main()
