"""sluice — batch ETL and analytics operators on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function built from native
Spark expressions, so plans stay inside Catalyst and whole-stage codegen.
The main entry points are importable from the package itself, e.g.
``from sluice import admissions_etl, read_text_csv, build_session``.
"""

__version__ = "0.1.0"

_EXPORTS = {
    "build_session": "sluice.session",
    "sizing_for": "sluice.session",
    "read_text_csv": "sluice.sources.csv",
    "read_checked_csv": "sluice.sources.csv",
    "read_csv_by_name": "sluice.sources.csv",
    "admissions_etl": "sluice.plans.admissions",
    "admissions_etl_reject": "sluice.plans.admissions",
    "smart_home_etl": "sluice.plans.smart_home",
    "run_admissions": "sluice.plans.runs",
    "run_smart_home": "sluice.plans.runs",
    "run_incremental": "sluice.streaming.incremental",
    "smart_home_folded": "sluice.streaming.incremental",
    "admissions_folded": "sluice.streaming.incremental",
    "keyed_upsert": "sluice.operators.upsert",
    "merge_into": "sluice.operators.bucketed",
    "publish": "sluice.sinks.files",
    "publish_version": "sluice.sinks.commits",
    "read_published": "sluice.sinks.commits",
    "stage": "sluice.sinks.files",
}

__all__ = sorted(_EXPORTS)


def __getattr__(name):  # imported on first use, so ``import sluice`` stays light
    if name in _EXPORTS:
        import importlib

        return getattr(importlib.import_module(_EXPORTS[name]), name)
    raise AttributeError(f"module 'sluice' has no attribute {name!r}")
