from sluice.streaming.incremental import (  # noqa: F401
    FoldedFlow,
    admissions_folded,
    admissions_job,
    csv_file_stream,
    first_time_rows,
    run_incremental,
    smart_home_folded,
    smart_home_job,
)
