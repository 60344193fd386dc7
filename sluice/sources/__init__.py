from sluice.sources.csv import (  # noqa: F401
    file_headers,
    fitting_rows,
    misfit_lines,
    read_checked_csv,
    read_csv_by_name,
    read_text_csv,
    text_schema,
)
from sluice.sources.fixtures import admissions_raw, smart_home_raw  # noqa: F401
from sluice.sources.tables import read_table, table_path  # noqa: F401
