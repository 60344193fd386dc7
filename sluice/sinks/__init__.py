from sluice.sinks.commits import (  # noqa: F401
    PublishConflict,
    RunLedger,
    current_version,
    expire_versions,
    publish_version,
    read_published,
)
from sluice.sinks.files import (  # noqa: F401
    publish,
    stage,
    unquoted_lines,
    write_csv,
    write_jdbc,
    write_once,
    write_unquoted_csv,
)
