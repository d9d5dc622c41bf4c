"""Reading activity logs, and tables written once to be read several times."""

from playtrail.sources.activity import (
    ReadReport,
    missing_columns,
    read_activity,
    rejected_activity,
    require_columns,
    schema_by_file,
    schema_report,
)
from playtrail.sources.bucketed import write_bucketed
from playtrail.sources.shared import (
    load_model,
    materialize,
    new_shared_path,
    save_model,
    shared_folder,
)

__all__ = [
    "ReadReport",
    "load_model",
    "materialize",
    "missing_columns",
    "new_shared_path",
    "read_activity",
    "rejected_activity",
    "require_columns",
    "save_model",
    "schema_by_file",
    "schema_report",
    "shared_folder",
    "write_bucketed",
]
