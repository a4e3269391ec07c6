"""Reading and writing tables."""

from quaymart.sources.footers import read_footers, schema_report
from quaymart.sources.publish import (
    conform,
    load_table,
    publish,
    publish_table,
    register_tables,
    table_folders,
)
from quaymart.sources.readers import (
    UnreadableRows,
    covers,
    land,
    monthly_paths,
    read_batches,
    read_csv,
    read_csv_checked,
    read_lookup,
    read_parquet,
)
from quaymart.sources.staging import remove_folder, remove_staging, staging_path
from quaymart.sources.versions import (
    Part,
    Version,
    commit,
    find_version,
    load_parts,
    new_folder,
    remove_old_versions,
    written_parts,
)

__all__ = [
    "Part",
    "UnreadableRows",
    "Version",
    "commit",
    "conform",
    "covers",
    "find_version",
    "land",
    "load_parts",
    "load_table",
    "monthly_paths",
    "new_folder",
    "publish",
    "publish_table",
    "read_batches",
    "read_csv",
    "read_csv_checked",
    "read_footers",
    "read_lookup",
    "read_parquet",
    "register_tables",
    "remove_folder",
    "remove_old_versions",
    "remove_staging",
    "schema_report",
    "staging_path",
    "table_folders",
    "written_parts",
]
