"""Sources and sinks: landed JSON pages, catalogue tables and their releases,
driver-table fixtures."""

from strata.sources.fixtures import DriverTables
from strata.sources.pages import (
    FAULTS,
    PageSplit,
    faulty_pages,
    ingest_dictionary,
    ingest_films,
    read_landed_pages,
    sort_films,
    split_bad_pages,
)
from strata.sources.releases import (
    Draft,
    Release,
    Version,
    audit,
    current_release,
    expire,
    point_table,
    read_released,
    sync_catalogue,
)
from strata.sources.tables import (
    ensure_database,
    qualified,
    read_parquet_table,
    read_table,
    write_table,
)

__all__ = [
    "FAULTS",
    "Draft",
    "DriverTables",
    "PageSplit",
    "Release",
    "Version",
    "audit",
    "current_release",
    "ensure_database",
    "expire",
    "faulty_pages",
    "ingest_dictionary",
    "ingest_films",
    "point_table",
    "qualified",
    "read_landed_pages",
    "read_parquet_table",
    "read_released",
    "read_table",
    "sort_films",
    "split_bad_pages",
    "sync_catalogue",
    "write_table",
]
