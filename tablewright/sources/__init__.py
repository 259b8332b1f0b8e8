"""Reading raw tables and writing results."""

from tablewright.sources.readers import (
    harvest_csv,
    read_csv,
    read_json_array,
    read_json_array_parts,
    read_parquet_table,
    read_raw_table,
    read_raw_tables,
    read_relational,
    read_table,
    register_views,
    show_raw_tables,
)
from tablewright.sources.sinks import (
    WriteResult,
    clean_numbers,
    publish,
    write_csv,
    write_json,
    write_json_array,
    write_parquet,
    write_relational,
    write_xml,
)
from tablewright.sources.snapshots import Snapshots
from tablewright.sources.xml import parse_xml_column, read_xml

__all__ = [name for name in dir() if not name.startswith("_")]
