"""Sources and sinks: raw CSV ingest, audit column, table layout, writes."""

from strata.sources.layout import Layout, write_observed
from strata.sources.ingest import (all_string_schema, read_raw_csv, with_audit,
                                   land, copy_tables, inline_table)

__all__ = ["Layout", "write_observed", "all_string_schema", "read_raw_csv",
           "with_audit", "land", "copy_tables", "inline_table"]
