from sparkdesk.sources.files import (read_parquet, read_csv_typed, read_csv_prefix, read_lines,
                                     read_orc, read_pages, read_day, PAGE_SCHEMA, LOCATION_SCHEMA)
from sparkdesk.sources.tables import DRIVER_TABLES, table

__all__ = ["read_parquet", "read_csv_typed", "read_csv_prefix", "read_lines", "read_orc",
           "read_pages", "read_day", "PAGE_SCHEMA", "LOCATION_SCHEMA", "DRIVER_TABLES", "table"]
