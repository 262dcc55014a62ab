from .schemas import SOURCE_SCHEMAS, SOURCE_TABLES
from .readers import (load_tables, publish, read_csv_table, read_jdbc_table,
                      read_parquet_table, write_replace)
from .binding import bind_sources, load_bound_tables

__all__ = ["SOURCE_SCHEMAS", "SOURCE_TABLES", "load_tables", "publish", "read_csv_table",
           "read_jdbc_table", "read_parquet_table", "write_replace", "bind_sources",
           "load_bound_tables"]
