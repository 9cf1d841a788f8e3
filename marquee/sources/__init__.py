"""Sources and sinks: driver tables, CSV/Parquet zones, external tables and views."""
