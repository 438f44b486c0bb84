"""DuckDB oracle texts for the registered queries (independent of the
Spark code: plain SQL over the same parquet views)."""
