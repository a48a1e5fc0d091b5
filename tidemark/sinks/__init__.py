"""Landing, incremental writes and control tables on Parquet folders."""
