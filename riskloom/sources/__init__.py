"""Sources and sinks: CSV, Parquet tables, the cohort view."""
