"""Sources and sinks: CSV ingestion with quarantine, Parquet, results, and
the adapter that derives claims/patients from the shared test tables."""
