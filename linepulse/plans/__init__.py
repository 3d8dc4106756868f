"""Plans: compositions of operators into the reference's reports, the
query registry used by ``__spark_entry__`` and the DuckDB oracle SQL."""
