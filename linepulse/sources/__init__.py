"""Table sources: parquet scans with schema checks, literal rows, adapters
over the driver's test data, and versioned table maintenance."""
