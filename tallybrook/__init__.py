"""tallybrook: contract-checked ingest, versioned dedup, daily trends and data quality on PySpark."""
