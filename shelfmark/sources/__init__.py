"""Reading and writing: raw CSV files and versioned Parquet tables."""
