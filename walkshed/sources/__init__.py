"""Reading and writing: landed API pages, raw CSV, hourly Parquet."""
