"""Writers: partitioned lake tables, KPI folders, text and CSV files."""
