"""Batch medallion lakehouse on PySpark: bronze snapshots, silver cleaning, gold star schema."""
