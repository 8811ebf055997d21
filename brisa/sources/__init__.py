"""Readers and writers (JSON, CSV, Parquet), time-window scans, run log, model store."""
