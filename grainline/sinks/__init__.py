"""Parquet publication, reject tables and the run ledger."""
