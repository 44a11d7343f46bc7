"""Readers and sinks: raw vendor files, registry files, Parquet datasets."""
