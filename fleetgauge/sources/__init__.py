"""Readers, writers and folders of Parquet."""
