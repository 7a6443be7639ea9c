"""Incremental file movement on Spark: list, filter, copy, verify, archive, account."""
