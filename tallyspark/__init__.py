"""Ledger analytics as Spark DataFrame functions."""
