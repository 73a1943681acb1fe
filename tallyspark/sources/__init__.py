"""Readers and writers of ledger tables."""
