"""Readers, writers and generators of ledger data."""
