"""Queries composed from the operators: gold tables, risk signals, reports, daily run."""
