"""Whole runs: incremental, full and maintenance."""
