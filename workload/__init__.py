"""Queries on the driver tables: inputs derived from them, and the same results in plain SQL."""
