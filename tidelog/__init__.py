"""Versioned reference data as Spark jobs: compare, log, apply, relate, check, publish."""
