"""Batch retail analytics as PySpark jobs: landing, quality checks, dimensions, facts and marts."""
