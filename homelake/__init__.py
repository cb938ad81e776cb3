"""Property-listing analytics as PySpark jobs: bronze records, silver tables, gold aggregates and features."""

__version__ = "0.1.0"
