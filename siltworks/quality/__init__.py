"""Data-quality checks: each returns a DataFrame of the failing rows."""
