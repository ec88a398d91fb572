"""Composed plans over the driver tables: the stand-in relations, the
registered queries (Spark side) and their DuckDB oracle SQL."""
