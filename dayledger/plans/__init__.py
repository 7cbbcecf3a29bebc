"""The modelled warehouse bound to the driver tables, its query registry and\nthe DuckDB oracle SQL."""
