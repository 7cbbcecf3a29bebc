"""Reads: driver tables, landing reads, seeds and calendars."""

from dayledger.sources.landing import (Window, cohort_filter, exclude_columns, land_columns,
                                       landing_type, lookback, plan_window, read_full,
                                       read_incremental, watermark_expr)
from dayledger.sources.seeds import date_spine, date_spine_between, read_seed, values_df
from dayledger.sources.tables import TABLES, read_table, table_path

__all__ = [
    "TABLES", "Window", "cohort_filter", "date_spine", "date_spine_between",
    "exclude_columns", "land_columns", "landing_type", "lookback", "plan_window",
    "read_full", "read_incremental", "read_seed", "read_table", "table_path",
    "values_df", "watermark_expr",
]
