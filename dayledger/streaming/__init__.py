"""Structured Streaming forms of the late-data operators."""

from dayledger.streaming.late_data import (daily_local_aggregate, daily_table, latest_per_key,
                                           payload_multiplicity, run_available_now,
                                           run_into_table, streamed_daily_aggregate,
                                           streamed_payload_multiplicity, table_stream)

__all__ = ["daily_local_aggregate", "daily_table", "latest_per_key", "payload_multiplicity",
           "run_available_now", "run_into_table", "streamed_daily_aggregate", "streamed_payload_multiplicity",
           "table_stream"]
