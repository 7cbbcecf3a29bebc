"""Scalar Column helpers."""

from dayledger.functions.jsonfn import (json_has_key, json_keys, json_strip_keys, json_text,
                                        json_type)
from dayledger.functions.keys import (event_key, hmac_sha256_hex, key_text, surrogate_key,
                                      surrogate_key_of)
from dayledger.functions.timeutil import (age_band, age_years, birth_year_from_yymmdd,
                                          date_series, day_name, days_between, epoch_seconds,
                                          iso_day_of_week, local_date, local_timestamp,
                                          month_end, month_label, month_name, parse_ymd,
                                          trunc_date, whole_months)

__all__ = [
    "age_band", "age_years", "birth_year_from_yymmdd", "date_series", "day_name",
    "days_between", "epoch_seconds", "event_key", "hmac_sha256_hex", "iso_day_of_week",
    "json_has_key", "json_keys", "json_strip_keys", "json_text", "json_type", "key_text",
    "local_date", "local_timestamp", "month_end", "month_label", "month_name", "parse_ymd",
    "surrogate_key", "surrogate_key_of", "trunc_date", "whole_months",
]
