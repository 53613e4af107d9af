"""Column helpers built from Spark SQL functions only."""

from martwright.functions.dates import (
    at_day,
    datetime_of,
    from_ms,
    iso_week,
    local_time,
    now_ms,
    previous_month_of,
    time_of,
)
from martwright.functions.geo import EARTH_RADIUS_KM, haversine_km, parse_decimal_comma
from martwright.functions.keys import OID_NAMESPACE, hash_key, uuid3, uuid3_each
from martwright.functions.money import (
    PAY_TIERS,
    courier_pay,
    delay_days,
    profit,
    rounded_ratio,
    signed_amount,
    tax,
    to_base,
    whole_days,
)
from martwright.functions.text import default, fill_blank, flag, json_field, split_part

__all__ = [
    "EARTH_RADIUS_KM",
    "OID_NAMESPACE",
    "PAY_TIERS",
    "at_day",
    "courier_pay",
    "datetime_of",
    "from_ms",
    "default",
    "delay_days",
    "fill_blank",
    "flag",
    "hash_key",
    "haversine_km",
    "iso_week",
    "json_field",
    "local_time",
    "now_ms",
    "parse_decimal_comma",
    "previous_month_of",
    "profit",
    "rounded_ratio",
    "signed_amount",
    "split_part",
    "tax",
    "time_of",
    "to_base",
    "uuid3",
    "uuid3_each",
    "whole_days",
]
