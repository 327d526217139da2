from faremill.functions.codes import base_code, label, payment_label, vendor_label
from faremill.functions.events import json_field, parse_event, to_event
from faremill.functions.keys import row_id, surrogate_key
from faremill.functions.numbers import average, money, pct, safe_cast, total, total_or_zero
from faremill.functions.times import (
    from_epoch_ms,
    hours_between,
    minutes_between,
    month_date,
    naive,
    to_day,
    to_epoch_ms,
    trunc_ts,
)

__all__ = [
    "average", "base_code", "from_epoch_ms", "hours_between", "json_field", "label",
    "minutes_between", "money", "month_date", "naive", "parse_event", "payment_label",
    "pct", "row_id", "safe_cast", "surrogate_key", "to_day", "to_epoch_ms", "to_event",
    "total", "total_or_zero", "trunc_ts", "vendor_label",
]
