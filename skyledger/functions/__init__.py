from skyledger.functions.causes import causes_text, top_causes
from skyledger.functions.flights import (
    anomaly_label,
    clean_code,
    delay_band,
    flag_to_int,
    has_text,
    in_range,
    parse_date,
    percent,
    round2,
)

__all__ = [
    "anomaly_label",
    "causes_text",
    "clean_code",
    "delay_band",
    "flag_to_int",
    "has_text",
    "in_range",
    "parse_date",
    "percent",
    "round2",
    "top_causes",
]
