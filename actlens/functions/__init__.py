from actlens.functions import labels
from actlens.functions.exprs import (
    count_of, epoch_micros, exact_pct, exact_ratio, floor_div, half_even_div, half_up_div, parse_timestamp_ntz,
    time_text,
)

__all__ = [
    "labels", "count_of", "epoch_micros", "exact_pct", "exact_ratio", "floor_div", "half_even_div",
    "half_up_div", "parse_timestamp_ntz", "time_text",
]
