from questlog.functions.casts import lenient_double, lenient_int, strict
from questlog.functions.numeric import exact_sum, money, ratio, round_half_away
from questlog.functions.timing import (
    day_diff,
    minute_floor,
    minute_index,
    second_diff,
)

__all__ = [
    "day_diff",
    "exact_sum",
    "lenient_double",
    "lenient_int",
    "minute_floor",
    "minute_index",
    "money",
    "ratio",
    "round_half_away",
    "second_diff",
    "strict",
]
