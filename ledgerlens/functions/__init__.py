from .text import normalize_null, strip_spaces, numeric_before_unit, leading_number, concat_nullsafe
from .dates import (minute_boundaries, day_bucket, week_of_year_bucket, parse_short_date,
                    weekday_name, month_name, weekday_number)
from .numeric import ratio, truncated_avg, int_div

__all__ = [
    "normalize_null", "strip_spaces", "numeric_before_unit", "leading_number", "concat_nullsafe",
    "minute_boundaries", "day_bucket", "week_of_year_bucket", "parse_short_date",
    "weekday_name", "month_name", "weekday_number", "ratio", "truncated_avg", "int_div",
]
