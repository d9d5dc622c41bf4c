"""Column expressions, all JVM-side: calendar, page flags, rates."""

from playtrail.functions.calendar import calendar_parts, clock_text, event_day, event_time
from playtrail.functions.flags import flag_columns, flag_sum, page_flag, paid_flag
from playtrail.functions.rates import change_columns, intensity, rate_columns

__all__ = [
    "calendar_parts",
    "change_columns",
    "clock_text",
    "event_day",
    "event_time",
    "flag_columns",
    "flag_sum",
    "intensity",
    "page_flag",
    "paid_flag",
    "rate_columns",
]
