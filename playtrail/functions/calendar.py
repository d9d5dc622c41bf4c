"""Calendar expressions over an epoch-millisecond column.

Everything follows `spark.sql.session.timeZone`, so days, hours and formatted
text never disagree with each other.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time(ts: str = "ts") -> Column:
    return F.timestamp_millis(F.col(ts))


def event_day(ts: str = "ts") -> Column:
    return F.to_date(event_time(ts))


def clock_text(ts: str) -> Column:
    """The moment as text, to the second."""
    return F.date_format(event_time(ts), "yyyy-MM-dd HH:mm:ss")


def calendar_parts(ts: str = "ts") -> dict[str, Column]:
    """Year, month, day of month and hour as ints."""
    moment = event_time(ts)
    return {
        "year": F.year(moment),
        "month": F.month(moment),
        "day": F.dayofmonth(moment),
        "hour": F.hour(moment),
    }
