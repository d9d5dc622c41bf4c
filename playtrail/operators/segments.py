"""The two slices of each user's own history.

Both compare whole days: an event belongs to the last week when its day is
after `weekBeforeEndDate`, to the time before when its day is earlier, and to
neither on the day itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.functions import event_day


def last_week(events: DataFrame) -> DataFrame:
    """Events of the last seven days; `events` carries `weekBeforeEndDate`."""
    return events.where(event_day() > F.col("weekBeforeEndDate"))


def before_last_week(events: DataFrame) -> DataFrame:
    """Events before the last week; `events` carries `weekBeforeEndDate`."""
    return events.where(event_day() < F.col("weekBeforeEndDate"))


SEGMENT_FILTERS = {
    "all": lambda events: events,
    "last_week": last_week,
    "before_last_week": before_last_week,
}
