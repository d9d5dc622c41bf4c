"""Cleaning and projection of the raw log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.schema import ACTIVITY_COLUMNS


def clean_activity(log: DataFrame) -> DataFrame:
    """Events of known users in known sessions at known times.

    One conjunction over bare columns, so all of it reaches a Parquet scan. An
    event without a time belongs to no day and is dropped as well.
    """
    known = (
        (F.col("userId") != "")
        & F.col("userId").isNotNull()
        & F.col("sessionId").isNotNull()
        & F.col("ts").isNotNull()
    )
    return log.where(known).select(*ACTIVITY_COLUMNS)


# The columns of the preview.
PREVIEW_COLUMNS = ["level", "status", "itemInSession", "userAgent", "page", "sessionId", "length"]


def preview(activity: DataFrame, n: int = 10) -> DataFrame:
    """The first n events in time order, in the columns one looks at first.

    Ordered by every column it shows, so that the same events come out each time.
    """
    order = ["ts", "userId", *PREVIEW_COLUMNS]
    return activity.orderBy(*order).limit(n).select(*PREVIEW_COLUMNS)
