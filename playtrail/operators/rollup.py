"""From events to one row per user and day, and on to one row per user.

Segments are cut at whole days, so every per-user measure, in every segment,
is a function of daily sums. Events are therefore read once and shrunk to
(user, day) rows before anything is grouped by user alone: a user with a third
of all events is spread over days and combined on the map side first, and
reaches the per-user stage as one row per day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.functions import change_columns, event_day, flag_sum, intensity, rate_columns
from playtrail.schema import LOOKBACKS, PAGE_FLAGS, SEGMENTS, USER_TOTALS

WEEK = LOOKBACKS["weekBeforeEndDate"]

# Which of a user's days a segment takes; `weekBefore` is that user's boundary day.
SEGMENT_DAYS = {
    "all": "",
    "last_week": "FILTER (WHERE day > weekBefore)",
    "before_last_week": "FILTER (WHERE day < weekBefore)",
}


def user_day_rollup(activity: DataFrame) -> DataFrame:
    """Daily sums: event count, first and last moment, one sum per page flag."""
    return activity.groupBy("userId", event_day().alias("day")).agg(
        F.count(F.lit(1)).alias("events"),
        F.min("ts").alias("firstTs"),
        F.max("ts").alias("lastTs"),
        *[flag_sum(flag, flag) for flag in PAGE_FLAGS],
    )


def active_days(activity: DataFrame) -> DataFrame:
    """Number of calendar days on which each user did anything."""
    days = activity.select("userId", event_day().alias("day")).distinct()
    return days.groupBy("userId").agg(F.count(F.lit(1)).alias("daysInteracting"))


def user_activity(rollup: DataFrame) -> DataFrame:
    """One row per user with totals, active days and rates of all three segments.

    Columns of the last week end in `LastWeek`, those of the time before it in
    `BeforeLastWeek`. The day exactly a week before a user's last day counts in
    the whole history only. `churned` is always of the whole history. What a
    query does not select costs nothing: Catalyst drops those aggregates, and
    the window too when no segment is asked for.
    """
    days = rollup.selectExpr(
        "*", f"date_add(max(day) OVER (PARTITION BY userId), -{WEEK}) AS weekBefore"
    )
    measures = [
        "sum(churn) AS churned",
        "min(firstTs) AS firstTs",
        "max(lastTs) AS lastTs",
        "date_diff(max(day), min(day)) AS durationDays",
    ]
    for segment, suffix in SEGMENTS.items():
        chosen = SEGMENT_DAYS[segment]
        measures.append(f"count(*) {chosen} AS daysInteracting{suffix}")
        measures += [
            f"sum({flag}) {chosen} AS {total}{suffix}" for total, flag in USER_TOTALS.items()
        ]
    users = days.groupBy("userId").agg(*[F.expr(measure) for measure in measures])

    rates = {}
    for suffix in SEGMENTS.values():
        rates |= rate_columns(suffix)
    return users.withColumns(rates | {"intensityOfInteraction": intensity()}).withColumns(
        change_columns()
    )
