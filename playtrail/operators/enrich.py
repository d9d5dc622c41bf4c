"""Event-grain columns: each `with_` operator returns all given events with
columns added.

`user_bounds`, `user_totals` and `active_days` describe the users of the events
they are given, so applied to a segment they describe that segment. Each
`with_user_bounds` and the like shuffles the events once to attach its columns;
to attach several, pass the tables to `attach_per_user` together. And
`enrich_activity` gives everything at once from a single roll-up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.functions import (
    calendar_parts,
    clock_text,
    event_day,
    flag_columns,
    flag_sum,
    rate_columns,
)
from playtrail.operators.per_user import attach_per_user
from playtrail.operators.rollup import active_days, user_activity, user_day_rollup
from playtrail.operators.segments import SEGMENT_FILTERS
from playtrail.schema import CHANGES, LOOKBACKS, RATES, USER_TOTALS, segment_suffix


def with_calendar(events: DataFrame) -> DataFrame:
    return events.withColumns(calendar_parts())


def with_flags(events: DataFrame) -> DataFrame:
    """Page and level flags, and whether a cancelling user was paying."""
    flagged = events.withColumns(flag_columns())
    lost_payer = (F.col("churn") == 1) & (F.col("payingUser") == 1)
    return flagged.withColumn("paying_when_churned", F.when(lost_payer, 1).otherwise(0))


def _bounds_columns() -> dict[str, Column]:
    last_day = event_day("lastTs")
    bounds = {
        "endDate": clock_text("lastTs"),
        "startDate": clock_text("firstTs"),
        "durationDays": F.date_diff(last_day, event_day("firstTs")),
    }
    return bounds | {name: F.date_add(last_day, -days) for name, days in LOOKBACKS.items()}


def user_bounds(events: DataFrame) -> DataFrame:
    """First and last moment of each user, the days between, look-back dates."""
    users = events.groupBy("userId").agg(F.min("ts").alias("firstTs"), F.max("ts").alias("lastTs"))
    return users.withColumns(_bounds_columns()).drop("firstTs", "lastTs")


def user_totals(events: DataFrame) -> DataFrame:
    """Per-user sums of the page flags, `churned` among them.

    Like the rest, `churned` counts within the given events: a label of the whole
    history is taken before a segment is cut, by `with_churned`.
    """
    totals = {"churned": "churn"} | USER_TOTALS
    return events.groupBy("userId").agg(
        *[flag_sum(flag, total) for total, flag in totals.items()]
    )


def with_user_bounds(events: DataFrame) -> DataFrame:
    return attach_per_user(events, user_bounds(events))


def user_label(events: DataFrame) -> DataFrame:
    """Cancellations of each user within the given events."""
    return events.groupBy("userId").agg(flag_sum("churn", "churned"))


def with_churned(events: DataFrame) -> DataFrame:
    """The label on every event; applied before a segment is cut, it is of the whole history."""
    return attach_per_user(events, user_label(events))


def with_user_totals(events: DataFrame) -> DataFrame:
    """Totals within the events; a label they already carry stays as it is."""
    totals = user_totals(events)
    return attach_per_user(events, totals.drop("churned") if "churned" in events.columns else totals)


def with_active_days(events: DataFrame) -> DataFrame:
    return attach_per_user(events, active_days(events))


def with_rates(events: DataFrame) -> DataFrame:
    """Per-day and per-song rates, given the user's totals and active days."""
    return events.withColumns(rate_columns())


def enrich_activity(activity: DataFrame, segment: str = "all", spread: bool = True) -> DataFrame:
    """Cleaned events of a segment with every derived column.

    Calendar parts, flags, bounds, `churned`, and the user's totals, active
    days and rates within the segment. The whole history also has intensity, and
    the change ratios with the rates of both segments they compare. `spread` is
    that of `attach_per_user`.
    """
    suffix = segment_suffix(segment)
    of_segment = [*USER_TOTALS, "daysInteracting", *RATES]
    kept = ["userId", "churned", *_bounds_columns()]
    if segment == "all":
        kept += ["intensityOfInteraction", *CHANGES]
        kept += [rate + side for rate in CHANGES.values() for side in ("LastWeek", "BeforeLastWeek")]
    users = (
        user_activity(user_day_rollup(activity))
        .withColumns(_bounds_columns())
        .select(*kept, *[F.col(name + suffix).alias(name) for name in of_segment])
    )
    # Calendar and flags are added behind the join to keep them out of its shuffle.
    events = SEGMENT_FILTERS[segment](attach_per_user(activity, users, spread=spread))
    return with_flags(with_calendar(events))
