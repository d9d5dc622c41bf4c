"""Ratios of per-user counts.

A user may have no songs, no earlier week or a single day, so every division
is `try_divide`: null where the divisor is zero or missing, also in ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from playtrail.schema import CHANGES, RATES


def rate_columns(suffix: str = "") -> dict[str, Column]:
    """The ten per-day and per-song rates of one segment."""
    return {
        rate + suffix: F.expr(f"try_divide({counted}{suffix}, {per}{suffix})")
        for rate, (counted, per) in RATES.items()
    }


def intensity() -> Column:
    """Active days per day of membership, in percent; 0 for a one-day user.

    Active days are counted inclusively while the span is a difference, so a
    user active every day is above 100.
    """
    return F.expr("coalesce(try_divide(daysInteracting, durationDays) * 100, 0.0D)")


def change_columns() -> dict[str, Column]:
    """Last week's daily rate over the daily rate of all earlier weeks."""
    return {
        change: F.expr(f"try_divide({rate}LastWeek, {rate}BeforeLastWeek)")
        for change, rate in CHANGES.items()
    }
