"""Reports: what pages are used, and how cohorts differ."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.operators.rollup import user_day_rollup
from playtrail.schema import segment_suffix


def _page_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("page").agg(F.count(F.lit(1)).alias("n"))


def most_used_first(pages: DataFrame) -> DataFrame:
    return pages.orderBy(F.desc("n"), F.asc("page"))


def page_frequency(log: DataFrame) -> DataFrame:
    """Events per page of the raw log, most used first; a null page is a page."""
    return most_used_first(_page_counts(log))


def top_pages(log: DataFrame, k: int = 50) -> DataFrame:
    return page_frequency(log).limit(k)


def page_share(log: DataFrame, exclude: str | None = None) -> DataFrame:
    """Page counts with the grand total and each page's percentage of it.

    Shares stay shares of all events when a page is excluded. The total is a
    scalar subquery over the page counts, so no task has to see all pages.
    """
    counts = _page_counts(log)
    shares = counts.withColumn("total", counts.agg(F.sum("n")).scalar()).withColumn(
        "count_percentage", F.try_divide(F.col("n"), F.col("total")) * 100
    )
    if exclude is not None:
        shares = without_page(shares, exclude)
    return most_used_first(shares)


def without_page(pages: DataFrame, page: str) -> DataFrame:
    """A page report without one page; a null page is not taken for it."""
    return pages.where(~F.col("page").eqNullSafe(page))


def activity_counts(activity: DataFrame) -> DataFrame:
    """Number of events, of users, and of calendar days with any event.

    Users and days are each grouped from the same (user, day) rows, so one
    shuffle of those serves both, and no distinct count multiplies them.
    """
    rollup = user_day_rollup(activity)
    users = rollup.groupBy("userId").agg(F.sum("events").alias("n"))
    # The sum keeps both branches on the same columns of the roll-up.
    days = rollup.groupBy("day").agg(F.sum("events").alias("n")).where(F.col("n") > 0)
    return users.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"), F.count("userId").alias("users")
    ).withColumn("calendarDays", days.agg(F.count("day")).scalar())


def cohort_profile(users: DataFrame, metrics: list[str], segment: str = "all") -> DataFrame:
    """Average of each metric by number of cancellations.

    Takes unfilled measures: a user without a value (no songs, say) does not
    count as 0, and one without any event in the segment does not count at all.
    """
    suffix = segment_suffix(segment)
    return (
        users.where(F.col("daysInteracting" + suffix) > 0)
        .groupBy("churned")
        .agg(*[F.avg(metric + suffix).alias("avg_" + metric) for metric in metrics])
    )
