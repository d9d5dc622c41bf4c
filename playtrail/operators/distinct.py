"""Distinct users of any span of days, exactly, without the log.

Users are numbered densely once. Per day the numbers of its users are kept as
bitmaps, one row per day and range of numbers (32,768 to a bitmap of Spark's own
`bitmap_*` functions). Bitmaps of several days merge by a bitwise or, so the users
of a span are counted from its day rows: a user counts once however many of the
days hold it, and new days are added beside old ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playtrail.sources.shared import materialize

NUMBER_GROUPS = 1024


def number_users(users: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(userId, number) of distinct users: the known ones as they are, new ones from there on.

    Users are numbered inside groups by a hash, and groups by the counts before
    them, so no task sees all users. Written to the shared folder.
    """
    fresh = users.select("userId").where("userId IS NOT NULL").distinct()
    start = F.lit(0).cast("bigint")
    if known is not None:
        fresh = fresh.join(known, "userId", "left_anti")
        start = F.coalesce(known.agg(F.max("number")).scalar() + 1, F.lit(0))
    grouped = fresh.withColumn("group", F.pmod(F.xxhash64("userId"), F.lit(NUMBER_GROUPS)))
    counts = grouped.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(F.lit(0)).orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("group", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("group").orderBy("userId")) - 1
    numbered = (
        grouped.withColumn("place", within)
        .join(offsets, "group")
        .select("userId", (start + F.col("offset") + F.col("place")).cast("bigint").alias("number"))
    )
    if known is not None:
        numbered = known.select("userId", "number").unionByName(numbered)
    return materialize(numbered, "user-numbers")


def day_bitmaps(rollup: DataFrame, numbers: DataFrame) -> DataFrame:
    """(day, part, users): the numbers of each day's users as bitmaps."""
    return (
        rollup.select("userId", "day")
        .join(numbers, "userId")
        .groupBy("day", F.bitmap_bucket_number("number").alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"))
    )


def users_in_spans(bitmaps: DataFrame, spans: DataFrame) -> DataFrame:
    """(first, last, users): distinct users with any day in each span, both ends included.

    `spans` is a small table of (first, last); a span without days has 0 users. A
    span is exploded into its days, so that day rows are found by an equality.
    """
    wanted = spans.select("first", "last").distinct()
    days = wanted.select("first", "last", F.explode(F.sequence("first", "last")).alias("day"))
    parts = (
        days.join(bitmaps, "day")
        .groupBy("first", "last", "part")
        .agg(F.bitmap_count(F.bitmap_or_agg("users")).alias("n"))
    )
    counted = parts.groupBy("first", "last").agg(F.sum("n").alias("n"))
    return wanted.join(counted, ["first", "last"], "left").select(
        "first", "last", F.coalesce("n", F.lit(0)).cast("bigint").alias("users")
    )
