"""The (user, day) roll-up kept as a table, one partition per day.

Days are the unit of writing: a refresh computes the days it is told of from the
log and replaces just their partitions, in one job. Refreshing a day twice leaves
what refreshing it once does, so a job that is run again does no harm, and an
event that comes late for an old day is taken in by naming that day. Features of
all users then come from the stored days, and the log's old events are never read.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playtrail.functions import event_day
from playtrail.operators.rollup import user_day_rollup
from playtrail.schema import PAGE_FLAGS

ROLLUP = T.StructType(
    [
        T.StructField("userId", T.StringType()),
        *(T.StructField(name, T.LongType()) for name in ("events", "firstTs", "lastTs", *PAGE_FLAGS)),
        T.StructField("day", T.DateType()),
    ]
)


def days_of(activity: DataFrame) -> list[date]:
    """The calendar days that events of a batch fall on, late ones included; few by nature."""
    return sorted(r.day for r in activity.select(event_day().alias("day")).distinct().collect())


def _of_days(activity: DataFrame, days: list[date]) -> DataFrame:
    """Events of those days; bounds on the bare time reach a Parquet scan."""
    first, last = min(days), max(days)
    low, high = (F.unix_millis(F.lit(d).cast("timestamp")) for d in (first, last))
    # A day of a zone with daylight saving may have 25 hours.
    near = (F.col("ts") >= low) & (F.col("ts") < high + 25 * 3_600_000)
    return activity.where(near & event_day().isin(days))


def write_rollup(activity: DataFrame, path: str) -> None:
    """The roll-up of a whole cleaned log, in place of whatever is stored."""
    _write(user_day_rollup(activity), path, "static")


def refresh_days(activity: DataFrame, path: str, days: Iterable[date]) -> None:
    """Compute those days anew from the cleaned log and replace their partitions.

    Other days are not touched, nor read. A log grows: a named day without any event
    in it keeps what is stored.
    """
    days = sorted(set(days))
    if not days:
        return
    _write(user_day_rollup(_of_days(activity, days)), path, "dynamic")


def _write(rollup: DataFrame, path: str, mode: str) -> None:
    # One shuffle by day and user hash: a day of very many users is written by several tasks.
    spread = F.pmod(F.xxhash64("userId"), F.lit(8))
    (
        rollup.select(*ROLLUP.fieldNames())
        .repartition("day", spread)
        .write.partitionBy("day")
        .option("partitionOverwriteMode", mode)
        .mode("overwrite")
        .parquet(path)
    )


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROLLUP).parquet(path)
