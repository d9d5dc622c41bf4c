"""The log kept in buckets of users, so that per-user values join without moving events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playtrail.sources.shared import new_shared_path

BUCKETS = 64


def write_bucketed(activity: DataFrame, table: str, buckets: int = BUCKETS) -> DataFrame:
    """Write events as a table of so many buckets by `userId`, and return it.

    The table's files lie in the shared folder, its entry in the session's catalog.
    Every aggregation and join by `userId` alone then runs inside the buckets; the
    one shuffle is here, so that each bucket is one file. A user's events are all in
    one bucket: for a log in which one user holds a large share, `attach_per_user`
    with its default `spread` is the better way, as it splits such a user.
    """
    spark = activity.sparkSession
    (
        activity.repartition(buckets, "userId")
        .write.bucketBy(buckets, "userId")
        .sortBy("userId")
        .option("path", new_shared_path(spark, table))
        .mode("overwrite")
        .saveAsTable(table)
    )
    return spark.table(table)
