"""Putting per-user values back on every event.

A window over `userId` would sort all events of one user in one task, however
many there are. Here per-user values are aggregated, which combines on the map
side, and then joined back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_per_user(events: DataFrame, *tables: DataFrame, spread: bool = True) -> DataFrame:
    """Left join of tables with one row per user onto the events of that user.

    Several tables are joined with each other first, one row per user, so that
    the events are shuffled once however many there are. Events without a user get
    nulls, and a row without a user in a table is attached to nothing.

    Adaptive execution splits a hot user's events over many tasks, but only
    where both sides are shuffled for this very join. A user table usually comes
    out of an aggregation by `userId`, and the events perhaps out of another
    such join, and Spark would reuse their partitioning. So the join also
    matches on a hash of the user and of what is attached, which makes it
    shuffle on its own. If the user side turns out small enough, Spark
    broadcasts it instead, by its own size check.

    `spread=False` is for a log in buckets of users (`write_bucketed`) without a
    user that holds a large share of it: the join is on the user alone, inside the
    buckets, and events are not shuffled.
    """
    known = [table.where(F.col("userId").isNotNull()) for table in tables]
    users = reduce(lambda left, right: left.join(right, "userId", "full"), known)
    if not spread:
        return events.join(users, "userId", "left").select(*events.columns, *users.drop("userId").columns)
    attached = F.lit(",".join(users.columns))
    user_hash = {"userHash": F.xxhash64("userId", attached)}
    return (
        events.withColumns(user_hash)
        .join(users.withColumns(user_hash), ["userHash", "userId"], "left")
        .drop("userHash")
    )
