"""Small activity logs for tests."""

from __future__ import annotations

import random
from datetime import datetime, timezone

from playtrail.schema import ACTIVITY, ACTIVITY_COLUMNS, PAGE_FLAGS

DAY_MS = 86_400_000


def at(text: str) -> int:
    """Epoch milliseconds of a UTC moment, e.g. '2024-01-05 23:59:59.999'."""
    moment = datetime.fromisoformat(text).replace(tzinfo=timezone.utc)
    return round(moment.timestamp() * 1000)


def event(user="u", ts=0, page="NextSong", level="free", session=1, **more) -> tuple:
    row = {"userId": user, "sessionId": session, "ts": ts, "page": page, "level": level} | more
    return tuple(row.get(name) for name in ACTIVITY_COLUMNS)


def log(spark, rows):
    return spark.createDataFrame(rows, ACTIVITY)


def random_log(spark, seed: int, users: int = 60):
    """A sparse log: users of one event, of one day, of many; hot and idle ones."""
    rng = random.Random(seed)
    pages = [*PAGE_FLAGS.values(), "Home", None, "NextSong", "NextSong"]
    rows = []
    for user in range(users):
        span = rng.choice([1, 2, 7, 8, 9, 15, 30])
        count = rng.choice([1, 2, 5, 20, 200 if user == 0 else 40])
        for _ in range(count):
            edge = rng.choice([0, DAY_MS - 1, rng.randrange(DAY_MS)])
            ts = at("2024-01-01 00:00:00") + rng.randrange(span) * DAY_MS + edge
            level = rng.choice(["paid", "free", None])
            rows.append(event(f"u{user}", ts, rng.choice(pages), level, rng.randrange(3)))
    rng.shuffle(rows)
    return log(spark, rows)
