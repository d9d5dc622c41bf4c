"""Stored forms of the log: days of the roll-up, buckets of users, bitmaps of days."""

from __future__ import annotations

import random
from datetime import date, timedelta
from pathlib import Path

import pytest
from logs import DAY_MS, at, event, log, random_log
from pyspark.sql import functions as F

from playtrail.operators import (
    attach_per_user,
    clean_activity,
    enrich_activity,
    user_activity,
    user_day_rollup,
)
from playtrail.operators.distinct import day_bitmaps, number_users, users_in_spans
from playtrail.plans import user_features, user_measures
from playtrail.schema import RATES
from playtrail.sources import write_bucketed
from playtrail.sources.rollup_store import days_of, read_rollup, refresh_days, write_rollup


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def files(path):
    """Each data file with its time of writing."""
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("part-*")}


def of_day(found, day):
    return {p: t for p, t in found.items() if f"day={day}" in p}


def features_of(spark, path):
    return rows_of(user_features(user_activity(read_rollup(spark, path))))


def test_a_new_day_and_late_events_rewrite_only_their_days(spark, tmp_path):
    path = str(tmp_path / "rollup")
    whole = clean_activity(random_log(spark, 3)).cache()
    days = days_of(whole)
    last, old = days[-1], days[2]
    day = F.to_date(F.timestamp_millis("ts"))
    late = (day == F.lit(old)) & (F.pmod(F.xxhash64("userId"), F.lit(3)) == 0)
    write_rollup(whole.where((day < F.lit(last)) & ~late), path)
    before = files(path)
    assert not of_day(before, last)

    refresh_days(whole, path, [last, old])
    after = files(path)
    assert of_day(after, last)
    assert not of_day(before, old).items() & of_day(after, old).items()
    others = {p for p in before if f"day={old}" not in p}
    assert {p: after[p] for p in others} == {p: before[p] for p in others}
    assert features_of(spark, path) == rows_of(user_features(user_measures(whole)))

    refresh_days(whole, path, [last, old])
    refresh_days(whole, path, [])
    assert features_of(spark, path) == rows_of(user_features(user_measures(whole)))
    assert rows_of(read_rollup(spark, path).select(user_day_rollup(whole).columns)) == rows_of(user_day_rollup(whole))


def test_a_refresh_reads_the_log_within_its_days(spark, tmp_path):
    path, stored = str(tmp_path / "rollup"), str(tmp_path / "log")
    first = at("2024-01-01 00:00:00")
    log(spark, [event(f"u{i}", first + i * DAY_MS + DAY_MS - 1) for i in range(9)]).write.parquet(stored)
    clean = clean_activity(spark.read.parquet(stored))
    write_rollup(clean, path)
    refresh_days(clean, path, [date(2024, 1, 3), date(2024, 1, 9)])
    assert rows_of(read_rollup(spark, path).select("userId", "day")) == [
        (f"u{i}", date(2024, 1, 1) + timedelta(i)) for i in range(9)
    ]


def test_days_follow_the_zone_of_the_session(spark, tmp_path):
    path = str(tmp_path / "rollup")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 25 hours: the clock is set back on that day.
        hours = [at("2024-11-03 04:30:00") + h * 3_600_000 for h in range(25)]
        clean = clean_activity(log(spark, [event("u", ts) for ts in hours]))
        assert days_of(clean) == [date(2024, 11, 3)]
        write_rollup(clean.limit(0), path)
        refresh_days(clean, path, days_of(clean))
        assert [r.events for r in read_rollup(spark, path).collect()] == [25]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_pruned_days_are_not_read(spark, tmp_path):
    path = str(tmp_path / "rollup")
    write_rollup(clean_activity(random_log(spark, 4)), path)
    text = read_rollup(spark, path).where("day = date'2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in text


# --- buckets ----------------------------------------------------------------


@pytest.fixture(scope="module")
def bucketed(spark):
    return write_bucketed(clean_activity(random_log(spark, 8)), "test_activity_by_user", 4)


def plan_of(spark, df):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rates(events):
    return user_activity(user_day_rollup(events)).select("userId", *RATES)


def test_events_in_buckets_are_not_shuffled(spark, bucketed):
    text = plan_of(spark, attach_per_user(bucketed, rates(bucketed), spread=False))
    join = text.index("SortMergeJoin")
    events, users = text[join:].split("HashAggregate", 1)
    assert "Exchange" not in events and "SelectedBucketsCount: 4 out of 4" in events
    # Nor are the users' rows: the roll-up groups inside the buckets.
    assert "Exchange" not in users
    spread = plan_of(spark, attach_per_user(bucketed, rates(bucketed)))
    assert spread.count("Exchange hashpartitioning(userHash") == 2


def test_both_ways_attach_the_same(bucketed):
    assert rows_of(attach_per_user(bucketed, rates(bucketed), spread=False)) == rows_of(
        attach_per_user(bucketed, rates(bucketed))
    )
    assert rows_of(enrich_activity(bucketed, spread=False)) == rows_of(enrich_activity(bucketed))


@pytest.mark.parametrize("spread", [True, False])
def test_no_user_is_attached_to_nobody(spark, spread):
    events = log(spark, [event("a"), event(None), event("b")])
    users = spark.createDataFrame([("a", 1), (None, 7), (None, 8)], "userId string, n int")
    more = spark.createDataFrame([("a", 2), (None, 9)], "userId string, m int")
    found = attach_per_user(events, users, more, spread=spread).select("userId", "n", "m")
    assert rows_of(found) == rows_of(spark.createDataFrame([("a", 1, 2), ("b", None, None), (None, None, None)], found.schema))


# --- bitmaps ----------------------------------------------------------------


def test_numbers_are_dense_and_stay(spark):
    users = spark.createDataFrame([(f"u{i % 70}",) for i in range(200)] + [(None,)], "userId string")
    first = number_users(users)
    assert sorted(r.number for r in first.collect()) == list(range(70))
    more = users.unionByName(spark.createDataFrame([(f"v{i}",) for i in range(5)], "userId string"))
    second = number_users(more, first)
    assert sorted(r.number for r in second.collect()) == list(range(75))
    assert first.join(second, ["userId", "number"]).count() == 70
    assert number_users(users.limit(0)).count() == 0


def test_users_of_any_span(spark):
    rng = random.Random(6)
    first = date(2024, 1, 1)
    rows = [(f"u{rng.randrange(40)}", first + timedelta(rng.choice([0, 1, 2, 5, 9]))) for _ in range(90)]
    rollup = spark.createDataFrame(rows, "userId string, day date")
    # Numbers far apart, so that the bitmaps have several parts.
    numbers = number_users(rollup).withColumn("number", F.col("number") * 20_000 + 32_767)
    spans = [(first + timedelta(a), first + timedelta(b)) for a in range(-2, 11) for b in range(a, 12)]
    found = users_in_spans(day_bitmaps(rollup, numbers), spark.createDataFrame(spans, "first date, last date"))
    want = {(a, b): len({u for u, d in rows if a <= d <= b}) for a, b in spans}
    assert {(r["first"], r["last"]): r.users for r in found.collect()} == want
