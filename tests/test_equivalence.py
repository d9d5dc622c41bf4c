"""Daily sums and windows over single events say the same on random logs."""

from __future__ import annotations

import re

import oracle
import pytest
from logs import log, random_log
from pyspark.sql import functions as F

from playtrail.operators import (
    active_days,
    attach_per_user,
    clean_activity,
    enrich_activity,
    user_totals,
    with_active_days,
    with_calendar,
    with_churned,
    with_flags,
    with_rates,
    with_user_bounds,
    with_user_totals,
)
from playtrail.operators.segments import SEGMENT_FILTERS
from playtrail.plans import user_measures
from playtrail.schema import CHANGES, PAGE_FLAGS, RATES, SEGMENTS, USER_TOTALS

SEEDS = [1, 2, 3]


def windowed_rates(raw, segment: str) -> list[tuple]:
    """Per-user label and rates straight from single events, in SQL windows."""
    spark = raw.sparkSession
    raw.createOrReplaceTempView("raw_log")
    flags = ", ".join(f"int(page <=> '{page}') AS {flag}" for flag, page in PAGE_FLAGS.items())
    condition = {"all": "true", "last_week": "d > lastDay - 7",
                 "before_last_week": "d < lastDay - 7"}[segment]
    sums = ", ".join(f"sum({flag}) OVER u AS {total}" for total, flag in USER_TOTALS.items())
    rates = ", ".join(f"try_divide({a}, {b}) AS {rate}" for rate, (a, b) in RATES.items())
    rows = spark.sql(f"""
        WITH flagged AS (
          SELECT userId, to_date(timestamp_millis(ts)) AS d, {flags} FROM raw_log
        ), bounded AS (
          SELECT *, max(d) OVER u AS lastDay, sum(churn) OVER u AS churned
          FROM flagged WINDOW u AS (PARTITION BY userId)
        ), chosen AS (SELECT * FROM bounded WHERE {condition}),
        days AS (
          SELECT userId, count(*) AS daysInteracting
          FROM (SELECT DISTINCT userId, d FROM chosen) GROUP BY userId
        ), summed AS (
          SELECT userId, churned, {sums} FROM chosen WINDOW u AS (PARTITION BY userId)
        )
        SELECT DISTINCT userId, churned, {rates} FROM summed JOIN days USING (userId)
    """).collect()
    return sorted((tuple(r) for r in rows), key=str)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("segment", SEGMENTS)
def test_rollup_equals_windows(spark, seed, segment):
    raw = random_log(spark, seed).cache()
    suffix = SEGMENTS[segment]
    users = user_measures(raw).where(F.col("daysInteracting" + suffix) > 0)
    rows = users.select("userId", "churned", *[r + suffix for r in RATES]).collect()
    assert rows
    assert sorted((tuple(r) for r in rows), key=str) == windowed_rates(raw, segment)


@pytest.mark.parametrize("segment", SEGMENTS)
def test_single_operators_chain_to_the_combined_one(spark, segment):
    cleaned = clean_activity(random_log(spark, 4)).cache()
    bounded = with_churned(with_user_bounds(with_flags(with_calendar(cleaned))))
    chosen = SEGMENT_FILTERS[segment](bounded)
    chained = with_rates(with_active_days(with_user_totals(chosen)))
    combined = enrich_activity(cleaned, segment)
    shared = chained.columns
    more = {"intensityOfInteraction", *CHANGES}
    more |= {rate + side for rate in CHANGES.values() for side in ("LastWeek", "BeforeLastWeek")}
    extra = more if segment == "all" else set()
    assert set(combined.columns) - set(chained.columns) == extra
    left = oracle.sorted_rows(shared, [tuple(r) for r in chained.select(shared).collect()])
    right = oracle.sorted_rows(shared, [tuple(r) for r in combined.select(shared).collect()])
    assert left == right


def test_hot_user_is_split(spark, tmp_path):
    """A third of all rows are of one user; the join cuts up that partition."""
    path = str(tmp_path / "skewed")
    user = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    spark.range(0, 300_000, numPartitions=16).select(
        user.cast("string").alias("userId"), F.xxhash64("id").alias("ts")
    ).write.parquet(path)
    events = spark.read.parquet(path)
    users = events.groupBy("userId").agg(F.count(F.lit(1)).alias("n"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = attach_per_user(events, users)
        rows = joined.groupBy("userId", "n").count()
        assert rows.where("n <> count").count() == 0
        assert joined.agg(F.count("n")).first()[0] == 300_000
        again = attach_per_user(joined, users.withColumnRenamed("n", "m"))
        for frame, joins in ((joined, 1), (again, 2)):
            frame.toArrow()
            text = frame._jdf.queryExecution().executedPlan().toString()
            assert text.split("== Initial Plan ==")[0].count("SortMergeJoin(skew=true)") == joins
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_tables_attached_together_shuffle_events_once(spark, tmp_path):
    path = str(tmp_path / "log")
    random_log(spark, 8).write.parquet(path)
    cleaned = clean_activity(spark.read.parquet(path))
    one_by_one = with_active_days(with_user_totals(cleaned))
    together = attach_per_user(cleaned, user_totals(cleaned), active_days(cleaned))
    assert together.columns == one_by_one.columns
    assert sorted(map(str, together.collect())) == sorted(map(str, one_by_one.collect()))


def test_chained_operators_need_one_scan_each(spark, tmp_path):
    path = str(tmp_path / "log")
    random_log(spark, 7).write.parquet(path)
    cleaned = clean_activity(spark.read.parquet(path))
    chained = with_rates(with_active_days(with_user_totals(with_user_bounds(cleaned))))
    text = chained._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("FileScan", text)) == 4
    assert len(re.findall("Join ", text)) == 3


def test_copies_of_one_event_are_kept(spark):
    raw = random_log(spark, 6)
    doubled = log(spark, [tuple(r) for r in raw.collect()] * 2)
    assert enrich_activity(clean_activity(doubled)).count() == 2 * clean_activity(raw).count()
