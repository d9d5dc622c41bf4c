"""Cases the generated tables do not hold, stated inline."""

from __future__ import annotations

import pytest
from logs import DAY_MS, at, event, log

from playtrail.operators import (
    active_days,
    activity_counts,
    clean_activity,
    cohort_profile,
    enrich_activity,
    page_frequency,
    page_share,
    user_activity,
    user_day_rollup,
    with_calendar,
    with_flags,
    with_user_bounds,
)
from playtrail.operators.model import model_table
from playtrail.plans import user_features, user_measures
from playtrail.schema import MODEL_FEATURES, VOLUME_METRICS

START = at("2024-01-01 12:00:00")


def one_user(spark, rows):
    (row,) = user_measures(log(spark, rows)).collect()
    return row


def test_single_event(spark):
    row = one_user(spark, [event(ts=START)])
    assert (row.durationDays, row.daysInteracting, row.intensityOfInteraction) == (0, 1, 0.0)
    assert row.playlistActivityChange is None
    assert row.listeningActivityChange is None
    (filled,) = user_features(user_measures(log(spark, [event(ts=START)]))).collect()
    assert (filled.playlistActivityChange, filled.listeningActivityChange) == (0.0, 0.0)


def test_only_the_last_week(spark):
    row = one_user(spark, [event(ts=START + day * DAY_MS) for day in range(7)])
    assert row.daysInteractingLastWeek == 7
    assert row.daysInteractingBeforeLastWeek == 0
    assert row.songsListenedPerDayLastWeek == 1.0
    assert row.songsListenedPerDayBeforeLastWeek is None
    assert row.listeningActivityChange is None


@pytest.mark.parametrize("clock", ["00:00:00", "12:00:00", "23:59:59.999"])
def test_boundary_day_is_in_neither_segment(spark, clock):
    rows = [
        event(ts=at("2024-01-10 06:00:00")),
        event(ts=at(f"2024-01-03 {clock}")),
        event(ts=at("2024-01-02 06:00:00")),
    ]
    row = one_user(spark, rows)
    assert row.daysInteracting == 3
    assert row.daysInteractingLastWeek == 1
    assert row.daysInteractingBeforeLastWeek == 1
    cleaned = clean_activity(log(spark, rows))
    assert enrich_activity(cleaned).count() == 3
    assert [r.ts for r in enrich_activity(cleaned, "last_week").collect()] == [rows[0][2]]
    assert [r.ts for r in enrich_activity(cleaned, "before_last_week").collect()] == [rows[2][2]]


def test_no_songs(spark):
    rows = [event(ts=START, page="Thumbs Down"), event("v", START, "Thumbs Down"),
            event("v", START + 1)]
    users = user_measures(log(spark, rows)).cache()
    row = users.where("userId = 'u'").first()
    assert (row.DownVotedPerSong, row.UpVotedPerSong, row.rolledAdvertsPerSong) == (None,) * 3
    # The user without songs does not pull the average down ...
    (cohort,) = cohort_profile(users, ["DownVotedPerSong"]).collect()
    assert cohort.avg_DownVotedPerSong == 1.0
    # ... but counts as 0 for the models.
    filled = {r.userId: r.DownVotedPerSong for r in user_features(users).collect()}
    assert filled == {"u": 0.0, "v": 1.0}


def test_no_playlist_adds_before_the_last_week(spark):
    rows = [event(ts=START), event(ts=START + 20 * DAY_MS, page="Add to Playlist")]
    row = one_user(spark, rows)
    assert row.songsAddedToPlaylistPerDayBeforeLastWeek == 0.0
    assert row.playlistActivityChange is None
    assert row.listeningActivityChange == 0.0


def test_two_cancellations(spark):
    rows = [event(ts=START + i, page="Cancellation Confirmation") for i in range(2)]
    users = user_measures(log(spark, rows))
    assert users.first().churned == 2
    assert model_table(user_features(users)).first().label == 1.0


def test_label_covers_the_whole_history(spark):
    rows = [event(ts=START, page="Cancellation Confirmation"), event(ts=START + 20 * DAY_MS)]
    cleaned = clean_activity(log(spark, rows))
    for segment in ("all", "last_week", "before_last_week"):
        assert {r.churned for r in enrich_activity(cleaned, segment).collect()} == {1}


def test_null_page_and_level_set_no_flag(spark):
    (row,) = with_flags(log(spark, [event(page=None, level=None)])).collect()
    assert (row.churn, row.listeningSongs, row.payingUser, row.paying_when_churned) == (0, 0, 0, 0)


def test_paying_when_churned(spark):
    rows = [event(ts=i, page=page, level=level) for i, (page, level) in enumerate(
        [("Cancellation Confirmation", "paid"), ("Cancellation Confirmation", "free"),
         ("NextSong", "paid")])]
    flags = {r.ts: r.paying_when_churned for r in with_flags(log(spark, rows)).collect()}
    assert flags == {0: 1, 1: 0, 2: 0}


def test_cleaning_drops_unknown_rows_that_page_counts_keep(spark):
    rows = [
        event(ts=1),
        event(user="", ts=1),
        event(user=None, ts=1),
        event(session=None, ts=1),
        event(ts=None),
        event(ts=1, page=None),
    ]
    raw = log(spark, rows)
    assert clean_activity(raw).count() == 2
    assert [(r.page, r.n) for r in page_frequency(raw).collect()] == [("NextSong", 5), (None, 1)]


def test_null_page_survives_the_exclusion_of_another(spark):
    raw = log(spark, [event(), event(), event(), event(page=None)])
    assert [tuple(r) for r in page_share(raw, exclude="NextSong").collect()] == [(None, 1, 4, 25.0)]


def test_tied_pages_come_by_name(spark):
    raw = log(spark, [event(page=p) for p in ("b", "a", "c", "c", None)])
    assert [r.page for r in page_frequency(raw).collect()] == ["c", None, "a", "b"]


def test_midnight_separates_days(spark):
    rows = [event(ts=at("2024-01-01 23:59:59.999")), event(ts=at("2024-01-02 00:00:00"))]
    row = one_user(spark, rows)
    assert (row.daysInteracting, row.durationDays, row.intensityOfInteraction) == (2, 1, 200.0)
    parts = [(r.day, r.hour) for r in with_calendar(log(spark, rows)).orderBy("ts").collect()]
    assert parts == [(1, 23), (2, 0)]


def test_active_every_day_is_above_a_hundred(spark):
    row = one_user(spark, [event(ts=START + day * DAY_MS) for day in range(10)])
    assert row.intensityOfInteraction == 10 / 9 * 100


def test_bounds_and_lookbacks(spark):
    rows = [event(ts=at("2024-02-01 10:00:00.999")), event(ts=at("2024-03-01 09:08:07"))]
    row = with_user_bounds(log(spark, rows)).first()
    assert (row.startDate, row.endDate) == ("2024-02-01 10:00:00", "2024-03-01 09:08:07")
    assert row.durationDays == 29
    assert str(row.weekBeforeEndDate) == "2024-02-23"
    assert str(row.fourweekBeforeEndDate) == "2024-02-02"


def test_days_follow_the_session_zone(spark):
    rows = [event(ts=at("2024-01-01 23:30:00")), event(ts=at("2024-01-02 00:30:00"))]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert active_days(log(spark, rows)).first().daysInteracting == 1
        assert with_calendar(log(spark, rows)).first().hour == 8
        assert with_user_bounds(log(spark, rows)).first().startDate == "2024-01-02 08:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_cohort_without_events_in_a_segment_is_absent(spark):
    rows = [event("gone", START, "Cancellation Confirmation"),
            event("here", START), event("here", START + 20 * DAY_MS)]
    users = user_measures(log(spark, rows))
    cohorts = cohort_profile(users, VOLUME_METRICS, "before_last_week").collect()
    assert [r.churned for r in cohorts] == [0]


def test_empty_log(spark):
    empty = log(spark, [])
    assert user_features(user_measures(empty)).collect() == []
    assert page_share(empty).collect() == []
    assert [tuple(r) for r in activity_counts(empty).collect()] == [(0, 0, 0)]
    assert enrich_activity(empty, "last_week").collect() == []


def test_features_hold_no_null(spark):
    users = user_activity(user_day_rollup(log(spark, [event(ts=START, page="Home")])))
    row = user_features(users).first()
    assert [row[name] for name in MODEL_FEATURES] == [0.0] * len(MODEL_FEATURES)


def test_unknown_segment_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown segment"):
        enrich_activity(log(spark, []), "last_month")
