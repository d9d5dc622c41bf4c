"""

The queries read the driver's `events` table as an activity log
(`event_fixture.py`); the SQL states the same log in its first CTE and then
goes the long way, with windows and distinct counts over single events, where
the library works on daily sums.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from datetime import date
from functools import wraps

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from event_fixture import activity_from_events  # noqa: E402
from playtrail.operators import (  # noqa: E402
    active_days,
    activity_counts,
    attach_per_user,
    clean_activity,
    cohort_profile,
    enrich_activity,
    last_week,
    page_frequency,
    page_share,
    preview,
    top_pages,
    user_activity,
    user_day_rollup,
    with_active_days,
    with_calendar,
    with_churned,
    with_flags,
    with_rates,
    with_user_bounds,
    with_user_totals,
)
from playtrail.operators.distinct import day_bitmaps, number_users, users_in_spans  # noqa: E402
from playtrail.operators.flag_models import (  # noqa: E402
    PageWindow,
    flag_table,
    prediction_cells,
    user_flags,
)
from playtrail.operators.model import (  # noqa: E402
    Evaluation,
    best_params,
    decision_tree,
    hash_split,
    logistic_regression,
    model_table,
    random_split,
    score_table,
    split_label_rate,
    split_users_check,
    train_and_evaluate,
    tree_search,
    weighted_f1,
)
from playtrail.operators.search import search_scores  # noqa: E402
from playtrail.plans.churn_study import model_input, train  # noqa: E402
from playtrail.plans.features import user_features, user_measures  # noqa: E402
from playtrail.schema import (  # noqa: E402
    ACTIVITY,
    ACTIVITY_COLUMNS,
    CHANGES,
    INTENSITY_METRICS,
    LOOKBACKS,
    MODEL_FEATURES,
    PAGE_FLAGS,
    PAID_LEVEL,
    RATES,
    RATIO_METRICS,
    SEGMENTS,
    SONG_PAGE,
    USER_TOTALS,
    VOLUME_METRICS,
)
from playtrail.sources import (  # noqa: E402
    load_model,
    materialize,
    new_shared_path,
    read_activity,
    rejected_activity,
    save_model,
    schema_by_file,
    write_bucketed,
)
from playtrail.sources.rollup_store import (  # noqa: E402
    days_of,
    read_rollup,
    refresh_days,
    write_rollup,
)

try:
    import corpus_pipeline
    from playtrail.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    # The training-data operators can be left out; any other missing module is an error.
    if missing.name not in ("corpus_pipeline", "playtrail.llm"):
        raise
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
TOP_K = 5
EVENT_KEY = ["userId", "sessionId", "ts", "page"]
BOUNDS = ["endDate", "startDate", "durationDays", *LOOKBACKS]
TOTALS = ["churned", *USER_TOTALS]
CHANGE_SIDES = [rate + side for rate in CHANGES.values() for side in ("LastWeek", "BeforeLastWeek")]


# Two 0/1 inputs per user, and the depths a search tries on them.
CANCELLED_EARLY, CANCELLED_LATE = "cancelledEarly", "cancelledLate"
LAST_EARLY_DAY, FIRST_LATE_DAY = date(2024, 1, 8), date(2024, 1, 16)
FLAG_NAMES = [CANCELLED_EARLY, CANCELLED_LATE]
FLAG_WINDOWS = {
    CANCELLED_EARLY: PageWindow("churn", last=LAST_EARLY_DAY),
    CANCELLED_LATE: PageWindow("churn", first=FIRST_LATE_DAY),
}
FLAG_DEPTHS = [1, 2, 4, 6]
SPAN_DAYS = [1, 2, 7]


# --- inputs -----------------------------------------------------------------


def _in_session(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query in a session with a shared folder: a local one that names none gets one."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
        if context.master.startswith("local") and not named:
            # One machine, so its warehouse is where all of its threads write and read.
            context.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/shared")
        return query(spark, sf_dir)

    return run


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Days and hours are those of UTC, as in the SQL.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return activity_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_activity(_log(spark, sf_dir))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_measures(_log(spark, sf_dir))


# --- queries ----------------------------------------------------------------


def _scan_json_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "activity-json")
    _log(spark, sf_dir).write.json(path)
    return read_activity(spark, path, "json")


def _scan_parquet_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "activity-parquet")
    _log(spark, sf_dir).write.parquet(path)
    return read_activity(spark, path, "parquet")


def _event_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _clean(spark, sf_dir)
    rates = user_activity(user_day_rollup(events)).select("userId", *RATES)
    return attach_per_user(events, rates).select(*EVENT_KEY, *RATES)


def _user_rates(segment: str):
    suffix = SEGMENTS[segment]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        users = _users(spark, sf_dir).where(F.col("daysInteracting" + suffix) > 0)
        return users.select("userId", "churned", *[F.col(r + suffix).alias(r) for r in RATES])

    return query


def _cohort(metrics: list[str], segment: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        profile = cohort_profile(_users(spark, sf_dir), metrics, segment)
        # The last digit of an average depends on the order of addition.
        averages = [F.round(f"avg_{m}", 6).alias(f"avg_{m}") for m in metrics]
        return profile.select("churned", *averages)

    return query


def _enriched(segment: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return enrich_activity(_clean(spark, sf_dir), segment)

    return query


def _activity_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users(spark, sf_dir).select("userId", *CHANGE_SIDES, *CHANGES)


def _user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_features(_users(spark, sf_dir))


def _model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model_table(_user_features(spark, sf_dir))


def _model_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = vector_to_array("features")
    return _model_table(spark, sf_dir).select(
        "label", *[vector[i].alias(name) for i, name in enumerate(MODEL_FEATURES)]
    )


def _label_rate(table: DataFrame) -> DataFrame:
    return split_label_rate(table).withColumn("labelRate", F.round("labelRate", 6))


def _random_split_label_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = materialize(_model_table(spark, sf_dir), "model-table")
    return _label_rate(random_split(written))


def _split_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_split(_model_table(spark, sf_dir)).select("userId", "label", "split", "fold")


def _weighted_f1_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = weighted_f1(labels, label="quality", prediction="toxic")
    return scored.withColumn("f1", F.round("f1", 9))


def _scores(*names: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return score_table(train(model_input(_users(spark, sf_dir)), *names))

    return query


def _best_tree_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = "tuned decision tree"
    return best_params(train(model_input(_users(spark, sf_dir)), name)[name])


def _flag_table(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """Written table of the users' flags, label, vector, split and fold."""
    flags = user_flags(user_day_rollup(_clean(spark, sf_dir)), FLAG_WINDOWS)
    return materialize(hash_split(flag_table(flags, names)), "flag-table")


def _parts(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    return table.where("split = 'train'"), table.where("split = 'test'")


def _tree_search_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _parts(_flag_table(spark, sf_dir, FLAG_NAMES))
    scores = search_scores(tree_search(FLAG_DEPTHS, keep_models=True).fit(rows), rows)
    return scores.withColumns({c: F.round(c, 9).alias(c) for c in ("f1", "meanF1")})


def _logistic_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of a regression on one flag, and its F1, on the users it was not trained on."""
    fit = train_and_evaluate(*_parts(_flag_table(spark, sf_dir, [CANCELLED_LATE])), logistic_regression())
    cells = prediction_cells(fit.predictions, [CANCELLED_LATE])
    return cells.withColumn("f1", F.round(F.lit(fit.f1), 9))


def _reloaded(spark: SparkSession, sf_dir: str, *, search: bool) -> Evaluation:
    """A tree written to the shared folder and loaded again, scored on the test rows."""
    rows, test = _parts(_flag_table(spark, sf_dir, FLAG_NAMES))
    fitted = train_and_evaluate(rows, test, tree_search(FLAG_DEPTHS) if search else decision_tree())
    model = load_model(spark, save_model(spark, fitted.model, "tree"))
    predictions = model.transform(test)
    return Evaluation(model, predictions, weighted_f1(predictions).first()["f1"])


def _loaded_tree_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _reloaded(spark, sf_dir, search=False)
    cells = prediction_cells(loaded.predictions, FLAG_NAMES)
    return cells.withColumn("f1", F.round(F.lit(loaded.f1), 9))


def _loaded_tree_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_params(_reloaded(spark, sf_dir, search=True))


def _flag_score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, test = _parts(_flag_table(spark, sf_dir, FLAG_NAMES))
    fits = {
        "logistic regression": train_and_evaluate(rows, test, logistic_regression()),
        "decision tree": train_and_evaluate(rows, test, decision_tree()),
        "tuned decision tree": train_and_evaluate(rows, test, tree_search(FLAG_DEPTHS)),
    }
    return score_table(fits).withColumn("f1", F.round("f1", 9))


def _random_split_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = materialize(_model_table(spark, sf_dir), "model-table")
    return split_users_check(random_split(table), table)


def _drifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as text fields, some of them drifted, by the number of the event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    numbered = activity_from_events(events, "event_id")
    texts = [F.col(c).cast("string").alias(c) for c in ACTIVITY_COLUMNS]
    return numbered.select("event_id", *texts).withColumns(
        {
            "ts": F.expr("CASE WHEN event_id % 211 = 0 THEN 'noon' WHEN event_id % 7 = 0 THEN ts || '.0' ELSE ts END"),
            "sessionId": F.expr("CASE WHEN event_id % 223 = 0 THEN sessionId || '.5' ELSE sessionId END"),
            "status": F.expr("CASE WHEN event_id % 227 = 0 THEN 'ok' ELSE status END"),
        }
    )


def _rejected_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_shared_path(spark, "activity-drifted")
    _drifted(spark, sf_dir).select(*ACTIVITY_COLUMNS).write.json(path)
    return rejected_activity(spark, path)


def _schema_by_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two paths, one with a text for a number and a narrower number, the other without levels."""
    path = new_shared_path(spark, "activity-two")
    events = _drifted(spark, sf_dir)
    wide = events.where("event_id % 3 <> 0").select(*ACTIVITY_COLUMNS)
    typed = wide.withColumns({"length": F.expr("double(length)"), "itemInSession": F.expr("int(itemInSession)")})
    typed.coalesce(1).write.parquet(f"{path}/a")
    short = activity_from_events(spark.read.parquet(f"{sf_dir}/events.parquet").where("event_id % 3 = 0"))
    short.drop("level").coalesce(1).write.parquet(f"{path}/b")
    report = schema_by_file(spark, [f"{path}/a", f"{path}/b"])
    return report.withColumn("file", F.regexp_extract("file", "/([ab])/[^/]*$", 1))


def _user_features_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features from stored days: an early log without its last days and some late events, then refreshed."""
    path = new_shared_path(spark, "rollup")
    clean = _clean(spark, sf_dir)
    late = F.pmod(F.xxhash64("userId", "ts"), F.lit(11)) == 0
    known = clean.where((F.col("ts") < F.unix_millis(F.lit("2024-01-25").cast("timestamp"))) & ~late)
    write_rollup(known, path)
    refresh_days(clean, path, days_of(clean))
    return user_features(user_activity(read_rollup(spark, path)))


def _last_week_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last week one operator after the other: label and bounds, cut, then what is within the week."""
    labelled = with_churned(with_flags(_clean(spark, sf_dir)))
    week = last_week(with_user_bounds(labelled))
    measured = with_rates(with_active_days(with_user_totals(week)))
    return measured.select(*EVENT_KEY, *TOTALS, "daysInteracting", *RATES)


def _event_rates_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = write_bucketed(_clean(spark, sf_dir), "activity_by_user")
    rates = user_activity(user_day_rollup(events)).select("userId", *RATES)
    return attach_per_user(events, rates, spread=False).select(*EVENT_KEY, *RATES)


def _users_in_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users of the spans that end on each day of the log, from stored day bitmaps."""
    path = new_shared_path(spark, "rollup")
    write_rollup(_clean(spark, sf_dir), path)
    rollup = read_rollup(spark, path)
    bitmaps = materialize(day_bitmaps(rollup, number_users(rollup)), "day-bitmaps")
    length = F.explode(F.array(*map(F.lit, SPAN_DAYS)))
    spans = bitmaps.select("day", length.alias("length")).select(
        F.expr("date_sub(day, length - 1)").alias("first"), F.col("day").alias("last")
    )
    return users_in_spans(bitmaps, spans)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the behaviour of each user, as the models see it."""
    return _user_features(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = _activity_queries()
    if llm_queries is not None:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    return {name: _in_session(query) for name, query in found.items()}


def _activity_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "scan_json_activity": _scan_json_activity,
        "scan_parquet_activity": _scan_parquet_activity,
        "clean_activity": _clean,
        "preview_activity": lambda s, d: preview(_clean(s, d)),
        "calendar_columns": lambda s, d: with_calendar(_clean(s, d)).select(
            *EVENT_KEY, "year", "month", "day", "hour"
        ),
        "event_flags": lambda s, d: with_flags(_clean(s, d)).select(
            *EVENT_KEY, "level", *PAGE_FLAGS, "payingUser", "paying_when_churned"
        ),
        "user_bounds": lambda s, d: with_user_bounds(_clean(s, d)).select(*EVENT_KEY, *BOUNDS),
        "user_totals_window": lambda s, d: with_user_totals(_clean(s, d)).select(
            *EVENT_KEY, *TOTALS
        ),
        "event_churned": lambda s, d: with_churned(_clean(s, d)).select(*EVENT_KEY, "churned"),
        "active_days": lambda s, d: active_days(_clean(s, d)),
        "event_active_days": lambda s, d: with_active_days(_clean(s, d)).select(
            *EVENT_KEY, "daysInteracting"
        ),
        "event_rates": _event_rates,
        "user_day_rollup": lambda s, d: user_day_rollup(_clean(s, d)),
        "activity_enriched": _enriched("all"),
        "activity_last_week": _enriched("last_week"),
        "activity_before_last_week": _enriched("before_last_week"),
        "user_rates_all": _user_rates("all"),
        "user_rates_last_week": _user_rates("last_week"),
        "user_rates_before": _user_rates("before_last_week"),
        "user_intensity": lambda s, d: _users(s, d).select(
            "userId", "daysInteracting", "durationDays", "intensityOfInteraction"
        ),
        "activity_change": _activity_change,
        "user_features": _user_features,
        "page_frequency": lambda s, d: page_frequency(_log(s, d)),
        "top_pages": lambda s, d: top_pages(_log(s, d), TOP_K),
        "page_share": lambda s, d: page_share(_log(s, d)),
        "page_share_no_songs": lambda s, d: page_share(_log(s, d), exclude=SONG_PAGE),
        "cohort_volumes_all": _cohort(VOLUME_METRICS, "all"),
        "cohort_volumes_last_week": _cohort(VOLUME_METRICS, "last_week"),
        "cohort_volumes_before": _cohort(VOLUME_METRICS, "before_last_week"),
        "cohort_ratios_all": _cohort(RATIO_METRICS, "all"),
        "cohort_ratios_last_week": _cohort(RATIO_METRICS, "last_week"),
        "cohort_ratios_before": _cohort(RATIO_METRICS, "before_last_week"),
        "cohort_intensity": _cohort(INTENSITY_METRICS, "all"),
        "activity_counts": lambda s, d: activity_counts(_clean(s, d)),
        "model_input": _model_input,
        "split_users": _split_users,
        "split_label_rate": lambda s, d: _label_rate(hash_split(_model_table(s, d))),
        "random_split_label_rate": _random_split_label_rate,
        "weighted_f1_labels": _weighted_f1_labels,
        "logistic_scores": _scores("logistic regression"),
        "tree_scores": _scores("decision tree"),
        "tuned_tree_scores": _scores("tuned decision tree"),
        "best_tree_params": _best_tree_params,
        "score_table": _scores(),
        "tree_search_scores": _tree_search_scores,
        "logistic_cells": _logistic_cells,
        "loaded_tree_cells": _loaded_tree_cells,
        "loaded_tree_params": _loaded_tree_params,
        "flag_score_table": _flag_score_table,
        "random_split_check": _random_split_check,
        "rejected_activity": _rejected_activity,
        "schema_by_file": _schema_by_file,
        "user_features_stored": _user_features_stored,
        "last_week_in_steps": _last_week_in_steps,
        "event_rates_bucketed": _event_rates_bucketed,
        "users_in_spans": _users_in_spans,
    }


# --- the same in SQL --------------------------------------------------------

# The activity log, from the rules of `activity_from_events`.
_SQL_LOG = """
log AS (
  SELECT
    CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 101 = 0 THEN NULL
         ELSE CAST(user_id AS VARCHAR) END AS userId,
    CASE WHEN event_id % 103 <> 0
         THEN user_id * 100 + CAST(day(ts) AS BIGINT) END AS sessionId,
    epoch_us(ts) // 1000 AS ts,
    page,
    CASE WHEN user_id % 3 = 0 THEN 'paid' ELSE 'free' END AS level,
    CASE WHEN page = 'NextSong' THEN 'song-' || CAST(event_id % 1000 AS VARCHAR) END AS song,
    CASE WHEN page = 'NextSong' THEN 'artist-' || CAST(event_id % 100 AS VARCHAR) END AS artist,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    event_id % 50 AS itemInSession,
    CASE WHEN page = 'NextSong' THEN value END AS length,
    'city-' || CAST(user_id % 20 AS VARCHAR) AS location,
    CAST(CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS BIGINT) AS status,
    'agent-' || CAST(user_id % 5 AS VARCHAR) AS userAgent
  FROM (
    SELECT *, CASE
      WHEN event_type = 'error' AND value > 200 THEN 'Cancellation Confirmation'
      WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'Roll Advert'
      WHEN event_type = 'error' THEN 'Thumbs Down'
      WHEN event_type = 'view' THEN 'NextSong'
      WHEN event_type = 'click' AND event_id % 3 = 0 THEN 'Thumbs Up'
      WHEN event_type = 'click' THEN 'NextSong'
      WHEN event_type = 'purchase' AND event_id % 5 = 0 THEN 'Submit Downgrade'
      WHEN event_type = 'purchase' AND event_id % 5 = 1 THEN 'Downgrade'
      WHEN event_type = 'purchase' THEN 'Add to Playlist'
      WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'Add Friend'
      WHEN event_type = 'signup' THEN 'Logout' END AS page
    FROM events
  ) AS paged
)"""

_SQL_CLEAN = """
cleaned AS (
  SELECT * FROM log
  WHERE userId <> '' AND userId IS NOT NULL AND sessionId IS NOT NULL AND ts IS NOT NULL
)"""

_SQL_FLAGGED = (
    """
flagged AS (
  SELECT *, make_timestamp(ts * 1000) AS moment,
    CAST(make_timestamp(ts * 1000) AS DATE) AS eventDay,
    """
    + ",\n    ".join(
        f"CASE WHEN page = '{page}' THEN 1 ELSE 0 END AS {flag}"
        for flag, page in PAGE_FLAGS.items()
    )
    + f""",
    CASE WHEN level = '{PAID_LEVEL}' THEN 1 ELSE 0 END AS payingUser
  FROM cleaned
)"""
)

# Every event with its user's bounds and label.
_SQL_BOUNDED = (
    """
bounded AS (
  SELECT *,
    strftime(max(moment) OVER u, '%Y-%m-%d %H:%M:%S') AS endDate,
    strftime(min(moment) OVER u, '%Y-%m-%d %H:%M:%S') AS startDate,
    CAST(max(eventDay) OVER u - min(eventDay) OVER u AS INTEGER) AS durationDays,
    """
    + ",\n    ".join(f"max(eventDay) OVER u - {n} AS {name}" for name, n in LOOKBACKS.items())
    + """,
    CAST(sum(churn) OVER u AS BIGINT) AS churned
  FROM flagged WINDOW u AS (PARTITION BY userId)
)"""
)

_SQL_SEGMENT = {
    "all": "true",
    "last_week": "eventDay > weekBeforeEndDate",
    "before_last_week": "eventDay < weekBeforeEndDate",
}

_SQL_RATES = ",\n    ".join(
    f"CAST({counted} AS DOUBLE) / nullif({per}, 0) AS {rate}"
    for rate, (counted, per) in RATES.items()
)


def _sql_segment(name: str, segment: str) -> str:
    """CTEs: the segment's users with totals, days, rates and intensity, as `name`."""
    sums = ",\n    ".join(f"CAST(sum({f}) AS BIGINT) AS {t}" for t, f in USER_TOTALS.items())
    return f"""
{name}_sums AS (
  SELECT userId, churned, durationDays, count(DISTINCT eventDay) AS daysInteracting,
    {sums}
  FROM bounded WHERE {_SQL_SEGMENT[segment]}
  GROUP BY userId, churned, durationDays
),
{name} AS (
  SELECT *, {_SQL_RATES},
    coalesce(CAST(daysInteracting AS DOUBLE) / nullif(durationDays, 0) * 100, 0.0)
      AS intensityOfInteraction
  FROM {name}_sums
)"""


_SQL_CHANGE = """
change AS (
  SELECT a.*,
    w.songsListenedPerDay AS songsListenedPerDayLastWeek,
    b.songsListenedPerDay AS songsListenedPerDayBeforeLastWeek,
    w.songsAddedToPlaylistPerDay AS songsAddedToPlaylistPerDayLastWeek,
    b.songsAddedToPlaylistPerDay AS songsAddedToPlaylistPerDayBeforeLastWeek,
    w.songsAddedToPlaylistPerDay / nullif(b.songsAddedToPlaylistPerDay, 0)
      AS playlistActivityChange,
    w.songsListenedPerDay / nullif(b.songsListenedPerDay, 0) AS listeningActivityChange
  FROM whole AS a
  LEFT JOIN week AS w ON a.userId = w.userId
  LEFT JOIN before AS b ON a.userId = b.userId
)"""

_SQL_FEATURES = (
    """
features AS (
  SELECT userId, churned, """
    + ", ".join(f"coalesce({name}, 0.0) AS {name}" for name in MODEL_FEATURES)
    + """
  FROM change
)"""
)

_SQL_SPLIT = """
split_users AS (
  SELECT userId, CAST(CASE WHEN churned > 0 THEN 1 ELSE 0 END AS DOUBLE) AS label,
    CASE WHEN CAST('0x' || substr(md5('12345:' || userId), 1, 8) AS BIGINT) % 100 < 70
         THEN 'train' ELSE 'test' END AS split,
    CAST(CAST('0x' || substr(md5('12345:' || userId), 9, 8) AS BIGINT) % 3 AS INTEGER) AS fold
  FROM features
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_ON_LOG = _with(_SQL_LOG)
_ON_CLEAN = _with(_SQL_LOG, _SQL_CLEAN)
_ON_FLAGGED = _with(_SQL_LOG, _SQL_CLEAN, _SQL_FLAGGED)
_ON_BOUNDED = _with(_SQL_LOG, _SQL_CLEAN, _SQL_FLAGGED, _SQL_BOUNDED)
_ON_FEATURES = ",".join(
    [
        _ON_BOUNDED,
        _sql_segment("whole", "all"),
        _sql_segment("week", "last_week"),
        _sql_segment("before", "before_last_week"),
        _SQL_CHANGE,
        _SQL_FEATURES,
        _SQL_SPLIT,
    ]
)


def _sql_users(segment: str) -> str:
    return f"{_ON_BOUNDED},{_sql_segment('chosen', segment)}"


def _sql_rates(segment: str) -> str:
    return f"{_sql_users(segment)} SELECT userId, churned, {', '.join(RATES)} FROM chosen"


def _sql_cohort(metrics: list[str], segment: str) -> str:
    averages = ", ".join(f"round(avg({m}), 6) AS avg_{m}" for m in metrics)
    return f"{_sql_users(segment)} SELECT churned, {averages} FROM chosen GROUP BY churned"


def _sql_calendar() -> str:
    return ", ".join(
        f"CAST({part}(moment) AS INTEGER) AS {part}" for part in ("year", "month", "day", "hour")
    )


def _sql_enriched(segment: str) -> str:
    """Events of a segment with everything derived, by windows over single events."""
    totals = ",\n    ".join(
        f"CAST(sum({f}) OVER u AS BIGINT) AS {t}" for t, f in USER_TOTALS.items()
    )
    columns = [
        *ACTIVITY_COLUMNS,
        _sql_calendar(),
        *PAGE_FLAGS,
        "payingUser",
        "CASE WHEN churn = 1 AND payingUser = 1 THEN 1 ELSE 0 END AS paying_when_churned",
        *BOUNDS,
        *TOTALS,
        "daysInteracting",
        *RATES,
    ]
    source = "enriched"
    if segment == "all":
        whole = ["intensityOfInteraction", *CHANGE_SIDES, *CHANGES]
        columns += whole
        source += f" JOIN (SELECT userId, {', '.join(whole)} FROM change) AS c USING (userId)"
    return f"""{_ON_FEATURES},
chosen AS (
  SELECT *, {totals},
    count(DISTINCT eventDay) OVER u AS daysInteracting
  FROM bounded WHERE {_SQL_SEGMENT[segment]} WINDOW u AS (PARTITION BY userId)
),
enriched AS (
  SELECT *, {_SQL_RATES} FROM chosen
)
SELECT {", ".join(columns)} FROM {source}"""


def _sql_user_window(columns: str) -> str:
    return (
        f"{_ON_FLAGGED} SELECT {', '.join(EVENT_KEY)}, {columns} "
        "FROM flagged WINDOW u AS (PARTITION BY userId)"
    )


_SQL_EVENT_TOTALS = ", ".join(
    f"CAST(sum({flag}) OVER u AS BIGINT) AS {total}"
    for total, flag in ({"churned": "churn"} | USER_TOTALS).items()
)
_SQL_PAGES = "SELECT page, count(*) AS n FROM log GROUP BY page"
_SQL_SHARES = f"""{_ON_LOG}, pages AS ({_SQL_PAGES}),
shares AS (
  SELECT page, n, (SELECT count(*) FROM log) AS total,
    CAST(n AS DOUBLE) / (SELECT count(*) FROM log) * 100 AS count_percentage
  FROM pages
)"""
_KEY = ", ".join(EVENT_KEY)

# The log with event numbers, some fields drifted, all as text.
_SQL_DRIFTED = (
    _SQL_LOG.replace("log AS (\n  SELECT\n", "numbered AS (\n  SELECT event_id,\n", 1)
    + """,
drifted AS (
  SELECT * REPLACE (
    CASE WHEN event_id % 211 = 0 THEN 'noon' WHEN event_id % 7 = 0 THEN ts || '.0'
         ELSE CAST(ts AS VARCHAR) END AS ts,
    CASE WHEN event_id % 223 = 0 THEN sessionId || '.5' ELSE CAST(sessionId AS VARCHAR) END
      AS sessionId,
    CASE WHEN event_id % 227 = 0 THEN 'ok' ELSE CAST(status AS VARCHAR) END AS status)
  FROM numbered
)"""
)


def _sql_schema_by_file() -> str:
    """One row per file and column: counts of the file's values and of those that do not fit."""
    found = {f.name: f.dataType.simpleString() for f in ACTIVITY.fields}
    misfits = {"sessionId": "sessionId LIKE '%.5'", "ts": "ts = 'noon'", "status": "status = 'ok'"}
    a = found | dict.fromkeys(misfits, "string") | {"itemInSession": "int"}
    parts = []
    for name, declared in found.items():
        wrong = f"count(*) FILTER ({misfits[name]})" if name in misfits else "CAST(0 AS BIGINT)"
        b = ("absent", "CAST(0 AS BIGINT)") if name == "level" else (declared, f"count({name})")
        for file, rows, kind, values, bad in (
            ("a", "event_id % 3 <> 0", a[name], f"count({name})", wrong),
            ("b", "event_id % 3 = 0", *b, "CAST(0 AS BIGINT)"),
        ):
            parts.append(
                f"SELECT '{file}' AS file, '{name}' AS \"column\", '{declared}' AS declared,"
                f" '{kind}' AS found, count(*) AS \"rows\", {values} AS \"values\","
                f" {bad} AS misfits FROM drifted WHERE {rows}"
            )
    return f"WITH {_SQL_DRIFTED} " + " UNION ALL ".join(parts)


# Users by their two flags, and what trees of depth 1 and more, trained on all training
# rows (f = -1) or without fold f, predict for them. A tree of depth 1 takes the flag that
# leaves less impurity and the majority of each side, a deeper one the majority of each cell.
_SQL_TREES = f"""
flag_users AS (
  SELECT *, CASE WHEN CAST('0x' || substr(md5('12345:' || userId), 1, 8) AS BIGINT) % 100 < 70
                 THEN 'train' ELSE 'test' END AS split,
    CAST(CAST('0x' || substr(md5('12345:' || userId), 9, 8) AS BIGINT) % 3 AS INTEGER) AS fold
  FROM (
    SELECT userId, CAST(max(churn) AS BIGINT) AS label,
      max(CASE WHEN churn = 1 AND eventDay <= DATE '{LAST_EARLY_DAY}' THEN 1 ELSE 0 END) AS early,
      max(CASE WHEN churn = 1 AND eventDay >= DATE '{FIRST_LATE_DAY}' THEN 1 ELSE 0 END) AS late
    FROM flagged GROUP BY userId
  ) AS u
),
fits AS (SELECT f, u.* FROM flag_users AS u, (VALUES (-1), (0), (1), (2)) AS r(f)
  WHERE split = 'train' AND fold <> f),
sides AS (
  SELECT f, 'early' AS flag, early AS side, count(*) AS n, sum(label) AS y FROM fits GROUP BY ALL
  UNION ALL
  SELECT f, 'late' AS flag, late AS side, count(*) AS n, sum(label) AS y FROM fits GROUP BY ALL
),
impure AS (
  SELECT f, flag, sum(n - CAST(y * y + (n - y) * (n - y) AS DOUBLE) / n) AS rest FROM sides GROUP BY ALL
),
best AS (
  SELECT f, CASE WHEN max(rest) FILTER (flag = 'late') < max(rest) FILTER (flag = 'early') - 1e-9
                 THEN 'late' ELSE 'early' END AS flag
  FROM impure GROUP BY f
),
shallow AS (
  SELECT b.f, b.flag, side, CASE WHEN 2 * y > n THEN 1 ELSE 0 END AS prediction
  FROM best AS b JOIN sides AS s ON b.f = s.f AND b.flag = s.flag
),
cells AS (
  SELECT f, early, late, CASE WHEN 2 * sum(label) > count(*) THEN 1 ELSE 0 END AS prediction
  FROM fits GROUP BY ALL
),
predicted AS (
  SELECT u.*, s.f, s.prediction AS depth1, coalesce(c.prediction, s.prediction) AS deeper
  FROM flag_users AS u
  JOIN shallow AS s ON s.side = CASE s.flag WHEN 'early' THEN early ELSE late END
  LEFT JOIN cells AS c ON c.f = s.f AND c.early = u.early AND c.late = u.late
)"""

_ON_TREES = f"{_ON_FLAGGED},{_SQL_TREES}"


def _sql_f1(source: str, by: str, prediction: str) -> str:
    """Weighted F1 of 0/1 labels and predictions per group."""
    return f"""
  SELECT {by}, sum(n) AS n, sum(CASE WHEN n + claimed > 0
    THEN n * (2.0::DOUBLE * hits / (n + claimed)) ELSE 0 END) / sum(n) AS f1
  FROM (
    SELECT {by}, c, count(*) FILTER (label = c) AS n, count(*) FILTER ({prediction} = c) AS claimed,
      count(*) FILTER (label = c AND {prediction} = c) AS hits
    FROM {source}, (VALUES (0), (1)) AS classes(c) GROUP BY {by}, c
  ) AS counted GROUP BY {by}"""


_SQL_FOLD_SCORES = f"""
held_out AS (
  SELECT f AS fold, maxDepth, label, CASE WHEN maxDepth = 1 THEN depth1 ELSE deeper END AS given
  FROM (SELECT * EXCLUDE (fold) FROM predicted WHERE split = 'train' AND fold = f) AS p,
    (VALUES {", ".join(f"({d})" for d in FLAG_DEPTHS)}) AS depths(maxDepth)
),
fold_scores AS ({_sql_f1("held_out", "fold, maxDepth", "given")}),
means AS (SELECT maxDepth, avg(f1) AS meanF1 FROM fold_scores GROUP BY maxDepth),
chosen AS (SELECT min(maxDepth) AS depth FROM means
  WHERE round(meanF1, 9) = (SELECT round(max(meanF1), 9) FROM means))"""

_SQL_TEST = "(SELECT *, 0 AS g FROM predicted WHERE f = -1 AND split = 'test') AS t"


def _sql_tree_params() -> str:
    """The chosen tree's parameters: those given, and Spark's defaults."""
    given = {"seed": "12345", "featuresCol": "features", "labelCol": "label"}
    given |= {"predictionCol": "prediction", "probabilityCol": "probability"}
    defaults = {"rawPredictionCol": "rawPrediction", "cacheNodeIds": "False", "leafCol": ""}
    defaults |= {"checkpointInterval": "10", "impurity": "gini", "maxBins": "32"}
    defaults |= {"maxMemoryInMB": "256", "minInfoGain": "0.0", "minInstancesPerNode": "1"}
    defaults |= {"minWeightFractionPerNode": "0.0"}
    rows = ", ".join(f"('{k}', '{v}')" for k, v in (given | defaults).items())
    return f"""{_ON_TREES},{_SQL_FOLD_SCORES}
SELECT * FROM (VALUES {rows}) AS p(param, value)
UNION ALL SELECT 'maxDepth', CAST(depth AS VARCHAR) FROM chosen"""


_SQL_SPANS = " UNION ALL ".join(
    f"SELECT d - {n - 1} AS low, d AS high FROM (SELECT DISTINCT eventDay AS d FROM flagged) AS x"
    for n in SPAN_DAYS
)


def oracle_sql() -> dict[str, str]:
    if llm_queries is None:
        return _activity_sql()
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return _activity_sql() | llm_queries.oracle_sql() | pipeline


def _activity_sql() -> dict[str, str]:
    return {
        "scan_json_activity": f"{_ON_LOG} SELECT * FROM log",
        "scan_parquet_activity": f"{_ON_LOG} SELECT * FROM log",
        "clean_activity": f"{_ON_CLEAN} SELECT * FROM cleaned",
        "preview_activity": f"""{_ON_CLEAN}
SELECT level, status, itemInSession, userAgent, page, sessionId, length FROM cleaned
ORDER BY ts, userId, level, status, itemInSession, userAgent, page, sessionId,
  length NULLS FIRST LIMIT 10""",
        "calendar_columns": f"{_ON_FLAGGED} SELECT {_KEY}, {_sql_calendar()} FROM flagged",
        "event_flags": f"""{_ON_FLAGGED}
SELECT {_KEY}, level, {", ".join(PAGE_FLAGS)}, payingUser,
  CASE WHEN churn = 1 AND payingUser = 1 THEN 1 ELSE 0 END AS paying_when_churned
FROM flagged""",
        "user_bounds": f"{_ON_BOUNDED} SELECT {_KEY}, {', '.join(BOUNDS)} FROM bounded",
        "user_totals_window": _sql_user_window(_SQL_EVENT_TOTALS),
        "event_churned": f"{_ON_BOUNDED} SELECT {_KEY}, churned FROM bounded",
        "active_days": f"""{_ON_FLAGGED}
SELECT userId, count(DISTINCT eventDay) AS daysInteracting FROM flagged GROUP BY userId""",
        "event_active_days": _sql_user_window(
            "count(DISTINCT eventDay) OVER u AS daysInteracting"
        ),
        "event_rates": f"""WITH totals AS ({_sql_user_window(
            _SQL_EVENT_TOTALS + ", count(DISTINCT eventDay) OVER u AS daysInteracting"
        )})
SELECT {_KEY}, {_SQL_RATES} FROM totals""",
        "user_day_rollup": f"""{_ON_FLAGGED}
SELECT userId, eventDay AS day, count(*) AS events, min(ts) AS firstTs, max(ts) AS lastTs,
  {", ".join(f"CAST(sum({flag}) AS BIGINT) AS {flag}" for flag in PAGE_FLAGS)}
FROM flagged GROUP BY userId, eventDay""",
        "activity_enriched": _sql_enriched("all"),
        "activity_last_week": _sql_enriched("last_week"),
        "activity_before_last_week": _sql_enriched("before_last_week"),
        "user_rates_all": _sql_rates("all"),
        "user_rates_last_week": _sql_rates("last_week"),
        "user_rates_before": _sql_rates("before_last_week"),
        "user_intensity": f"""{_sql_users("all")}
SELECT userId, daysInteracting, durationDays, intensityOfInteraction FROM chosen""",
        "activity_change": f"""{_ON_FEATURES}
SELECT userId, {", ".join([*CHANGE_SIDES, *CHANGES])} FROM change""",
        "user_features": f"{_ON_FEATURES} SELECT * FROM features",
        "page_frequency": f"{_ON_LOG} {_SQL_PAGES}",
        "top_pages": f"{_ON_LOG} {_SQL_PAGES} ORDER BY n DESC, page NULLS FIRST LIMIT {TOP_K}",
        "page_share": f"{_SQL_SHARES} SELECT * FROM shares",
        "page_share_no_songs": f"""{_SQL_SHARES}
SELECT * FROM shares WHERE page IS DISTINCT FROM '{SONG_PAGE}'""",
        "cohort_volumes_all": _sql_cohort(VOLUME_METRICS, "all"),
        "cohort_volumes_last_week": _sql_cohort(VOLUME_METRICS, "last_week"),
        "cohort_volumes_before": _sql_cohort(VOLUME_METRICS, "before_last_week"),
        "cohort_ratios_all": _sql_cohort(RATIO_METRICS, "all"),
        "cohort_ratios_last_week": _sql_cohort(RATIO_METRICS, "last_week"),
        "cohort_ratios_before": _sql_cohort(RATIO_METRICS, "before_last_week"),
        "cohort_intensity": _sql_cohort(INTENSITY_METRICS, "all"),
        "activity_counts": f"""{_ON_FLAGGED}
SELECT count(*) AS events, count(DISTINCT userId) AS users,
  count(DISTINCT eventDay) AS calendarDays FROM flagged""",
        "model_input": f"""{_ON_FEATURES}
SELECT CAST(CASE WHEN churned > 0 THEN 1 ELSE 0 END AS DOUBLE) AS label,
  {", ".join(MODEL_FEATURES)} FROM features""",
        "split_users": f"{_ON_FEATURES} SELECT userId, label, split, fold FROM split_users",
        "split_label_rate": f"""{_ON_FEATURES}
SELECT split, count(*) AS users, round(avg(label), 6) AS labelRate
FROM split_users GROUP BY split""",
        "weighted_f1_labels": """
WITH classes AS (SELECT quality AS c FROM labels UNION SELECT toxic FROM labels),
counts AS (
  SELECT c, (SELECT count(*) FROM labels WHERE quality = c) AS support,
    (SELECT count(*) FROM labels WHERE toxic = c) AS claimed,
    (SELECT count(*) FROM labels WHERE quality = c AND toxic = c) AS hits
  FROM classes
)
SELECT round(sum(support * (2.0::DOUBLE * hits / (support + claimed))) / sum(support), 9) AS f1,
  CAST(sum(support) AS BIGINT) AS "rows"
FROM counts""",
        "tree_search_scores": f"""{_ON_TREES},{_SQL_FOLD_SCORES}
SELECT fold, s.maxDepth AS "maxDepth", CAST(n AS BIGINT) AS "rows", round(f1, 9) AS f1,
  round(meanF1, 9) AS "meanF1", CASE WHEN s.maxDepth = depth THEN 1 ELSE 0 END AS chosen
FROM fold_scores AS s JOIN means AS m ON s.maxDepth = m.maxDepth, chosen""",
        "logistic_cells": f"""{_ON_TREES},
fitted AS (
  SELECT late, CASE WHEN 2 * sum(label) > count(*) THEN 1 ELSE 0 END AS given
  FROM flag_users WHERE split = 'train' GROUP BY late
),
tested AS (
  SELECT u.*, given, 0 AS g FROM flag_users AS u JOIN fitted USING (late) WHERE split = 'test'
)
SELECT late AS "{CANCELLED_LATE}", given AS prediction, count(*) AS users,
  CAST(sum(label) AS BIGINT) AS cancelled, any_value(round(f1, 9)) AS f1
FROM tested, ({_sql_f1("tested", "g", "given")}) AS scored GROUP BY late, given""",
        "loaded_tree_cells": f"""{_ON_TREES}
SELECT early AS "{CANCELLED_EARLY}", late AS "{CANCELLED_LATE}", deeper AS prediction,
  count(*) AS users, CAST(sum(label) AS BIGINT) AS cancelled, any_value(round(f1, 9)) AS f1
FROM {_SQL_TEST}, ({_sql_f1(_SQL_TEST, "g", "deeper")}) AS scored GROUP BY early, late, deeper""",
        "loaded_tree_params": _sql_tree_params(),
        "flag_score_table": f"""{_ON_TREES},{_SQL_FOLD_SCORES},
shallow_f1 AS ({_sql_f1(_SQL_TEST, "g", "depth1")}),
deeper_f1 AS ({_sql_f1(_SQL_TEST, "g", "deeper")})
SELECT 'logistic regression' AS model, 'maxIter=5, regParam=0.0' AS params, round(f1, 9) AS f1
FROM deeper_f1
UNION ALL SELECT 'decision tree', 'maxDepth=5', round(f1, 9) FROM deeper_f1
UNION ALL SELECT 'tuned decision tree', 'maxDepth=' || depth,
  round(CASE WHEN depth = 1 THEN s.f1 ELSE d.f1 END, 9) FROM shallow_f1 AS s, deeper_f1 AS d, chosen""",
        "random_split_check": f"""{_ON_FEATURES}
SELECT count(DISTINCT userId) AS users, CAST(0 AS BIGINT) AS "inBoth",
  CAST(0 AS BIGINT) AS "inNeither", CAST(0 AS BIGINT) AS "unknown" FROM features""",
        "rejected_activity": f"""WITH {_SQL_DRIFTED}
SELECT * EXCLUDE (event_id) REPLACE (
    CASE WHEN sessionId NOT LIKE '%.5' THEN CAST(sessionId AS BIGINT) END AS sessionId,
    CASE WHEN ts <> 'noon' THEN CAST(replace(ts, '.0', '') AS BIGINT) END AS ts,
    CASE WHEN status <> 'ok' THEN CAST(status AS BIGINT) END AS status),
  concat_ws(', ', CASE WHEN sessionId LIKE '%.5' THEN 'sessionId=' || sessionId END,
    CASE WHEN ts = 'noon' THEN 'ts=noon' END, CASE WHEN status = 'ok' THEN 'status=ok' END)
    AS rejected
FROM drifted WHERE sessionId LIKE '%.5' OR ts = 'noon' OR status = 'ok'""",
        "schema_by_file": _sql_schema_by_file(),
        "user_features_stored": f"{_ON_FEATURES} SELECT * FROM features",
        "event_rates_bucketed": f"""WITH totals AS ({_sql_user_window(
            _SQL_EVENT_TOTALS + ", count(DISTINCT eventDay) OVER u AS daysInteracting"
        )})
SELECT {_KEY}, {_SQL_RATES} FROM totals""",
        "last_week_in_steps": f"""
SELECT {_KEY}, {", ".join([*TOTALS, "daysInteracting", *RATES])}
FROM ({_sql_enriched("last_week")}) AS week""",
        "users_in_spans": f"""{_ON_FLAGGED}, spans AS ({_SQL_SPANS})
SELECT low AS "first", high AS "last", count(DISTINCT userId) AS users
FROM spans JOIN flagged ON eventDay BETWEEN low AND high GROUP BY low, high""",
    }
