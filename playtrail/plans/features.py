"""From the raw log to the per-user feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from playtrail.operators import clean_activity, user_activity, user_day_rollup
from playtrail.schema import MODEL_FEATURES


def user_measures(log: DataFrame) -> DataFrame:
    """Every per-user measure of a raw log, unfilled, one row per user."""
    return user_activity(user_day_rollup(clean_activity(log)))


def user_features(users: DataFrame) -> DataFrame:
    """The model's features with `churned`; a missing value counts as 0."""
    return users.select("userId", "churned", *MODEL_FEATURES).fillna(0, subset=MODEL_FEATURES)
