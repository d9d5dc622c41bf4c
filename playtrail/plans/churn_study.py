"""The whole study of a log: reports, cohort profiles, trained models, scores."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame

from playtrail.operators import cohort_profile, most_used_first, page_share, without_page
from playtrail.operators.model import (
    Evaluation,
    best_params,
    decision_tree,
    hash_split,
    logistic_regression,
    model_table,
    score_table,
    split_label_rate,
    train_and_evaluate,
    tree_search,
)
from playtrail.plans.features import user_features, user_measures
from playtrail.schema import INTENSITY_METRICS, RATIO_METRICS, SEGMENTS, SONG_PAGE, VOLUME_METRICS
from playtrail.sources import materialize

ESTIMATORS = {
    "logistic regression": logistic_regression,
    "decision tree": decision_tree,
    "tuned decision tree": tree_search,
}


class ChurnStudy(NamedTuple):
    pages: DataFrame
    pages_without_songs: DataFrame
    users: DataFrame
    profiles: dict[str, DataFrame]
    label_rate: DataFrame
    evaluations: dict[str, Evaluation]
    best_tree: DataFrame
    scores: DataFrame


def cohort_profiles(users: DataFrame) -> dict[str, DataFrame]:
    """The seven comparisons of cohorts, by name."""
    profiles = {}
    for segment in SEGMENTS:
        profiles[f"volumes_{segment}"] = cohort_profile(users, VOLUME_METRICS, segment)
        profiles[f"ratios_{segment}"] = cohort_profile(users, RATIO_METRICS, segment)
    profiles["intensity"] = cohort_profile(users, INTENSITY_METRICS)
    return profiles


def model_input(users: DataFrame) -> DataFrame:
    """Written table of label, features, split and fold for the users given."""
    return materialize(hash_split(model_table(user_features(users))), "model-input")


def train(table: DataFrame, *names: str) -> dict[str, Evaluation]:
    """Train the named models, or all of them, on a split table and score them."""
    train_rows = table.where("split = 'train'")
    test_rows = table.where("split = 'test'")
    return {
        name: train_and_evaluate(train_rows, test_rows, ESTIMATORS[name]())
        for name in names or ESTIMATORS
    }


def churn_study(log: DataFrame) -> ChurnStudy:
    """Everything there is to say about a raw log.

    The per-user table and the page report are computed from the log once each and
    written; profiles, models and the report without songs read the written tables.
    """
    users = materialize(user_measures(log), "user-measures")
    pages = materialize(page_share(log), "page-share")
    table = model_input(users)
    evaluations = train(table)
    return ChurnStudy(
        pages=most_used_first(pages),
        pages_without_songs=most_used_first(without_page(pages, SONG_PAGE)),
        users=users,
        profiles=cohort_profiles(users),
        label_rate=split_label_rate(table),
        evaluations=evaluations,
        best_tree=best_params(evaluations["tuned decision tree"]),
        scores=score_table(evaluations),
    )
