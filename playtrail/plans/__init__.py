"""Whole analyses composed of the operators."""

from playtrail.plans.churn_study import ChurnStudy, churn_study
from playtrail.plans.features import user_features, user_measures

__all__ = ["ChurnStudy", "churn_study", "user_features", "user_measures"]
