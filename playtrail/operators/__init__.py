"""DataFrame-to-DataFrame operators over the activity log."""

from playtrail.operators.clean import clean_activity, preview
from playtrail.operators.enrich import (
    enrich_activity,
    user_bounds,
    user_totals,
    with_active_days,
    with_calendar,
    with_churned,
    with_flags,
    with_rates,
    with_user_bounds,
    with_user_totals,
)
from playtrail.operators.per_user import attach_per_user
from playtrail.operators.profile import (
    activity_counts,
    cohort_profile,
    most_used_first,
    page_frequency,
    page_share,
    top_pages,
    without_page,
)
from playtrail.operators.rollup import active_days, user_activity, user_day_rollup
from playtrail.operators.segments import before_last_week, last_week

__all__ = [
    "active_days",
    "activity_counts",
    "attach_per_user",
    "before_last_week",
    "clean_activity",
    "cohort_profile",
    "enrich_activity",
    "last_week",
    "most_used_first",
    "page_frequency",
    "page_share",
    "preview",
    "top_pages",
    "user_activity",
    "user_bounds",
    "user_day_rollup",
    "user_totals",
    "with_active_days",
    "with_calendar",
    "with_churned",
    "with_flags",
    "with_rates",
    "with_user_bounds",
    "with_user_totals",
    "without_page",
]
