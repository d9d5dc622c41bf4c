"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from logs import random_log

import __spark_entry__ as registry
from playtrail.operators import clean_activity, cohort_profile, top_pages, user_day_rollup
from playtrail.plans import user_features, user_measures
from playtrail.schema import VOLUME_METRICS
from playtrail.sources import read_activity

SF_DIR = "/root/testdata/sf0.001"
LAZY = sorted(registry._activity_sql())


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "activity")
    random_log(spark, 21).write.parquet(path)
    return read_activity(spark, path, "parquet")


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in text


@pytest.mark.parametrize("name", LAZY)
def test_no_window_over_everything(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    assert all("[userId" in line.rsplit("]", 2)[-2] for line in text.splitlines()
               if re.search(r"\bWindow \[", line))


def test_features_take_two_shuffles_and_no_join(stored):
    text = plan(user_features(user_measures(stored)))
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    assert [len(k.split(",")) for k in keys] == [1, 2]
    assert text.count("Exchange") == 2
    assert "Join" not in text


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(user_features(user_measures(stored)))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for condition in ("IsNotNull(userId)", "Not(EqualTo(userId,))", "IsNotNull(sessionId)",
                      "IsNotNull(ts)"):
        assert condition in pushed
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert {field.split(":")[0] for field in read.split(",")} == {
        "userId", "sessionId", "ts", "page"
    }


def test_one_segment_computes_only_its_own_sums(stored):
    text = plan(cohort_profile(user_measures(stored), VOLUME_METRICS))
    assert "Window" not in text
    assert "FILTER" not in text
    text = plan(cohort_profile(user_measures(stored), VOLUME_METRICS, "last_week"))
    assert "Window" in text
    assert not re.search(r"day#\d+ < weekBefore", text)


def test_top_pages_never_sorts_everything(stored):
    assert "TakeOrderedAndProject" in plan(top_pages(stored, 3))


def test_rollup_combines_before_the_shuffle(stored):
    text = plan(user_day_rollup(clean_activity(stored)))
    assert text.count("HashAggregate") == 2
    assert "SortAggregate" not in text


def test_event_rates_scan_the_log_twice_and_attach_once(spark):
    text = plan(registry.queries()["event_rates"](spark, SF_DIR))
    assert text.count("FileScan") == 2 and len(re.findall(r"\w*Join ", text)) == 1


def test_counts_expand_no_rows(spark):
    text = plan(registry.queries()["activity_counts"](spark, SF_DIR))
    assert "Expand" not in text
