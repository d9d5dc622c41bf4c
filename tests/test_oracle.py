"""Every registered query with an SQL twin gives the rows DuckDB gives."""

from __future__ import annotations

import oracle
import pytest

import __spark_entry__ as registry

SF_DIR = "/root/testdata/sf0.01"
# Those of the optional subpackage are compared in its own tests.
QUERIES = {name: registry.queries()[name] for name in registry._activity_queries()}
SQL = registry._activity_sql()
ROWS_ONLY = {
    "random_split_label_rate",
    "logistic_scores",
    "tree_scores",
    "tuned_tree_scores",
    "best_tree_params",
    "score_table",
}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


def test_only_fits_and_random_rows_go_without_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    columns, rows, types = oracle.spark_result(QUERIES[name](spark, SF_DIR))
    expected_columns, expected_rows, expected_types = oracle.duck_result(duck, SQL[name])
    assert columns == expected_columns
    assert types == expected_types
    assert rows and not oracle.has_nan(rows)
    assert rows == expected_rows


def test_entry_gives_one_row_per_user(spark):
    features = registry.entry(spark)
    assert features.columns == ["userId", "churned", *registry.MODEL_FEATURES]
    assert features.count() == 15
