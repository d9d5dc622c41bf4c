from __future__ import annotations

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from event_fixture import activity_from_events
from playtrail.operators import page_share
from playtrail.operators.model import (
    FOLDS,
    TREE_DEPTHS,
    best_params,
    decision_tree,
    f1_evaluator,
    hash_split,
    logistic_regression,
    model_table,
    random_split,
    score_table,
    split_label_rate,
    train_and_evaluate,
    split_users_check,
    tree_search,
    weighted_f1,
)
from playtrail.operators.search import search_predictions, search_scores
from playtrail.plans import churn_study, user_features, user_measures
from playtrail.plans.churn_study import model_input
from playtrail.schema import SONG_PAGE
from playtrail.sources import load_model, materialize, save_model

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def raw(spark):
    return activity_from_events(spark.read.parquet(f"{SF_DIR}/events.parquet"))


@pytest.fixture(scope="module")
def table(raw):
    return model_input(user_measures(raw))


def parts(table):
    return table.where("split = 'train'"), table.where("split = 'test'")


def scored(spark, pairs):
    return spark.createDataFrame(pairs, "label double, prediction double")


@pytest.mark.parametrize(
    "pairs",
    [
        [(1.0, 1.0), (0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (1.0, 1.0)],
        [(0.0, 0.0)] * 3,
        [(0.0, 1.0), (1.0, 0.0)],
        [(0.0, 2.0), (1.0, 1.0), (2.0, 2.0), (2.0, 0.0)],
        [(1.0, 0.0)] * 4 + [(0.0, 0.0)],
    ],
)
def test_weighted_f1_equals_the_evaluator(spark, pairs):
    frame = scored(spark, pairs)
    row = weighted_f1(frame).first()
    assert row.f1 == pytest.approx(f1_evaluator().evaluate(frame), abs=1e-9)
    assert row.rows == len(pairs)


def test_weighted_f1_of_predictions(table):
    result = train_and_evaluate(*parts(table), decision_tree())
    assert weighted_f1(result.predictions).first().f1 == pytest.approx(result.f1, abs=1e-9)


def test_labels_table(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert weighted_f1(labels, "quality", "toxic").first().f1 == pytest.approx(
        0.21822413175796634, abs=1e-9
    )


def test_hash_split_ignores_partitioning(raw):
    base = model_table(user_features(user_measures(raw)))
    chosen = []
    for n in (1, 5, 13):
        split = hash_split(base.repartition(n))
        chosen.append({r.userId: (r.split, r.fold) for r in split.collect()})
    assert chosen[0] == chosen[1] == chosen[2]
    shares = [part for part, _ in chosen[0].values()]
    assert 0.5 < shares.count("train") / len(shares) < 0.9
    assert {fold for _, fold in chosen[0].values()} == set(range(FOLDS))


def test_hash_split_depends_on_the_seed(raw):
    base = model_table(user_features(user_measures(raw)))
    one = {r.userId for r in hash_split(base, seed=1).where("split = 'test'").collect()}
    two = {r.userId for r in hash_split(base, seed=2).where("split = 'test'").collect()}
    assert one != two


def test_random_split_keeps_every_user(table):
    split = random_split(table.drop("split", "fold"))
    assert split.count() == table.count()
    rates = split_label_rate(split).collect()
    assert {r.split for r in rates} == {"train", "test"}
    assert sum(r.users for r in rates) == table.count()


@pytest.mark.parametrize("estimator", [logistic_regression, decision_tree])
def test_scores_do_not_depend_on_partitioning(table, estimator):
    results = [
        train_and_evaluate(*parts(table.repartition(n)), estimator()).f1 for n in (1, 6)
    ]
    assert results[0] == pytest.approx(results[1], abs=1e-9)
    assert 0.0 <= results[0] <= 1.0


def test_search_picks_one_of_the_depths(table):
    result = train_and_evaluate(*parts(table), tree_search())
    depth = result.model.getMaxDepth()
    assert depth in TREE_DEPTHS
    params = {r.param: r.value for r in best_params(result).collect()}
    assert params["maxDepth"] == str(depth)
    assert params["impurity"] == "gini"
    (row,) = score_table({"tuned": result}).collect()
    assert (row.model, row.params, row.f1) == ("tuned", f"maxDepth={depth}", result.f1)
    # The same table gives the same choice and score again.
    assert train_and_evaluate(*parts(table), tree_search()).f1 == result.f1


def test_models_find_a_plain_signal(spark):
    users = spark.range(400).select(
        F.col("id").cast("string").alias("userId"),
        (F.col("id") % 4 == 0).cast("double").alias("label"),
        array_to_vector(
            F.array((F.col("id") % 4).cast("double"), (F.col("id") % 7).cast("double"))
        ).alias("features"),
    )
    train, test = parts(hash_split(users))
    assert train_and_evaluate(train, test, decision_tree()).f1 == 1.0
    assert train_and_evaluate(train, test, logistic_regression()).f1 > 0.9
    assert train_and_evaluate(train, test, tree_search()).f1 == 1.0


def test_whole_study(raw):
    study = churn_study(raw)
    assert study.users.count() == 150
    assert study.pages.count() == study.pages_without_songs.count() + 1
    assert study.pages.collect() == page_share(raw).collect()
    assert study.pages_without_songs.collect() == page_share(raw, exclude=SONG_PAGE).collect()
    assert len(study.profiles) == 7
    assert all(profile.count() > 0 for profile in study.profiles.values())
    scores = {r.model: r.f1 for r in study.scores.collect()}
    assert set(scores) == set(study.evaluations)
    assert all(0.0 <= f1 <= 1.0 for f1 in scores.values())
    assert study.best_tree.count() > 0
    assert sum(r.users for r in study.label_rate.collect()) == 150


def test_unlabelled_and_unpredicted_rows_are_not_scored(spark):
    frame = scored(spark, [(1.0, 1.0), (0.0, 1.0), (None, 1.0), (1.0, None), (None, None)])
    whole = scored(spark, [(1.0, 1.0), (0.0, 1.0)])
    assert weighted_f1(frame).first() == weighted_f1(whole).first()
    (row,) = weighted_f1(frame.limit(0)).collect()
    assert (row.f1, row.rows) == (None, None)


def test_f1_by_group_is_that_of_each_group(spark):
    rows = [(g, float(a), float(b)) for g in (0, 1) for a in (0, 1) for b in (0, 1, g)]
    frame = spark.createDataFrame(rows, "g int, label double, prediction double")
    found = {r.g: r.f1 for r in weighted_f1(frame, by=["g"]).collect()}
    for g in (0, 1):
        assert found[g] == pytest.approx(weighted_f1(frame.where(F.col("g") == g)).first().f1)


def test_search_scores_are_the_searchs_own(table):
    train, _ = parts(table)
    search = tree_search([2, 3, 6], keep_models=True).fit(train)
    predictions = search_predictions(search, train)
    assert predictions.count() == 3 * train.count()
    scores = search_scores(search, train).collect()
    assert len(scores) == 3 * FOLDS
    means = {r.maxDepth: r.meanF1 for r in scores}
    assert [means[d] for d in (2, 3, 6)] == pytest.approx(search.avgMetrics, abs=1e-9)
    assert {r.maxDepth for r in scores if r.chosen} == {search.bestModel.getMaxDepth()}
    for fold in range(FOLDS):
        held_out = train.where(F.col("fold") == fold)
        for depth, model in zip((2, 3, 6), search.subModels[fold]):
            own = f1_evaluator().evaluate(model.transform(held_out))
            (row,) = [r for r in scores if (r.fold, r.maxDepth) == (fold, depth)]
            assert row.f1 == pytest.approx(own, abs=1e-9)


@pytest.mark.parametrize("estimator", [logistic_regression, decision_tree, tree_search])
def test_a_loaded_model_predicts_as_the_one_saved(spark, table, estimator):
    train, test = parts(table)
    fitted = train_and_evaluate(train, test, estimator())
    loaded = load_model(spark, save_model(spark, fitted.model, "model"))
    assert type(loaded) is type(fitted.model)
    columns = ["userId", "prediction", "probability"]
    assert sorted(map(str, loaded.transform(test).select(columns).collect())) == sorted(
        map(str, fitted.predictions.select(columns).collect())
    )
    assert best_params(fitted._replace(model=loaded)).collect() == best_params(fitted).collect()


def test_split_check_sees_what_is_wrong(spark):
    table = spark.createDataFrame([(str(i),) for i in range(10)], "userId string")
    split = spark.createDataFrame(
        [(str(i), "train") for i in range(6)] + [(str(i), "test") for i in (5, 6, 7, 99)], "userId string, split string"
    )
    (row,) = split_users_check(split, table).collect()
    assert row.asDict() == {"users": 8, "inBoth": 1, "inNeither": 2, "unknown": 1}
    good = random_split(materialize(table.withColumn("label", F.lit(0.0)), "users"))
    (row,) = split_users_check(good, table).collect()
    assert (row.users, row.inBoth, row.inNeither, row.unknown) == (10, 0, 0, 0)
