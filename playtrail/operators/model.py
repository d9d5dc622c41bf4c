"""Churn models on the per-user feature table.

Inputs are one row per user. Each model fit passes over its input several
times: give the functions here a materialized table, not a plan that starts at
the event log.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playtrail.schema import MODEL_FEATURES

# Seed and share of the split, settings of the regression, tree
# depths searched.
SEED = 12345
TRAIN_PERCENT = 70
REGRESSION_ITERATIONS = 5
REGRESSION_REGULARIZATION = 0.0
TREE_DEPTHS = [4, 6]

FOLDS = 3


class Evaluation(NamedTuple):
    model: Model
    predictions: DataFrame
    f1: float


def model_table(features: DataFrame) -> DataFrame:
    """`userId`, `label` and the assembled `features` vector of filled features.

    The label is 1.0 for a user who cancelled at all, however often.
    """
    labelled = features.withColumn("label", (F.col("churned") > 0).cast("double"))
    assembler = VectorAssembler(inputCols=MODEL_FEATURES, outputCol="features")
    return assembler.transform(labelled).select("userId", "label", "features")


def _user_hash(first_digit: int, seed: int) -> Column:
    """Eight hex digits of a hash over seed and user, as a number."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col("userId")))
    return F.conv(F.substring(digest, first_digit, 8), 16, 10).cast("bigint")


def hash_split(
    table: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = SEED, folds: int = FOLDS
) -> DataFrame:
    """Adds `split` ('train' or 'test') and `fold`, both from the user id alone.

    Unlike a random split this does not change with the partitioning, the row
    order or a task that runs again.
    """
    in_train = _user_hash(1, seed) % 100 < train_percent
    return table.withColumns(
        {
            "split": F.when(in_train, "train").otherwise("test"),
            "fold": (_user_hash(9, seed) % folds).cast("int"),
        }
    )


def split_users_check(split: DataFrame, table: DataFrame) -> DataFrame:
    """What must hold of a split by users, whatever rows were drawn.

    Users of the table in both parts, in neither, in either, and users of a part
    that the table does not have, by semi- and anti-joins; one row.
    """
    train, test = (split.where(F.col("split") == part).select("userId") for part in ("train", "test"))
    users = table.select("userId")

    def counted(rows: DataFrame, name: str) -> DataFrame:
        return rows.distinct().agg(F.count(F.lit(1)).alias(name))

    both = counted(train.join(test, "userId", "left_semi"), "inBoth")
    neither = counted(users.join(split, "userId", "left_anti"), "inNeither")
    strange = counted(split.select("userId").join(users, "userId", "left_anti"), "unknown")
    held = counted(users.join(split, "userId", "left_semi"), "users")
    return held.withColumns(
        {c: frame.scalar() for c, frame in (("inBoth", both), ("inNeither", neither), ("unknown", strange))}
    )


def random_split(
    table: DataFrame, train_percent: int = TRAIN_PERCENT, seed: int = SEED
) -> DataFrame:
    """Adds `split` by `randomSplit`: reproducible on one layout of the table only.

    The parts are drawn one by one, so the table must be a materialized one: over
    a plan that runs again differently a user could come out twice or not at all.
    """
    train, test = table.randomSplit([train_percent / 100, 1 - train_percent / 100], seed=seed)
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test"))
    )


def split_label_rate(table: DataFrame) -> DataFrame:
    """Rows and mean label of each part of a split table."""
    return table.groupBy("split").agg(
        F.count(F.lit(1)).alias("users"), F.avg("label").alias("labelRate")
    )


def logistic_regression() -> LogisticRegression:
    return LogisticRegression(maxIter=REGRESSION_ITERATIONS, regParam=REGRESSION_REGULARIZATION)


def decision_tree() -> DecisionTreeClassifier:
    return DecisionTreeClassifier(seed=SEED)


def f1_evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="f1")


def tree_search(depths: list[int] = TREE_DEPTHS, keep_models: bool = False) -> CrossValidator:
    """Search over tree depth, cross-validated on the table's own `fold` column.

    With `keep_models` the result holds the models of all folds (`search_scores`).
    """
    tree = decision_tree()
    return CrossValidator(
        estimator=tree,
        estimatorParamMaps=ParamGridBuilder().addGrid(tree.maxDepth, depths).build(),
        evaluator=f1_evaluator(),
        numFolds=FOLDS,
        foldCol="fold",
        seed=SEED,
        parallelism=len(depths),
        collectSubModels=keep_models,
    )


def train_and_evaluate(
    train: DataFrame, test: DataFrame, estimator: Estimator, evaluator: Evaluator | None = None
) -> Evaluation:
    """Fit on train, predict test, score the predictions.

    For a search, the model of the result is the best one it found.
    """
    model = estimator.fit(train)
    model = getattr(model, "bestModel", model)
    predictions = model.transform(test)
    return Evaluation(model, predictions, (evaluator or f1_evaluator()).evaluate(predictions))


def weighted_f1(
    scored: DataFrame, label: str = "label", prediction: str = "prediction", by: list[str] | None = None
) -> DataFrame:
    """F1 of each class weighted by its support, as a plain aggregate: one row, or one per `by`.

    Rows shrink to one per (label, prediction) pair first. Each pair then counts
    once for the class it should have been and once for the class it was given.
    A row without a label or without a prediction is not scored, as neither class
    is known; `rows` counts the scored ones.
    """
    by = by or []
    known = scored.where(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    pairs = known.groupBy(
        *by,
        F.col(label).cast("double").alias("actual"),
        F.col(prediction).cast("double").alias("given"),
    ).agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    right = F.when(F.col("actual") == F.col("given"), F.col("n")).otherwise(none)
    views = F.array(
        F.struct(
            F.col("actual").alias("class"),
            F.col("n").alias("support"),
            none.alias("claimed"),
            right.alias("hits"),
        ),
        F.struct(
            F.col("given").alias("class"),
            none.alias("support"),
            F.col("n").alias("claimed"),
            none.alias("hits"),
        ),
    )
    classes = (
        pairs.select(*by, F.inline(views))
        .groupBy(*by, "class")
        .agg(*[F.sum(name).alias(name) for name in ("support", "claimed", "hits")])
    )
    f1 = F.try_divide(2 * F.col("hits"), F.col("support") + F.col("claimed"))
    return classes.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("support") * f1), F.sum("support")).alias("f1"),
        F.sum("support").alias("rows"),
    )


def best_params(evaluation: Evaluation) -> DataFrame:
    """Parameters of the evaluated model, one row each."""
    params = evaluation.model.extractParamMap()
    rows = sorted((param.name, str(value)) for param, value in params.items())
    spark = evaluation.predictions.sparkSession
    return spark.createDataFrame(rows, "param string, value string")


def describe(model: Model) -> str:
    """The settings a score depends on, read from the model itself."""
    params = {p.name: value for p, value in model.extractParamMap().items()}
    shown = [name for name in ("maxIter", "regParam", "maxDepth") if name in params]
    return ", ".join(f"{name}={params[name]}" for name in shown)


def score_table(evaluations: dict[str, Evaluation]) -> DataFrame:
    """One row per trained model with its settings and F1."""
    rows = [(name, describe(e.model), float(e.f1)) for name, e in evaluations.items()]
    spark = next(iter(evaluations.values())).predictions.sparkSession
    return spark.createDataFrame(rows, "model string, params string, f1 double")
