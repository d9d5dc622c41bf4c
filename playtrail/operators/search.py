"""What a search over tree depths saw: every prediction of every fold, as one table."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.operators.model import weighted_f1


def search_predictions(search: CrossValidatorModel, train: DataFrame) -> DataFrame:
    """(fold, maxDepth, label, prediction) of each fold's held-out rows by each of its models.

    The search must have kept its sub-models, and `train` be the table it was
    fitted on. A fold's rows are read once for all of its models.
    """
    parts = []
    for fold, models in enumerate(search.subModels):
        held_out = train.where(F.col("fold") == fold)
        depths = [model.getMaxDepth() for model in models]
        for depth, model in zip(depths, models):
            # A copy, as the search's own models keep their column names.
            named = model.copy({model.predictionCol: f"depth{depth}"})
            named.setProbabilityCol("").setRawPredictionCol("")
            held_out = named.transform(held_out)
        views = F.array(
            *[F.struct(F.lit(d).alias("maxDepth"), F.col(f"depth{d}").alias("prediction")) for d in depths]
        )
        parts.append(held_out.select("fold", "label", F.inline(views)))
    return reduce(DataFrame.unionByName, parts).select("fold", "maxDepth", "label", "prediction")


def search_scores(search: CrossValidatorModel, train: DataFrame) -> DataFrame:
    """F1 per fold and depth, each depth's mean over the folds, and whether it was chosen.

    All scores come from one aggregation over the predictions. `chosen` is read
    off the search's best model.
    """
    scores = weighted_f1(search_predictions(search, train), by=["fold", "maxDepth"])
    means = scores.groupBy("maxDepth").agg(F.avg("f1").alias("meanF1"))
    best = search.bestModel.getMaxDepth()
    return (
        scores.join(means, "maxDepth")
        .withColumn("chosen", (F.col("maxDepth") == best).cast("int"))
        .select("fold", "maxDepth", "rows", "f1", "meanF1", "chosen")
    )
