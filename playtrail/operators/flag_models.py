"""Models on a few 0/1 inputs per user.

With so few distinct inputs a table of cells says all there is to say about a
model: its prediction for each cell, and how many users of either label the cell
holds. A tree deep enough, and a regression on inputs that do not work against
each other, predict the majority of each cell of the training rows.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class PageWindow(NamedTuple):
    """Visits of a page, by its flag, on days from `first` to `last`; None is no bound."""

    flag: str
    first: date | None = None
    last: date | None = None


def user_flags(rollup: DataFrame, windows: dict[str, PageWindow]) -> DataFrame:
    """Per user `churned`, and 1 for each window the user has a visit in, from daily sums."""
    columns = [F.sum("churn").alias("churned")]
    for name, window in windows.items():
        inside = F.col(window.flag) > 0
        if window.first is not None:
            inside &= F.col("day") >= F.lit(window.first)
        if window.last is not None:
            inside &= F.col("day") <= F.lit(window.last)
        columns.append(F.max(F.when(inside, 1).otherwise(0)).alias(name))
    return rollup.groupBy("userId").agg(*columns)


def flag_table(users: DataFrame, names: list[str]) -> DataFrame:
    """`userId`, `label`, the flags, and their `features` vector."""
    labelled = users.withColumn("label", (F.col("churned") > 0).cast("double"))
    assembler = VectorAssembler(inputCols=names, outputCol="features")
    return assembler.transform(labelled).select("userId", "label", *names, "features")


def prediction_cells(predictions: DataFrame, names: list[str]) -> DataFrame:
    """Per cell of the flags and prediction: the users in it and how many cancelled."""
    return predictions.groupBy(*names, F.col("prediction").cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("users"), F.sum(F.col("label").cast("long")).alias("cancelled")
    )
