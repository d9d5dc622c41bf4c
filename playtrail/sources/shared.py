"""Tables written once to shared storage and read back.

A model fit passes over its input many times, and a study reports on one user
table many times. Writing that table cuts the lineage back to the log, so a
lost executor costs a re-read and not another pass over all events. Parquet
keeps the later passes column-pruned.
"""

from __future__ import annotations

import uuid

from pyspark.ml.util import DefaultParamsReader, MLReadable, MLWritable
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; a session that names none is refused.

    A folder of the driver's own machine would be invisible to the executors, and
    nobody but the caller knows one that all of them reach.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder.rstrip("/")


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and return the written table."""
    path = new_shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_model(spark: SparkSession, model: MLWritable, name: str) -> str:
    """Write a fitted model to the shared folder; the path to load it from."""
    path = new_shared_path(spark, name)
    model.write().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> MLReadable:
    """The model at that path, of whatever class was saved, in this or another session."""
    return DefaultParamsReader.loadParamsInstance(path, spark)
