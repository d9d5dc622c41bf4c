"""Written tables in the shared folder, and what workers need to run this package.

Every operator that reads an intermediate result twice writes it once as Parquet
below `spark.checkpoint.dir`, which all executors reach. That cuts the lineage:
a lost executor costs a re-read of files, not a recomputation, and no block lives
on one executor only.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

REPOSITORY = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def scratch_root(spark: SparkSession) -> str:
    """`spark.checkpoint.dir`; a session that names none is refused, as no folder is known to be shared."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, path: str | None = None, **options: str) -> DataFrame:
    """The frame, written once to the shared folder and read back."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a table that this package wrote and nothing reads any more."""
    if not path.startswith(scratch_root(spark) + "/"):
        raise ValueError(f"{path} is not in the shared folder")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where the driver found it.

    Edits the `PYTHONPATH` of the caller's Spark context, which Spark hands to new
    workers: this repository is added to it. On a cluster the package is installed
    or shipped with `--py-files`, and the addition changes nothing.
    """
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if REPOSITORY not in known.split(os.pathsep):
        paths = [REPOSITORY, *([known] if known else [])]
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(paths)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
