"""Sources of the activity log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    FloatType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from playtrail.schema import ACTIVITY, ACTIVITY_COLUMNS

# Without any value of these, cleaning would leave nothing; a log without pages is legal.
NEEDED = ("userId", "sessionId", "ts")
CORRUPT = "_corrupt_record"
# Every field as the text it stands as, so that no value is lost before it is looked at.
ACTIVITY_TEXT = StructType(
    [*(StructField(name, StringType()) for name in ACTIVITY_COLUMNS), StructField(CORRUPT, StringType())]
)


class ReadReport:
    """What the pass that read a log saw, once an action has run on it.

    Rows, rejected rows, and values per field, counted beside the read by
    `DataFrame.observe` and not by a pass of their own. The first action that reads
    all of the log fills the report; one that stops early counts what it has read.
    Counting every field means reading every field.
    """

    def __init__(self, name: str = "activity"):
        self.observation = Observation(name)

    def attach(self, df: DataFrame, rejected: Column) -> DataFrame:
        return df.observe(
            self.observation,
            F.count(F.lit(1)).alias("rows"),
            F.count(rejected).alias("rejected"),
            *[F.count(name).alias(name) for name in ACTIVITY_COLUMNS],
        )

    @property
    def rows(self) -> int:
        return self.observation.get["rows"]

    @property
    def rejected(self) -> int:
        return self.observation.get["rejected"]

    @property
    def values(self) -> dict[str, int]:
        """Values per field that fit its declared type."""
        return {name: self.observation.get[name] for name in ACTIVITY_COLUMNS}

    def require(self, *names: str) -> None:
        """Raise if there are rows and one of the fields has no value in any."""
        empty = [name for name in names or NEEDED if self.rows and not self.values[name]]
        if empty:
            raise ValueError("activity log has no value of: " + ", ".join(empty))


def read_activity(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "json",
    on_reject: str = "fail",
    report: ReadReport | None = None,
) -> DataFrame:
    """Scan an activity log stored as JSON lines or Parquet.

    A value that does not fit its declared type, or a line that is no JSON, makes
    a *rejected* row. Numbers written as text and whole numbers written as floats
    fit. With `on_reject="fail"` a query over such a row raises an error; with
    `"null"` the values become nulls, as in `rejected_activity`, which lists those
    rows. Nothing runs before the caller's action; a `report` counts rows, rejects
    and values during it, and `report.require()` then refuses a log without users,
    sessions or times. A Parquet path that lacks a declared column is refused here.
    """
    if on_reject not in ("fail", "null"):
        raise ValueError(f"unknown on_reject {on_reject!r}; expected 'fail' or 'null'")
    typed = _typed(spark, path, fmt)
    checked = "rejected" in typed.columns
    if report is not None:
        typed = report.attach(typed, F.col("rejected") if checked else F.lit(None).cast("string"))
    if on_reject == "fail" and checked:
        # In the filter, so that no pruning of columns can leave it out.
        error = F.raise_error(F.concat(F.lit("rejected activity row: "), "rejected"))
        typed = typed.where(F.when(F.col("rejected").isNull(), True).otherwise(error.cast("boolean")))
    return typed.select(*ACTIVITY_COLUMNS)


def rejected_activity(spark: SparkSession, path: str | list[str], fmt: str = "json") -> DataFrame:
    """The rows that `read_activity` rejects, with what is wrong as `rejected`."""
    typed = _typed(spark, path, fmt)
    if "rejected" not in typed.columns:
        typed = typed.withColumn("rejected", F.lit(None).cast("string"))
    return typed.where(F.col("rejected").isNotNull())


def _paths(path: str | list[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def _typed(spark: SparkSession, path: str | list[str], fmt: str) -> DataFrame:
    """The log by its declared types, and `rejected` where a value could fail to fit."""
    if fmt == "json":
        return _cast_all(spark.read.schema(ACTIVITY_TEXT).json(_paths(path)))
    if fmt == "parquet":
        # Each path by its own schema; a merged one would hide what a single path lacks.
        frames = [_cast_all(spark.read.parquet(p)) for p in _paths(path)]
        if any("rejected" in f.columns for f in frames) or len(frames) > 1:
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return frames[0]
    raise ValueError(f"unknown activity format {fmt!r}; expected 'json' or 'parquet'")


def _cast_all(df: DataFrame) -> DataFrame:
    held = {f.name: f.dataType for f in df.schema.fields}
    absent = [f"{f.name} {f.dataType.simpleString()}" for f in ACTIVITY.fields if f.name not in held]
    if absent:
        raise ValueError("activity log lacks: " + ", ".join(absent))
    values, wrong = [], []
    for field in ACTIVITY.fields:
        value = F.col(field.name)
        if held[field.name] != field.dataType:
            value = _cast(field)
            if not isinstance(held[field.name], IntegralType | FloatType) or isinstance(field.dataType, LongType):
                text = F.concat(F.lit(f"{field.name}="), F.col(field.name).cast("string"))
                wrong.append(F.when(F.col(field.name).isNotNull() & value.isNull(), text))
        values.append(value.alias(field.name))
    if CORRUPT in held:
        wrong.insert(0, F.when(F.col(CORRUPT).isNotNull(), F.lit("no JSON")))
    if wrong:
        reasons = F.concat_ws(", ", *wrong)
        values.append(F.when(reasons != "", reasons).alias("rejected"))
    return df.select(*values)


def _cast(field: StructField) -> Column:
    """The value by its declared type, null where it does not fit."""
    value = F.col(field.name).cast("string")
    if not isinstance(field.dataType, LongType):
        return value.try_cast(field.dataType)
    # Through a decimal, as a double would round whole numbers above 2**53.
    number = value.try_cast(DecimalType(38, 18))
    whole = F.when(number == F.floor(number), number.try_cast(LongType()))
    return F.coalesce(value.try_cast(LongType()), whole)


ABSENT = "absent"


def schema_by_file(spark: SparkSession, path: str | list[str], fmt: str = "parquet") -> DataFrame:
    """Per file and declared column: the declared type, the type found, and how the values fit.

    `rows` and `values` count the file's rows and the column's non-null values, and
    `misfits` those of them that do not fit the declared type (what `read_activity`
    rejects). `found` is, for Parquet, the type the file's path holds, and for JSON
    the narrowest of bigint, double and string that takes all of the file's values;
    either is "absent" where there is no such column, or no value of it in a JSON
    file. All files are reconciled in one aggregation over the log.
    """
    names = [f.name for f in ACTIVITY.fields]
    if fmt == "json":
        text = spark.read.schema(ACTIVITY_TEXT).json(_paths(path))
        # What does not parse as a row at all has no values.
        return _reconciled([(text.select("*", "_metadata.file_path"), dict.fromkeys(names))])
    if fmt != "parquet":
        raise ValueError(f"unknown activity format {fmt!r}; expected 'json' or 'parquet'")
    frames = []
    for p in _paths(path):
        df = spark.read.parquet(p)
        held = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        columns = [F.col(n) if n in held else F.lit(None).cast("string").alias(n) for n in names]
        frames.append((df.select(*columns, "_metadata.file_path"), {n: held.get(n, ABSENT) for n in names}))
    return _reconciled(frames)


def _reconciled(frames: list[tuple[DataFrame, dict[str, str | None]]]) -> DataFrame:
    reports = []
    for df, found in frames:
        counts = [F.count(F.lit(1)).alias("rows")]
        for field in ACTIVITY.fields:
            name, value = field.name, F.col(field.name).cast("string")
            counts += [
                F.count(name).alias(f"{name}_values"),
                F.count(F.when(F.col(name).isNotNull() & _cast(field).isNull(), 1)).alias(f"{name}_misfits"),
                F.count(value.try_cast("bigint")).alias(f"{name}_bigint"),
                F.count(value.try_cast("double")).alias(f"{name}_double"),
            ]
        files = df.groupBy("file_path").agg(*counts)
        rows = []
        for field in ACTIVITY.fields:
            name = field.name
            values = F.col(f"{name}_values")
            seen = (
                F.when(values == 0, ABSENT)
                .when(values == F.col(f"{name}_bigint"), "bigint")
                .when(values == F.col(f"{name}_double"), "double")
                .otherwise("string")
            )
            rows.append(
                F.struct(
                    F.lit(name).alias("column"),
                    F.lit(field.dataType.simpleString()).alias("declared"),
                    (seen if found[name] is None else F.lit(found[name])).alias("found"),
                    "rows",
                    values.alias("values"),
                    F.col(f"{name}_misfits").alias("misfits"),
                )
            )
        reports.append(files.select(F.col("file_path").alias("file"), F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, reports)


def missing_columns(df: DataFrame) -> list[str]:
    """Declared columns the frame lacks or holds with another type."""
    held = {field.name: field.dataType for field in df.schema.fields}
    return [
        f"{field.name} {field.dataType.simpleString()}"
        for field in ACTIVITY.fields
        if held.get(field.name) != field.dataType
    ]


def require_columns(df: DataFrame) -> DataFrame:
    """The frame itself, or an error naming what an activity log must hold."""
    missing = missing_columns(df)
    if missing:
        raise ValueError("activity log lacks: " + ", ".join(missing))
    return df


def schema_report(df: DataFrame) -> DataFrame:
    """Columns of a frame with type and nullability, one row each."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, nullable boolean")
