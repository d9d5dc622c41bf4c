"""Distributed LSD radix sort: places of rows by stable counting sorts, digit by digit.

Rows lie in blocks of consecutive places. A pass counts the digits of each block,
adds the counts up over (digit, block), which gives the place of the first row
with that digit of that block, and moves every row to that place plus the number
of such rows before it in its block. So rows with equal digits keep their order,
and after the pass over the highest digit the places are the final ranks. No task
sees more than the rows of one digit of one block, however often a key repeats.

Each pass is written to the shared folder, so a lost executor repeats one pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playtrail.llm.store import written

DIGIT_BITS = 11
BLOCK_ROWS = 1 << 12
LOWEST = -(2**63)


def ascending(key: Column) -> list[Column]:
    """Digits of a long, lowest first; a null comes after all numbers."""
    bits = F.coalesce(key, F.lit(0)).cast("long").bitwiseXOR(F.lit(LOWEST))
    mask = F.lit((1 << DIGIT_BITS) - 1).cast("long")
    digits = [
        F.shiftrightunsigned(bits, shift).bitwiseAND(mask).cast("int")
        for shift in range(0, 64, DIGIT_BITS)
    ]
    return [*digits, key.isNull().cast("int")]


def descending(key: Column) -> list[Column]:
    """Digits of a long without nulls, highest number first."""
    return ascending(F.bitwise_not(key.cast("long")))[:-1]


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with `_at`: places from 0 without gaps, in the order of the written files' tasks."""
    marked = written(
        rows.withColumns({"_task": F.spark_partition_id(), "_in": F.monotonically_increasing_id()}),
        "radix-input",
    )
    counts = marked.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_in").alias("_first"))
    earlier = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(  # one row per task
        "_task", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    place = F.col("_start") + F.col("_in") - F.col("_first")
    return marked.join(starts, "_task").select(*rows.columns, place.cast("long").alias("_at"))


def radix_sorted(rows: DataFrame, digits: list[Column], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows with `_at`, their place from 0 by the digits (the least significant first).

    Rows equal in all digits get neighbouring places in any order. Digits that are
    the same in all rows need no pass.
    """
    names = [f"_digit{i}" for i in range(len(digits))]
    state = _numbered(rows.withColumns(dict(zip(names, digits))))
    bounds = state.agg(*[f(n).alias(f.__name__ + n) for n in names for f in (F.min, F.max)]).first()
    passes = [n for n in names if bounds["min" + n] != bounds["max" + n]]
    for i, digit in enumerate(passes):
        blocks = state.withColumn("_block", F.expr(f"_at DIV {block_rows}"))
        counts = blocks.groupBy("_block", digit).agg(F.count(F.lit(1)).alias("_n"))
        totals = counts.groupBy(digit).agg(F.sum("_n").alias("_total"))
        lower = Window.orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
        base = totals.select(  # one row per value of a digit
            digit, F.coalesce(F.sum("_total").over(lower), F.lit(0)).alias("_base")
        )
        earlier = Window.partitionBy(digit).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (
            counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
            .join(base, digit)
            .select("_block", digit, (F.col("_before") + F.col("_base")).alias("_offset"))
        )
        within = Window.partitionBy("_block", digit).orderBy("_at")
        moved = (
            blocks.withColumn("_within", F.row_number().over(within) - 1)
            .join(offsets, ["_block", digit])
            .select(
                *rows.columns,
                *passes[i + 1 :],
                (F.col("_offset") + F.col("_within")).cast("long").alias("_at"),
            )
        )
        state = written(moved, "radix-pass")
    return state.select(*rows.columns, "_at")
