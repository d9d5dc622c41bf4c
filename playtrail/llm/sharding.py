"""Jump consistent hashing of stable keys to shards, in SQL expressions.

The shard of a key is a function of the key and the number of shards alone, no
table of ring positions. With one shard more, a key either stays or moves to the
new shard, and the latter for about one key in the new number.

Defined results: a null key counts as key 0; a null text as no bytes; equal keys
share a shard and differ in slot; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The multiplier and the modulus of the generator in the jump hash.
MULTIPLIER = 2862933555777941757
MODULUS = 18446744073709551616
HIGH_BITS = 8589934592
ROWS_PER_BLOCK = 100_000


def _step(state: str) -> str:
    """The generator's next state, in decimals, as unsigned 64-bit numbers exceed a long."""
    return (
        f"CAST((CAST({state} AS DECIMAL(20,0)) * CAST({MULTIPLIER} AS DECIMAL(19,0)) + 1)"
        f" % CAST({MODULUS} AS DECIMAL(20,0)) AS DECIMAL(20,0))"
    )


def _unsigned(key: str) -> str:
    return f"CAST(pmod(CAST(coalesce({key}, 0) AS DECIMAL(20,0)), {MODULUS}BD) AS DECIMAL(20,0))"


def jump_shard(key: str, shards: int) -> Column:
    """Shard 0 to `shards` - 1 of a long key.

    A candidate shard leaps ahead until it passes the last; it advances by one at
    least, so `shards` rounds always suffice and later ones change nothing.
    """
    next_state = _step("s.state")
    leap = (
        "CAST(floor((s.next + 1) * (2147483648.0D / CAST("
        f"({next_state} DIV {HIGH_BITS}BD) + 1 AS DOUBLE))) AS BIGINT)"
    )
    return F.expr(
        f"""CAST(aggregate(
          sequence(1, {shards} + 1),
          named_struct('state', {_unsigned(key)}, 'shard', -1L, 'next', 0L),
          (s, i) -> IF(s.next >= {shards}, s, named_struct(
            'state', {next_state}, 'shard', s.next, 'next', {leap})),
          s -> s.shard) AS INT)"""
    )


def shard_rows(
    rows: DataFrame, shards: int, key: str = "doc_id", rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Rows with `shard`, `grown_shard` (with one more) and `slot`, gapless in a shard.

    Slots are numbered by block and then by key. A block holds about `rows_per_block`
    rows of any shard, so a shard is never sorted as a whole. Blocks go by a hash of
    the whole row, so that different rows of one key, or without a key, are spread.
    """
    blocks = max(1, -(-rows.count() // rows_per_block))
    block = {"_block": F.pmod(F.xxhash64(*rows.columns), F.lit(blocks))}
    placed = rows.withColumns({"shard": jump_shard(key, shards)} | block)
    counts = placed.groupBy("shard", "_block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        "shard", "_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    others = [c for c in rows.columns if c != key]
    order = Window.partitionBy("shard", "_block").orderBy(key, *others)
    numbered = placed.withColumn("_within", F.row_number().over(order) - 1)
    return (
        numbered.join(before, ["shard", "_block"])
        .withColumns(
            {
                "slot": (F.col("_within") + F.col("_before")).cast("long"),
                "grown_shard": jump_shard(key, shards + 1),
            }
        )
        .select(*rows.columns, "shard", "slot", "grown_shard")
    )


def shard_documents(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Size, checksum, shard and slot of each document, by its id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    measured = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shard_rows(measured, shards).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
