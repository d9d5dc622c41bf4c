"""Best-fit packing of token pieces into sequences of one capacity.

The plan needs only how many pieces have each length: at most `capacity`
numbers, however large the corpus. It opens a sequence with the longest piece
left, looks up whether one, two or three lengths fill the gap exactly (single
lengths, an index of pair sums, and both together for triples, always under what
is still available), and otherwise places the longest piece that fits and looks
again. Each such pattern is used as often as the counts allow, so the plan is
short, and every piece finds its place by its length and its rank among the
pieces of that length.

Defined results: a null text is an empty one, which is one piece (the end id);
equal lengths are ranked in the order of the written pieces, so ties and repeated
rows each get a place of their own; an empty table gives an empty one; columns of
the input other than the id and text columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playtrail.llm.store import written
from playtrail.llm.tokens import encoder

RANK_BITS = 40
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """Cut the ids of each document, `end_id` last, into pieces of at most `capacity`."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                data = ids.tobytes() + int(end_id).to_bytes(4, "little")
                for piece, low in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[low : low + 4 * capacity]
                    rows.append((doc_id, piece, low // 4, len(part) // 4, zlib.crc32(part)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        pieces, PIECES
    )


class _Lengths:
    """How many pieces of each length are left, and which sums two of them make."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.copy()
        there = (counts > 0).astype(np.float64)
        size = len(counts)
        ordered = np.rint(np.fft.irfft(np.fft.rfft(there, 2 * size) ** 2, 2 * size))[:size]
        twice = np.zeros(size)
        twice[::2] = there[: (size + 1) // 2]
        self.pairs = ((ordered + twice) / 2).astype(np.int64)

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if n and not self.left[length]:
            others = np.flatnonzero(self.left > 0)
            sums = np.append(others, length) + length
            self.pairs[sums[sums < len(self.pairs)]] -= 1

    def pair(self, gap: int, free: np.ndarray) -> tuple[int, ...]:
        """Two lengths of that sum, as unequal as possible."""
        if gap < 2 or self.pairs[gap] <= 0:
            return ()
        small = np.arange(1, gap // 2 + 1)
        both = (free[small] > 0) & (free[gap - small] > 0)
        if gap % 2 == 0:
            both[-1] &= free[gap // 2] > 1
        at = np.flatnonzero(both)
        return (gap - int(small[at[0]]), int(small[at[0]])) if len(at) else ()

    def exact(self, gap: int, free: np.ndarray) -> tuple[int, ...]:
        if free[gap] > 0:
            return (gap,)
        if found := self.pair(gap, free):
            return found
        first = np.flatnonzero(free[: gap - 1] > 0)[::-1]
        for a in first[self.pairs[gap - first] > 0]:
            free[a] -= 1
            found = self.pair(gap - int(a), free)
            free[a] += 1
            if found:
                return (int(a), *found)
        return ()


def plan_patterns(counts: np.ndarray, capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns as ([(length, copies)...], number of sequences), given counts by length."""
    lengths = _Lengths(np.asarray(counts, np.int64))
    plan = []
    top = capacity
    while True:
        while top > 0 and lengths.left[top] <= 0:
            top -= 1
        if not top:
            return plan
        free = lengths.left.copy()
        free[top] -= 1
        runs, gap = [(top, 1)], capacity - top
        while gap:
            exact = lengths.exact(gap, free)
            if exact:
                runs += [(length, 1) for length in exact]
                break
            fits = np.flatnonzero(free[1 : gap + 1] > 0)
            if not len(fits):
                break
            length = int(fits[-1]) + 1
            # While three pieces can't fill the gap, many of one length go in at once.
            copies = max(1, min(int(free[length]), gap // length - 3))
            runs.append((length, copies))
            free[length] -= copies
            gap -= length * copies
        used: dict[int, int] = {}
        for length, copies in runs:
            used[length] = used.get(length, 0) + copies
        times = min(int(lengths.left[length]) // n for length, n in used.items())
        for length, n in used.items():
            lengths.take(length, times * n)
        plan.append((runs, times))


def _places(plan: list[tuple[list[tuple[int, int]], int]], capacity: int) -> tuple:
    """For ranges of (length, rank), sorted: first key, sequence, copies in each, offset."""
    next_rank = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for runs, times in plan:
        offset = 0
        for length, copies in runs:
            rows.append(((length << RANK_BITS) | int(next_rank[length]), sequence, copies, offset))
            next_rank[length] += times * copies
            offset += length * copies
        sequence += times
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 4


def pack(pieces: DataFrame, capacity: int, length: str = "length") -> DataFrame:
    """The pieces with `sequence_id` and `offset`; lengths are 1 to `capacity`.

    The pieces are written once, numbered by the writing task. A rank within a
    length is then a rank within (task, length) plus a sum over earlier tasks, so
    no task sees all pieces of a common length.
    """
    own = pieces.columns
    table = written(
        pieces.withColumns({"_part": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}),
        "pieces",
    )
    by_part = table.groupBy("_part", length).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(length).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select(
        "_part", length, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    # At most `capacity` rows.
    histogram = table.groupBy(length).agg(F.count(F.lit(1)).alias("_n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in histogram:
        counts[row[length]] = row["_n"]
    keys, sequences, copies, offsets = _places(plan_patterns(counts, capacity), capacity)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(length).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
            key = (size << RANK_BITS) | rank
            at = np.searchsorted(keys, key, "right") - 1
            nth = key - keys[at]
            columns = [batch.column(c) for c in own]
            columns.append(pa.array(sequences[at] + nth // copies[at]))
            columns.append(pa.array(offsets[at] + nth % copies[at] * size))
            yield pa.RecordBatch.from_arrays(columns, names=[*own, "sequence_id", "offset"])

    within = F.row_number().over(Window.partitionBy("_part", length).orderBy("_row")) - 1
    ranked = table.withColumn("_within", within).join(before, ["_part", length])
    ranked = ranked.withColumn("_rank", F.col("_within") + F.col("_before"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.select(*own, "_rank").mapInArrow(
        place, f"{schema}, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096) -> DataFrame:
    """All documents as pieces with their places in sequences."""
    return pack(token_pieces(docs, tokenizer, end_id, capacity), capacity)
