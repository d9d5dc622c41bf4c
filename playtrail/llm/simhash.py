"""SimHash fingerprints and their groups, by a pigeonring filter.

Two fingerprints within `max_bits` differing bits, cut into `max_bits` + 1
segments on a ring, have a segment from which every chain of consecutive segments
keeps its share: the first l segments differ in at most l * max_bits / segments
bits. So the first link of that chain is equal, and the first two differ in one bit
at most: both are the bucket key (32 bits of 64 where `max_bits` is 3), and of two
fingerprints whose second links differ, the one with the odd number of set bits
there also lies in the buckets of all its neighbours. The further links prune
candidates one after the other, and only what is left is compared as a whole.

Distinct fingerprints are compared, so copies cost nothing. A bucket above
`TILE` fingerprints is dealt in tiles, and each pair of tiles is a group of its
own; groups hand on a star per local component and not every pair.

Joins of tables that grow with the input ask for a merge of sorted shuffles: Spark
sizes an exploded table, and a written one, by compressed files, and what it then
takes for small may not fit the driver as a broadcast.

Defined results: a null text is an empty one, an empty text or one of white space
has fingerprint zero and links like any other; repeated rows share everything; a
row without an id has a fingerprint and its group's smallest id (null where the
group has none); an empty table gives an empty one. `simhash_groups` reads `doc_id`
and `text` alone, whatever other columns are called; `drop_near_copies` keeps all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.components import components
from playtrail.llm.store import written

SEED = 42
TILE = 1024
PAIRS_AT_ONCE = 500_000


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority of the bits of the shingles' XXH64, repeats included, as unsigned."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxh64_intdigest(b" ".join(words), SEED)
    rows = zip(*(words[i:] for i in range(shingle)))
    hashes = np.array([xxh64_intdigest(b" ".join(r), SEED) for r in rows], "<u8")
    set_bits = np.zeros(64, np.int64)
    for low in range(0, len(hashes), 100_000):
        some = hashes[low : low + 100_000].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, row: str | None = None) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long; with `row`, that column as `row` too."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]],
                names=["doc_id", "fp", *(["row"] if row else [])],
            )

    columns = [F.col("doc_id").cast("long"), F.col("text").cast("string")]
    return docs.select(*columns, *([F.col(row).alias("row")] if row else [])).mapInArrow(
        compute, "doc_id long, fp long" + (", row long" if row else "")
    )


def segment_widths(max_bits: int) -> list[int]:
    segments = max_bits + 1
    return [64 * (i + 1) // segments - 64 * i // segments for i in range(segments)]


def _merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Labels after joining u and v; a label is the least row of its component."""
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def chain_links(
    fps: np.ndarray, ends: np.ndarray, rotated: np.ndarray, widths: np.ndarray, max_bits: int
) -> np.ndarray:
    """Label of each row within its group; rows of a group end before `ends`.

    `rotated` begins with the bucket's segment; `widths` has each row's segments
    in ring order from there.
    """
    segments = widths.shape[1]
    label = np.arange(len(fps))
    row, held_u, held_v, held = np.arange(len(fps)), [], [], 0
    for distance in range(1, len(fps)):
        row = row[row + distance < ends[row]]
        if not len(row):
            break
        differ = rotated[row] ^ rotated[row + distance]
        near, passed = row, widths[row, 0].astype(np.uint64)
        for links in range(2, segments):  # the first link is equal in a bucket
            passed = passed + widths[near, links - 1].astype(np.uint64)
            head = np.bitwise_count(differ >> (np.uint64(64) - passed))
            keep = head <= links * max_bits // segments
            near, differ, passed = near[keep], differ[keep], passed[keep]
        near = near[np.bitwise_count(fps[near] ^ fps[near + distance]) <= max_bits]
        held_u.append(near)
        held_v.append(near + distance)
        held += len(near)
        if held > PAIRS_AT_ONCE:
            label = _merge(label, np.concatenate(held_u), np.concatenate(held_v))
            held_u, held_v, held = [], [], 0
    return _merge(label, np.concatenate(held_u), np.concatenate(held_v)) if held else label


def fingerprint_links(fps: DataFrame, max_bits: int = 3, tile: int = TILE) -> DataFrame:
    """Edges (a, b) that connect the distinct longs `fp` as links of `max_bits` do."""
    widths = segment_widths(max_bits)
    starts = [sum(widths[:i]) for i in range(len(widths))]

    def turned(i: int):
        if not starts[i]:
            return F.col("fp")
        return F.shiftleft("fp", starts[i]).bitwiseOR(F.shiftrightunsigned("fp", 64 - starts[i]))

    def bucket(i: int, width: int):
        second = widths[(i + 1) % len(widths)] if len(widths) > 1 else 0
        key = F.shiftrightunsigned(turned(i), 64 - width - second)
        keys = F.array(key)
        if second:
            odd = F.bit_count(key.bitwiseAND(F.lit((1 << second) - 1).cast("long"))) % 2 == 1
            flips = [key.bitwiseXOR(F.lit(1 << b).cast("long")) for b in range(second)]
            keys = F.when(odd, F.array(key, *flips)).otherwise(keys)
        return F.struct(F.lit(i).alias("at"), turned(i).alias("rotated"), keys.alias("keys"))

    buckets = F.explode(F.array(*[bucket(i, w) for i, w in enumerate(widths)]))
    rows = (
        fps.select("fp", buckets.alias("b"))
        .select("fp", "b.at", "b.rotated", F.explode("b.keys").alias("segment"))
        .select("fp", "at", "segment", "rotated")
    )
    shared = rows.groupBy("at", "segment").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    tiles = shared.select("at", "segment", F.ceil(F.col("n") / tile).cast("int").alias("tiles"))
    # Spark sizes `rows` as before the explodes, some 36 times too low, and might broadcast it.
    dealt = rows.join(tiles.hint("merge"), ["at", "segment"]).withColumn(
        "own", F.pmod(F.xxhash64("fp"), "tiles").cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    group = ["at", "segment", "first", "second"]
    grouped = (
        dealt.withColumn("other", other)
        .withColumns({"first": F.least("own", "other"), "second": F.greatest("own", "other")})
        .select(*group, "fp", "rotated")
        .repartition(*group)
        .sortWithinPartitions(*group)
    )
    ring = np.array([widths[i:] + widths[:i] for i in range(len(widths))])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None

        def edges(columns: list[np.ndarray], bounds: np.ndarray) -> pa.RecordBatch:
            fp, rotated = columns[4].view(np.uint64), columns[5].view(np.uint64)
            ends = np.repeat(bounds[1:], np.diff(bounds))
            label = chain_links(fp, ends, rotated, ring[columns[0]], max_bits)
            far = label != np.arange(len(fp))
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[4][far]), pa.array(columns[4][label[far]])], names=["a", "b"]
            )

        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if kept is not None:
                columns = [np.concatenate(pair) for pair in zip(kept, columns)]
            n = len(columns[0])
            changes = np.zeros(n, bool)
            for c in columns[:4]:
                changes[1:] |= c[1:] != c[:-1]
            bounds = np.concatenate([[0], np.flatnonzero(changes)])
            kept = [c[bounds[-1] :] for c in columns]
            if len(bounds) > 1:
                yield edges([c[: bounds[-1]] for c in columns], bounds)
        if kept is not None and len(kept[0]):
            yield edges(kept, np.array([0, len(kept[0])]))

    return grouped.mapInArrow(link, "a long, b long")


def _rooted(distinct: DataFrame, max_bits: int) -> DataFrame:
    """The distinct fingerprints with the `root` of their group, the least fingerprint."""
    roots = components(fingerprint_links(distinct, max_bits))
    return distinct.join(roots.hint("merge"), distinct.fp == roots.node, "left").select(
        *distinct.columns, F.coalesce("root", "fp").alias("root")
    )


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row."""
    prints = written(fingerprints(docs, shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    rooted = _rooted(distinct, max_bits)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(groups.hint("merge"), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def drop_near_copies(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each group: the first of its smallest id, or of its rows without one.

    Rows are told apart by a number that is written with them, so what an id says
    of other rows, or that it is missing, plays no part.
    """
    row = "_row"
    while row in {c.lower() for c in docs.columns}:
        row = "_" + row
    numbered = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    prints = fingerprints(numbered, shingle, row)
    distinct = written(prints.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    kept = (
        _rooted(distinct, max_bits)
        .groupBy("root")
        .agg(F.min("first").alias("first"))
        .select(F.col("first.row").alias(row))
    )
    return numbered.join(kept, row, "left_semi").drop(row)
