"""Importance resampling of documents towards a target distribution.

A text's features are its runs of one to three words, hashed into buckets. Each
bucket has a gain: the log ratio of its share in the target texts to its share in
all documents. A document's weight is the sum of its features' gains, looked up in
one array; with Gumbel noise drawn from its id the weight becomes a score, and the
highest scores are a sample without replacement in proportion to exp(weight).

Texts are read twice where they lie, once to count and once to score, and never
shuffled: a task sends one number per bucket. Scores are ranked by a distributed
radix sort over (score, id), so neither one task nor the driver holds the rows.

Defined results: a null or empty text has no features and weight 0; a null id is
drawn as `42:null` and comes after all others with its score; rows equal in score
and id take neighbouring ranks in any order; without target texts all gains still
follow the formula (T = 0); an empty table gives an empty one; other columns of
the input are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.radix import ascending, descending, radix_sorted
from playtrail.llm.store import written

BUCKETS = 10_000
SCALE = 1000
SEED = 42
MIN_WORDS = 20
PERCENT = 5
SLICE_BYTES = 8_000_000
LONGEST = 48

_WORD = np.ones(256, bool)
_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

_SHIFTS: list[np.ndarray] = []


def _shifts() -> np.ndarray:
    """[length, byte place, byte]: a checksum's change when that many zero bytes follow it."""
    if not _SHIFTS:
        table = np.zeros((LONGEST + 1, 4, 256), np.uint32)
        one = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
        for place in range(4):
            value = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
            for length in range(LONGEST + 1):
                table[length, place] = value
                value = one[value & np.uint32(255)] ^ (value >> np.uint32(8))
        _SHIFTS.append(table)
    return _SHIFTS[0]


def _followed(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of two strings in a row, from those of each and the second's length."""
    table = _shifts()
    step = np.minimum(length, LONGEST)
    moved = (
        table[step, 0, first & np.uint32(255)]
        ^ table[step, 1, (first >> np.uint32(8)) & np.uint32(255)]
        ^ table[step, 2, (first >> np.uint32(16)) & np.uint32(255)]
        ^ table[step, 3, first >> np.uint32(24)]
    )
    more = np.flatnonzero(length > LONGEST)
    while len(more):
        moved[more] = _followed(moved[more], np.uint32(0), np.minimum(length[more] - LONGEST, LONGEST))
        length = length - LONGEST
        more = more[length[more] > LONGEST]
    return moved ^ second


def word_checksums(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all words in a row: checksum, that with a space before, length with it; ends per text."""
    closed = pc.binary_join_element_wise(pc.fill_null(texts, ""), "", "\n")
    offsets = np.frombuffer(closed.buffers()[1], np.int32)[closed.offset : closed.offset + len(closed) + 1]
    data = np.frombuffer(closed.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    data = np.where((data >= 0x41) & (data <= 0x5A), data + 0x20, data)
    inside = _WORD[data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
    # Every text ends in a line break, so each word that starts also ends.
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    letters = data[inside]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(sizes)])), pa.py_buffer(letters)]
    )
    coded = words.dictionary_encode()
    known = coded.dictionary.to_pylist()
    plain = np.fromiter(map(zlib.crc32, known), np.uint32, len(known))
    spaced = np.fromiter((zlib.crc32(b" " + w) for w in known), np.uint32, len(known))
    index = coded.indices.to_numpy(zero_copy_only=False)
    last = np.searchsorted(starts, offsets[1:] - offsets[0])
    return plain[index], spaced[index], sizes + 1, last


def feature_buckets(texts: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of the texts: first row, words per text, and (text, bucket) of every feature."""
    sizes = np.cumsum(pc.binary_length(pc.fill_null(texts, "")).to_numpy(zero_copy_only=False)) // SLICE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1), len(texts)]
    for low, high in zip(cuts, cuts[1:]):
        if high == low:
            continue
        run, spaced, lengths, last = word_checksums(texts.slice(low, high - low))
        words = np.diff(last, prepend=0)
        text = np.repeat(np.arange(high - low), words)
        owners, found = [text], [run % np.uint32(buckets)]
        for n in (1, 2):
            # The run of n + 1 words from each place, where all are of one text.
            run = _followed(run[:-1], spaced[n:], lengths[n:]) if len(run) > 1 else run[:0]
            same = text[: len(run)] == text[n : n + len(run)]
            owners.append(text[: len(run)][same])
            found.append(run[same] % np.uint32(buckets))
        yield low, words, np.concatenate(owners), np.concatenate(found).astype(np.int64)


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket; one row per bucket is collected."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, _, found in feature_buckets(batch.column(0), buckets):
                total += np.bincount(found, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    counted = (
        texts.select(F.col(column).cast("string"))
        .mapInArrow(count, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros(buckets, np.int64)
    for row in counted:
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The gain of each bucket, as whole numbers."""
    n = len(source)
    above, below = float(source.sum() + n), float(target.sum() + n)
    return np.array(
        [
            math.floor(scale * math.log((float(t) + 1) * above / ((float(s) + 1) * below)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED, scale: int = SCALE) -> int:
    """Gumbel noise of an id, as a whole number."""
    name = f"{seed}:{'null' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-scale * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_features, weight, score, n_words) of every document."""
    names = ["doc_id", "n_features", "weight", "score", "n_words"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for low, words, owners, found in feature_buckets(batch.column(1), len(gain)):
                some = ids.slice(low, len(words))
                # Sums of whole numbers below 2**53 are exact in doubles.
                weight = np.bincount(owners, gain[found], len(words)).astype(np.int64)
                drawn = np.array([noise(i) for i in some.to_pylist()], np.int64)
                features = np.bincount(owners, minlength=len(words))
                columns = [features, weight, weight + drawn, words.astype(np.int64)]
                yield pa.RecordBatch.from_arrays([some, *map(pa.array, columns)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        score, ", ".join(f"{n} long" for n in names)
    )


def resample(
    docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Every document with its weight and score; `rank` is set where it is drawn."""
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = written(score_documents(docs, gain), "scores")
    enough = F.col("n_words") >= min_words
    drawn = percent * scored.where(enough).count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    digits = [*ascending(F.col("doc_id")), *descending(F.col("score"))]
    ranked = radix_sorted(scored.where(enough).select(*columns), digits)
    rank = F.when(F.col("_at") < drawn, F.col("_at") + 1)
    others = scored.where(~enough).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(others)
