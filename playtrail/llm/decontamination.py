"""Benchmark passages in documents, found by spaced seeds.

A seed is a window of words of which a fixed mask reads some and ignores the
others, so a substituted word spoils only the windows that read it. Tables of seed
hashes, one of the benchmark and one of the documents, are joined; each match names
an item and a diagonal (place in the document less place in the item), and along
that diagonal the words are compared: a stretch, one for a match and `PENALTY` off
for a substitution, must hold `MIN_WORDS` matching words (or `MIN_SHARE` of a
shorter item). An item shorter than the shortest mask is one seed, all of its words.

Documents are read once. A window goes into the join only if its hash may be one of
the benchmark's: that is looked up in a bitmap of `FILTER_BITS` bits, which is built
by Spark from the benchmark's hashes and has a fixed size (8 MB), so what is sent to
the tasks does not grow. What a full bitmap lets pass in vain costs a larger join
and no result. Seed hashes are salted, so that a passage in a third of all documents
is spread over `SALTS` tasks, and verified stretches are cut out of documents and
items where they lie: no task holds the benchmark and no text comes to the driver.

Every stretch is reported that overlaps no better one of the same item in the same
document; of stretches with as many matching words the first is the better one.

Defined results: null and empty texts, on either side, match nothing; repeated
documents are reported each, repeated items each; rows without an id are reported
with a null id; an empty table on either side gives an empty result; other columns
are not read by `find_overlaps` and kept by `drop_contaminated`. The latter judges
texts, so equal texts share its verdict, and it drops for items of five words or
more, and for shorter ones only a document that has no other word.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.store import written
from playtrail.llm.words import coded_words

# In 13 words with any two substituted, some window of the second reads neither of them; the
# first finds short verbatim runs, the third other spacings.
MASKS = ("11111", "11001011", "1101011")
SHORTEST = min(map(len, MASKS))
MIN_WORDS = 12
MIN_SHARE = 0.8
PENALTY = 2
FILTER_BITS = 26
SALTS = 16
WORD_BYTES = 4


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def seed_hashes(codes: np.ndarray, mask: str) -> np.ndarray:
    """One hash for each window start; codes are 64-bit numbers of words."""
    n = len(codes) - len(mask) + 1
    h = np.zeros(max(n, 0), np.uint64)
    for k, read in enumerate(mask):
        if read == "1" and n > 0:
            h = _mix(h * np.uint64(3) + codes[k : k + n])
    return _mix(h ^ np.uint64(int(mask, 2)))


def best_stretch(same: np.ndarray) -> tuple[int, int, int]:
    """Matches, start and end of the best scoring stretch of a row of (mis)matches."""
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -PENALTY))])
    rise = total - np.minimum.accumulate(total)
    end = int(rise.argmax())
    start = int(total[: end + 1].argmin())
    return int(same[start:end].sum()), start, end


def stretches(same: np.ndarray, need: int) -> list[tuple[int, int, int]]:
    """(matches, start, end) of the best stretch, and of the best ones left and right of it."""
    found, open_parts = [], [(0, len(same))]
    while open_parts:
        low, high = open_parts.pop()
        if high - low < need:
            continue
        matching, start, end = best_stretch(same[low:high])
        if matching >= need:
            found.append((matching, low + start, low + end))
            open_parts += [(low, low + start), (low + end, high)]
    return sorted(found, key=lambda s: s[1])


def needed(words: int) -> int:
    """Matching words that make an overlap with an item of so many words."""
    return words if words < SHORTEST else min(MIN_WORDS, int(np.ceil(MIN_SHARE * words)))


def masks_of(words: int) -> list[str]:
    """The masks that read an item of so many words."""
    return ["1" * words] if words < SHORTEST else [m for m in MASKS if len(m) <= words]


# --- seed tables ------------------------------------------------------------


def _word_rows(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of the texts: first row, hashes of all words in a row, ends per text."""
    from xxhash import xxh64_intdigest

    for first, words, codes, ends in coded_words(texts):
        known = np.fromiter((xxh64_intdigest(w.encode()) for w in words), np.uint64, len(words))
        yield first, known[codes] if len(words) else np.zeros(0, np.uint64), ends


def _short(codes: np.ndarray) -> bytes:
    """Words as they are compared along a diagonal."""
    return codes.astype("<u4").tobytes()


ITEMS = "item long, item_id long, n_words int, words binary, hashes array<long>, places array<int>"
HITS = "row long, doc_id long, n_words int, words binary, digest string, hashes array<long>, places array<int>"


def _batch(columns: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    kinds |= {"array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    fields = [c.split() for c in columns.split(", ")]
    held = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[kind]) for c, (_, kind) in zip(held, fields)], names=[n for n, _ in fields]
    )


def item_seeds(benchmark: DataFrame) -> DataFrame:
    """One row per item that has words: its words and seeds. Written to the shared folder."""

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, words, ends in _word_rows(batch.column(2)):
                rows = []
                for i, (low, high) in enumerate(zip([0, *ends[:-1]], ends)):
                    own = words[low:high]
                    seeds = [seed_hashes(own, m).view(np.int64) for m in masks_of(len(own))] if len(own) else []
                    if seeds:
                        places = np.concatenate([np.arange(len(h), dtype=np.int32) for h in seeds])
                        row = (items[first + i], ids[first + i], len(own), _short(own))
                        rows.append((*row, np.concatenate(seeds), places))
                yield _batch(ITEMS, rows)

    numbered = benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), F.col("text").cast("string")
    )
    return written(numbered.mapInArrow(seed, ITEMS), "benchmark-seeds")


def _filter_places(h: np.ndarray) -> list[np.ndarray]:
    return [(h >> np.uint64(64 - FILTER_BITS * k)) & np.uint64((1 << FILTER_BITS) - 1) for k in (1, 2)]


def seed_filter(items: DataFrame) -> np.ndarray:
    """The bitmap of the items' hashes, two bits each; its size does not depend on their number."""
    mask = F.lit((1 << FILTER_BITS) - 1).cast("long")
    h = items.select(F.explode("hashes").alias("h"))
    bits = h.select(
        F.explode(
            F.array(*[F.shiftrightunsigned("h", 64 - FILTER_BITS * k).bitwiseAND(mask) for k in (1, 2)])
        ).alias("bit")
    )
    # Spark's bitmaps count from 1.
    place = F.col("bit") + 1
    parts = bits.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    whole = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in parts.collect():  # at most 2**FILTER_BITS / 32,768 rows of 4 KB
        some = np.frombuffer(row["bits"], np.uint8)
        low = (row["part"] - 1) * len(some)
        whole[low : low + len(some)] = some[: len(whole) - low]
    return whole


def document_hits(docs: DataFrame, seeds: np.ndarray, lengths: list[int]) -> DataFrame:
    """Documents with windows whose hashes may be seeds: their words, the text's digest, hashes, places. Written."""
    shared = docs.sparkSession.sparkContext.broadcast(seeds)
    masks = [*MASKS, *("1" * n for n in lengths if n < SHORTEST)]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            numbers, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, words, ends in _word_rows(batch.column(2)):
                at, hashes = [], []
                for mask in masks:
                    h = seed_hashes(words, mask)
                    held = np.arange(len(h))
                    for k, place in enumerate(_filter_places(h)):
                        some = place[held]
                        held = held[(bits[some >> np.uint64(3)] >> (some & np.uint64(7)).astype(np.uint8)) & 1 > 0]
                    # No window across two texts.
                    inside = np.searchsorted(ends, held, "right") == np.searchsorted(ends, held + len(mask) - 1, "right")
                    at.append(held[inside])
                    hashes.append(h[held[inside]])
                places, found = np.concatenate(at), np.concatenate(hashes).view(np.int64)
                text = np.searchsorted(ends, places, "right")
                order = np.argsort(text, kind="stable")
                places, found, text = places[order], found[order], text[order]
                rows = []
                for i in np.unique(text).tolist():
                    low, high = np.searchsorted(text, [i, i + 1])
                    start = int(ends[i - 1]) if i else 0
                    own = words[start : ends[i]]
                    digest = hashlib.md5(batch.column(2)[first + i].as_py().encode()).hexdigest()
                    row = (numbers[first + i], ids[first + i], len(own), _short(own), digest)
                    rows.append((*row, found[low:high], (places[low:high] - start).astype(np.int32)))
                if rows:
                    yield _batch(HITS, rows)

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    return written(numbered.mapInArrow(look, HITS), "document-hits")


# --- overlaps ---------------------------------------------------------------

VERIFIED = "row long, item long, doc_id long, item_id long, item_words int, doc_words int, matching_words int, start_word long, end_word long"


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of each (document, item, diagonal), of which the words are compared."""
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            same = np.frombuffer(row["left"], "<u4") == np.frombuffer(row["right"], "<u4")
            key = (row["row"], row["item"], row["doc_id"], row["item_id"], row["item_words"], row["doc_words"])
            for matching, start, end in stretches(same, needed(row["item_words"])):
                rows.append((*key, matching, row["start"] + start, row["start"] + end))
        yield _batch(VERIFIED, rows)


def _best_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted stretches, best first, those that overlap no better one of their pair."""
    pair, starts, ends = None, [], []
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        columns = (batch.column(n).to_pylist() for n in ("row", "item", "start_word", "end_word"))
        for i, (row, item, start, end) in enumerate(zip(*columns)):
            if (row, item) != pair:
                pair, starts, ends = (row, item), [], []
            at = bisect.bisect_left(starts, end)  # those before begin before this one's end
            if not at or ends[at - 1] <= start:
                starts.insert(at, start)
                ends.insert(at, end)
                keep[i] = True
        yield batch.filter(pa.array(keep))


def verified_overlaps(docs: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every overlap with the numbers of its document's and item's rows, and the documents with hits."""
    items = item_seeds(benchmark)
    short = items.where(F.col("n_words") < SHORTEST).select("n_words").distinct()
    hits = document_hits(docs, seed_filter(items), [r["n_words"] for r in short.collect()])
    seeds = items.select("item", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select(
        "item",
        F.col("s.hashes").alias("hash"),
        F.col("s.places").alias("item_place"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"),
    )
    windows = hits.select("row", F.explode(F.arrays_zip("hashes", "places")).alias("s")).select(
        "row",
        F.col("s.hashes").alias("hash"),
        F.col("s.places").alias("place"),
        F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    # Spark sizes both sides as before the explodes, and documents by compressed files.
    diagonals = (
        windows.join(seeds.hint("merge"), ["hash", "salt"])
        .select("row", "item", (F.col("place") - F.col("item_place")).alias("diagonal"))
        .distinct()
    )
    low = F.greatest(-F.col("diagonal"), F.lit(0))
    start = low + F.col("diagonal")
    length = F.least(F.col("item_words") - low, F.col("doc_words") - start)

    def cut(words: str, first):
        return F.col(words).substr(first * WORD_BYTES + 1, length * WORD_BYTES)

    documents = hits.select("row", "doc_id", F.col("n_words").alias("doc_words"), F.col("words").alias("document"))
    passages = items.select("item", "item_id", F.col("n_words").alias("item_words"), F.col("words").alias("passage"))
    pairs = (
        diagonals.join(documents.hint("merge"), "row")
        .join(passages, "item")
        .select(
            "row", "item", "doc_id", "item_id", "item_words", "doc_words", start.alias("start"),
            cut("document", start).alias("left"), cut("passage", low).alias("right"),
        )
    )
    order = ["row", "item", F.desc("matching_words"), "start_word", "end_word"]
    verified = (
        pairs.mapInArrow(_verify, VERIFIED)
        .repartition("row", "item")
        .sortWithinPartitions(*order)
        .mapInArrow(_best_apart, VERIFIED)
    )
    return verified, hits


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, matching_words, start_word, end_word) of every overlap."""
    found, _ = verified_overlaps(docs, benchmark)
    return found.select("doc_id", "item_id", "matching_words", "start_word", "end_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any overlap, columns as they are."""
    found, hits = verified_overlaps(docs, benchmark)
    whole = (F.col("item_words") >= SHORTEST) | (F.col("matching_words") == F.col("doc_words"))
    rows = found.where(whole).select("row").distinct()
    digest = "_digest"
    while digest in {c.lower() for c in docs.columns}:
        digest = "_" + digest
    # By a digest of the text, as that is what decides, and an id may be missing or repeated.
    dirty = hits.join(rows, "row", "left_semi").select(F.col("digest").alias(digest)).distinct()
    text = F.md5(F.col("text").cast("string").cast("binary"))
    return docs.withColumn(digest, text).join(dirty, digest, "left_anti").select(*docs.columns)
