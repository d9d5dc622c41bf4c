"""Document fingerprints that add up: a homomorphic hash of the multiset of paragraphs.

A paragraph (what stands between line breaks) hashes to a wide vector, and a text's
fingerprint is the sum of its paragraphs' vectors. `EXACT` lanes modulo 2**64 come
from a 1024-bit digest of the whole paragraph: equal sums mean equal paragraphs in
any order. `LIKE` lanes modulo 2**16 hold its runs of three words, each as +1 or -1
in one lane, so that the squared difference of two sums estimates in how many runs
the texts differ. Sums are taken lane by lane, so paragraphs are inserted into a
fingerprint and deleted from it without the rest of the text, and fingerprints of
parts add up to that of the whole.

`likeness` is 1 less the squared difference over the sum of squares, not below 0:
the share of common runs, with a standard error of about 0.06 for unlike texts
(the root of 1 / `LIKE`). A run that one text repeats over 32,767 times wraps round.

The query needs each document's neighbour in order of ids. Ids (with a hash of the
text, for repeated ones) are sorted alone; the first row of each stretch of them is
a bound, and a task that meets a bound's row sends a copy to the stretch before. So
texts are shuffled once, and a repeated id with any number of texts is spread.

Defined results: a null text is empty, and an empty text has one empty paragraph;
an empty text is like another (1.0) and unlike all else (0.0); rows of one id follow
one another by a hash of the text, null ids come last; a row that is repeated very
often travels with a count and is written out by one task; the only row is its own
next; an empty table gives an empty one; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXACT = 16
LIKE = 256
RUN = 3
BUCKET_BYTES = 32 << 20
MOST_BUCKETS = 20_000
HOT_ROWS = 1_000
CHARS_AT_ONCE = 1_000_000
ROWS_AT_ONCE = 512

_MULTIPLIERS = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _runs(paragraphs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Paragraph and hash of every run of words; a shorter paragraph is one run."""
    data = np.frombuffer(("\n".join(paragraphs) + "\n").encode(), np.uint8)
    inside = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]
    ).dictionary_encode()
    known = words.dictionary.to_pylist()
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, known), np.uint64, len(known))
    word = hashes[words.indices.to_numpy(zero_copy_only=False)]
    owner = np.searchsorted(np.flatnonzero(data == 10), starts)
    n = len(word)
    padded = np.concatenate([word, np.zeros(RUN, np.uint64)])
    owners = np.concatenate([owner, np.full(RUN, -1)])
    run = np.zeros(n, np.uint64)
    for k in range(RUN):
        here = owners[k : n + k] == owner
        run = (run ^ np.where(here, padded[k : n + k], np.uint64(k))) * _MULTIPLIERS[k]
        run ^= run >> np.uint64(29)
    first = np.diff(owner, prepend=-1) != 0
    used = (owners[RUN - 1 : n + RUN - 1] == owner) | first
    return owner[used], run[used]


def summed(groups: list[list[str]]) -> np.ndarray:
    """One vector per group of paragraphs: `EXACT` lanes, then `LIKE` lanes, as unsigned integers."""
    paragraphs = [p for g in groups for p in g]
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    total = np.zeros((len(groups), EXACT + LIKE), np.uint64)
    if not paragraphs:
        return total
    digests = b"".join(hashlib.shake_128(p.encode()).digest(8 * EXACT) for p in paragraphs)
    lanes = np.frombuffer(digests, "<u8").reshape(-1, EXACT)
    heads = np.flatnonzero(np.diff(owner, prepend=-1))
    total[owner[heads], :EXACT] = np.add.reduceat(lanes, heads, axis=0)
    of, run = _runs(paragraphs)
    lane = owner[of] * LIKE + (run % np.uint64(LIKE)).astype(np.int64)
    sign = 1.0 - 2.0 * ((run >> np.uint64(32)) & np.uint64(1)).astype(np.float64)
    counts = np.bincount(lane, sign, len(groups) * LIKE).astype(np.int64).reshape(-1, LIKE)
    total[:, EXACT:] = (counts & 0xFFFF).astype(np.uint64)
    return total


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fingerprint of both texts' paragraphs."""
    total = a + b
    total[..., EXACT:] &= np.uint64(0xFFFF)
    return total


def removed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fingerprint without the paragraphs of the second one."""
    total = a - b
    total[..., EXACT:] &= np.uint64(0xFFFF)
    return total


def fingerprint(text: str | None) -> np.ndarray:
    return summed([(text or "").split("\n")])[0]


def printable(vector: np.ndarray) -> str:
    return base64.b64encode(
        vector[:EXACT].astype("<u8").tobytes() + vector[EXACT:].astype("<u2").tobytes()
    ).decode()


def _signed(vector: np.ndarray) -> np.ndarray:
    return vector[..., EXACT:].astype(np.uint16).view(np.int16).astype(np.float64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """From 0 to 1, for fingerprints row by row."""
    apart = (_signed(removed(a, b)) ** 2).sum(-1)
    whole = (_signed(a) ** 2).sum(-1) + (_signed(b) ** 2).sum(-1)
    same = (a == b).all(-1)
    near = 1 - apart / np.where(whole > 0, whole, 1)
    return np.where(same, 1.0, np.where(whole > 0, np.clip(near, 0, 1), 0.0))


# --- the query --------------------------------------------------------------

DIGEST = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)
_PLACED = (
    "bucket int, guest boolean, missing boolean, descending long, hash long, times long, doc_id long, text string"
)
_PLACED_NAMES = [x.split()[0] for x in _PLACED.split(", ")]
_PLACED_KINDS = [pa.int32(), pa.bool_(), pa.bool_(), *[pa.int64()] * 4, pa.string()]


def _codes(missing: np.ndarray, descending: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Keys as byte strings that sort as the rows do."""
    out = np.empty((len(missing), 17), np.uint8)
    out[:, 0] = missing
    for low, numbers in ((1, descending), (9, hashes)):
        unsigned = numbers.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        out[:, low : low + 8] = unsigned.astype(">u8").view(np.uint8).reshape(-1, 8)
    # A last byte other than zero, as numpy drops zeros from the end of strings.
    return np.concatenate([out, np.ones((len(out), 1), np.uint8)], 1).reshape(-1).view("S18")


def _keyed(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        doc_id.isNull().alias("missing"),
        F.bitwise_not(F.coalesce(doc_id, F.lit(0))).alias("descending"),
        F.xxhash64(text).alias("hash"),
        doc_id.alias("doc_id"),
        text.alias("text"),
    )


def _placer(bounds: np.ndarray, hot: np.ndarray):
    """Rows with their bucket, and copies of the bounds' rows for the buckets before."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        often: dict[bytes, list] = {}

        def rows(bucket, guest, batch: pa.RecordBatch, times) -> pa.RecordBatch:
            n = len(batch)
            columns = [bucket, [guest] * n, *(batch.column(k) for k in range(3)), times, *batch.columns[3:]]
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, _PLACED_KINDS)],
                names=_PLACED_NAMES,
            )

        for batch in batches:
            keys = _codes(*(batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)))
            bucket = np.searchsorted(bounds, keys, side="right") - 1
            is_hot = np.isin(keys, hot)
            for i in np.flatnonzero(is_hot).tolist():
                held = often.setdefault(keys[i], [int(bucket[i]), batch.slice(i, 1), 0])
                held[2] += 1
            plain = pa.array(np.flatnonzero(~is_hot))
            if len(plain):
                yield rows(bucket[~is_hot].astype(np.int32), False, batch.take(plain), np.ones(len(plain), np.int64))
            for i in np.flatnonzero(bounds[bucket] == keys).tolist():
                if int(bucket[i]) not in sent:
                    sent.add(int(bucket[i]))
                    before = (int(bucket[i]) - 1) % len(bounds)
                    yield rows([before], True, batch.slice(i, 1), [1])
        for place_of, row, times in often.values():
            yield rows([place_of], False, row, [times])

    return place


def _described(pairs: list[tuple], texts: list[str]) -> Iterator[pa.RecordBatch]:
    """Result rows of (doc_id, place of the text, place of the next, times)."""
    kept, gone = [], []
    cuts = []
    for text in texts:
        cut = len(text) - len(text) // 2
        first = text.count("\n", 0, cut)
        paragraphs = text.split("\n")
        kept.append(paragraphs[:first])
        gone.append(paragraphs[first:])
        cuts.append((text.rfind("\n", 0, cut) + 1, cut))
    heads, rests = summed(kept), summed(gone)
    whole = added(heads, rests)
    edited, hashes = [], []
    for _, i, j, _ in pairs:
        low, cut = cuts[i]
        more = texts[j][: len(texts[i]) - cut]
        edited.append((texts[i][low:cut] + more).split("\n"))
        hashes.append(hashlib.sha256((texts[i][:cut] + more).encode()).hexdigest())
    at, then = (np.array([p[k] for p in pairs], np.int64) for k in (1, 2))
    # The edited text's fingerprint: the replaced paragraphs out, the new ones in.
    changed = added(removed(whole[at], rests[at]), summed(edited))
    near_edited, near_next = likeness(whole[at], changed), likeness(whole[at], whole[then])
    printed = [printable(v) for v in whole]
    columns = [
        [p[0] for p in pairs],
        [len(texts[i]) for i in at],
        hashes,
        [printed[i] for i in at],
        [printable(v) for v in changed],
        near_edited,
        near_next,
    ]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [x.split()[0] for x in DIGEST.split(", ")]
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
    repeats = np.repeat(np.arange(len(pairs)), np.minimum([p[3] for p in pairs], ROWS_AT_ONCE))
    yield batch.take(pa.array(repeats)) if len(repeats) > len(pairs) else batch
    for k, (*_, times) in enumerate(pairs):
        for low in range(ROWS_AT_ONCE, times, ROWS_AT_ONCE):
            yield batch.take(pa.array([k] * min(ROWS_AT_ONCE, times - low)))


def _described_in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of some buckets, each with the text of the row after it."""
    pairs: list[tuple] = []
    texts: list[str] = []
    size, bucket, held = 0, None, None  # held: the row whose next is not yet known
    for batch in batches:
        columns = (batch.column(n).to_pylist() for n in ("bucket", "guest", "times", "doc_id"))
        for row, (here, guest, times, doc_id) in enumerate(zip(*columns)):
            if held is None and guest and here == bucket:
                continue  # the same bound's row from another task
            text = batch.column("text")[row].as_py()
            texts.append(text)
            size += len(text)
            last = len(texts) - 1
            if held is not None:
                pairs.append((*held, last, 1))
            held, bucket = (None if guest else (doc_id, last)), here
            if times > 1:
                pairs.append((doc_id, last, last, times - 1))
            if pairs and (size >= CHARS_AT_ONCE or len(pairs) >= ROWS_AT_ONCE):
                yield from _described(pairs, texts)
                pairs, texts, size = [], [text], len(text)
                held = None if held is None else (held[0], 0)
    if pairs:
        yield from _described(pairs, texts)


def document_fingerprints(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and how like they are.

    The edited text has its second half replaced by the start of the next document's
    text, in descending order of ids; the first follows the last.
    """
    keyed = _keyed(docs)
    order = ["missing", "descending", "hash"]
    rows, size = keyed.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    buckets = max(1, min(MOST_BUCKETS, (size or 0) // bucket_bytes, rows))
    sorted_keys = keyed.select(*order).repartitionByRange(buckets, *order)
    firsts = sorted_keys.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*order)).alias("k"))
    # At most `MOST_BUCKETS` bounds, and as many as `rows / least` keys that repeat so often.
    least = max(hot_rows, rows // MOST_BUCKETS)
    often = keyed.groupBy(*order).count().where(F.col("count") >= least).select(*order)
    bounds = np.sort(_collected([r["k"] for r in firsts.collect()]))
    hot = _collected(often.collect())
    placed = keyed.mapInArrow(_placer(bounds, hot), _PLACED)
    return (
        placed.repartitionById(buckets, "bucket")  # not by a hash, which puts some buckets together
        .sortWithinPartitions("bucket", "guest", *order)
        .select("bucket", "guest", "times", "doc_id", "text")
        .mapInArrow(_described_in_order, DIGEST)
    )


def _collected(keys: list) -> np.ndarray:
    columns = list(zip(*keys)) or [(), (), ()]
    kinds = (bool, np.int64, np.int64)
    return np.unique(_codes(*(np.array(c, k) for c, k in zip(columns, kinds))))
