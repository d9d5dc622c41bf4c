"""Token ids in Huffman-coded blocks.

The format is a header (one row per id: its code length) and blocks (one row
each: whole documents, their token counts, the coded bits, and the bit offset of
every `STEP`-th token). Codes are canonical, so the lengths say everything, and
at most `limit` bits long, so one table lookup decodes a token. Blocks decode on
their own, and within a block every checkpoint is an entry: the reader decodes
all stretches of a batch in step, one token of each at a time.

Defined results: a null text is an empty one, stored as its end id alone; null
ids of documents come first; rows with equal ids follow one another in any order;
an empty table gives an empty header, no blocks and no rows; columns other than
`doc_id` and `text` are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from playtrail.llm.store import scratch_path, written
from playtrail.llm.tokens import encoder

STEP = 256
BLOCK_TOKENS = 4096
LIMIT = 16
TOKENS_AT_ONCE = 2_000_000
BLOCKS = (
    "part int, block int, start_in_part long, doc_ids array<long>, doc_tokens array<long>,"
    " n_tokens long, checkpoints binary, payload binary"
)


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Best code lengths of at most `limit` bits (package-merge); 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.int64)
    symbols = np.flatnonzero(counts)
    n = len(symbols)
    if n == 0:
        return lengths
    if n == 1:
        lengths[symbols] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(n))))
    symbols = symbols[np.argsort(counts[symbols], kind="stable")]
    weights = counts[symbols].astype(np.int64)
    level, leaves = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = level[: len(level) // 2 * 2].reshape(-1, 2).sum(1)
        both = np.concatenate([weights, pairs])
        order = np.argsort(both, kind="stable")
        level = both[order]
        leaves.append(order < n)
    need, times = 2 * n - 2, np.zeros(n, np.int64)
    for is_leaf in reversed(leaves):
        own = int(is_leaf[:need].sum())
        times[:own] += 1
        need = 2 * (need - own)
    lengths[symbols] = times
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    top = int(lengths.max(initial=0))
    steps = np.left_shift(1, top - lengths[order])
    codes = np.zeros(len(lengths), np.int64)
    codes[order] = (np.cumsum(steps) - steps) >> (top - lengths[order])
    return codes


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """The bit offset of every `STEP`-th token, and the bits, most significant first."""
    size = lengths[ids]
    ends = np.cumsum(size)
    starts = ends - size
    shifted = codes[ids].astype(np.uint64) << (64 - (starts & 31) - size).astype(np.uint64)
    word = starts >> 5
    n = int(ends[-1] >> 5) + 2
    # Codes share no bit, so sums of them are exact in a double.
    high = np.bincount(word, (shifted >> np.uint64(32)).astype(np.float64), n)
    low = np.bincount(word + 1, (shifted & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    payload = (high + low).astype(">u4").tobytes()[: int(ends[-1] + 7) >> 3]
    return starts[::STEP].astype("<u4").tobytes(), payload


class Decoder:
    def __init__(self, lengths: np.ndarray):
        self.bits = int(lengths.max(initial=1))
        order = np.lexsort((np.arange(len(lengths)), lengths))
        order = order[lengths[order] > 0]
        slots = np.left_shift(1, self.bits - lengths[order])
        self.symbols = np.zeros(1 << self.bits, np.uint32)
        self.sizes = np.zeros(1 << self.bits, np.int64)
        self.symbols[: slots.sum()] = np.repeat(order, slots)
        self.sizes[: slots.sum()] = np.repeat(lengths[order], slots)

    def decode(self, blocks: list[tuple[bytes, bytes, int]]) -> list[np.ndarray]:
        """Ids of each (checkpoints, payload, number of tokens)."""
        base = np.cumsum([0, *(len(p) for _, p, _ in blocks)])
        data = np.frombuffer(b"".join(p for _, p, _ in blocks) + bytes(8), np.uint8).astype(np.uint64)
        # The five bytes from each position on hold any code with its bit offset.
        view = data[: base[-1] + 1] << np.uint64(32)
        for k, shift in enumerate((24, 16, 8, 0), 1):
            view |= data[k : base[-1] + 1 + k] << np.uint64(shift)
        at = np.concatenate(
            [np.frombuffer(c, "<u4").astype(np.int64) + 8 * b for (c, _, _), b in zip(blocks, base)]
        )
        tokens = np.array([n for _, _, n in blocks], np.int64)
        lanes = -(-tokens // STEP)
        held = np.full(len(at), STEP, np.int64)
        held[np.cumsum(lanes) - 1] = tokens - (lanes - 1) * STEP
        out = np.empty((len(at), STEP), np.uint32)
        mask, last = (1 << self.bits) - 1, 8 * int(base[-1])
        for step in range(int(held.max(initial=0))):
            peek = (view[at >> 3] >> (40 - self.bits - (at & 7)).astype(np.uint64)).astype(np.int64) & mask
            out[:, step] = self.symbols[peek]
            at = np.minimum(at + self.sizes[peek], last)
        flat = out[np.arange(STEP) < held[:, None]]
        return np.split(flat, np.cumsum(tokens)[:-1])


def id_type(tokenizer: str, end_id: int) -> str:
    """Little-endian unsigned integers that hold every id: 16 bits if they suffice, else 32."""
    return "<u2" if max(encoder(tokenizer).vocabulary_size - 1, end_id) < 1 << 16 else "<u4"


def token_ids(docs: DataFrame, tokenizer: str, end_id: int, dtype: str = "<u4") -> DataFrame:
    """`doc_id` and its ids with the end id, as integers of that type."""

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], dtype).tobytes()
        encode = encoder(tokenizer).encode
        for batch in batches:
            data = [ids.astype(dtype).tobytes() + end for ids in encode(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(data, pa.binary())], names=["doc_id", "ids"]
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        tokenize, "doc_id long, ids binary"
    )


def id_counts(ids: DataFrame, dtype: str = "<u4") -> DataFrame:
    """How often each id occurs in the whole table: (id, n)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            data = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype)
            some = np.bincount(data, minlength=len(total))
            some[: len(total)] += total
            total = some
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])

    return ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_file(ids: DataFrame, path: str, limit: int = LIMIT, dtype: str = "<u4") -> None:
    """Write the header and the blocks of (doc_id, ids), documents in ascending order."""
    spark = ids.sparkSession
    # One row per id of the vocabulary, so its size is the tokenizer's, not the corpus's.
    counted = id_counts(ids, dtype).collect()
    counts = np.zeros(max((r["id"] for r in counted), default=-1) + 1, np.int64)
    for row in counted:
        counts[row["id"]] = row["n"]
    lengths = code_lengths(counts, limit)
    codes = canonical_codes(lengths)
    header = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(header, "id long, bits int").coalesce(1).write.parquet(f"{path}/header")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start = TaskContext.get().partitionId(), 0, 0
        width = np.dtype(dtype).itemsize
        names = [x.split()[0] for x in BLOCKS.split(", ")]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        kinds += [pa.int64(), pa.binary(), pa.binary()]
        for batch in batches:
            rows, held, size = [], [], 0
            docs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for i, (doc_id, data) in enumerate(docs):
                held.append((doc_id, data))
                size += len(data) // width
                if size >= BLOCK_TOKENS or i + 1 == len(docs):
                    tokens = np.frombuffer(b"".join(d for _, d in held), dtype)
                    marks, payload = encode_block(tokens, lengths, codes)
                    sizes = [len(d) // width for _, d in held]
                    rows.append((part, block, start, [d for d, _ in held], sizes, size, marks, payload))
                    block, start, held, size = block + 1, start + size, [], 0
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                )

    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(encode, BLOCKS).write.parquet(f"{path}/blocks")


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): documents in order of their first token's place."""
    header = spark.read.schema("id long, bits int").parquet(f"{path}/header").collect()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return _documents(header, blocks, lambda ids: ids.tobytes(), pa.binary(), "ids binary")


def _documents(header: list, blocks: DataFrame, of_ids, kind: pa.DataType, column: str) -> DataFrame:
    lengths = np.zeros(max((r["id"] for r in header), default=-1) + 1, np.int64)
    for row in header:
        lengths[row["id"]] = row["bits"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(lengths)
        names = ["part", "doc_id", "start_in_part", "n_tokens", column.split()[0]]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), kind]
        for batch in batches:
            turn = np.cumsum(batch.column("n_tokens").to_numpy(zero_copy_only=False)) // TOKENS_AT_ONCE
            for low in np.flatnonzero(np.diff(turn, prepend=-1)):
                some = batch.slice(low, int((turn == turn[low]).sum())).to_pylist()
                coded = [(b["checkpoints"], b["payload"], b["n_tokens"]) for b in some]
                rows = []
                for b, ids in zip(some, decoder.decode(coded)):
                    at = 0
                    for doc_id, n in zip(b["doc_ids"], b["doc_tokens"]):
                        rows.append((b["part"], doc_id, b["start_in_part"] + at, n, of_ids(ids[at : at + n])))
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names
                )

    decoded = blocks.mapInArrow(
        decode, f"part int, doc_id long, start_in_part long, n_tokens long, {column}"
    )
    # One row per file of blocks.
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return decoded.join(before, "part").select(
        "doc_id", (F.col("start_in_part") + F.col("before")).alias("start"), "n_tokens", column.split()[0]
    )


def token_file_digest(spark: SparkSession, path: str) -> DataFrame:
    """As `read_token_file`, with the checksum of a document's ids in their place."""
    header = spark.read.schema("id long, bits int").parquet(f"{path}/header").collect()
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    return _documents(
        header, blocks, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "ids_crc32 long"
    )


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 2) -> str:
    """Tokenize, write the file, and return its path."""
    dtype = id_type(tokenizer, end_id)
    ids = written(token_ids(docs, tokenizer, end_id, dtype), "token-ids", compression="zstd")
    path = scratch_path(docs.sparkSession, "token-file")
    write_token_file(ids, path, dtype=dtype)
    return path
