"""The prefix trie of conversations, from sorted neighbours and union-find.

A turn becomes a symbol of 20 bytes (a 128-bit digest of role and text, and the
text's length), a conversation the string of its symbols. Sorted strings that share
a prefix are neighbours, so the trie is given by the common prefixes (LCP) of
neighbours: joining them by union-find, longest common prefix first, every merge of
two components makes or widens the branching node at that depth, and the stretch
between two merges of a component is a chain of nodes with one child.

Strings are sorted by ranges over all tasks, and each task grows the forest of its
own stretches of at most `FOREST_ROWS` rows. Nodes that are no prefix of a stretch's
first or last string are complete there. The others, one line down each edge, are
the contracted forest: what hangs off each of their nodes is summed up, and the
lines of neighbouring forests are merged by the same union-find, `GROUP` forests at
a time, until one is left. So no task holds more than a stretch or the edge lines
of a group, however many conversations share a node. Long lists of conversations
that end at one node are hashed as a stream.

Defined results: a null turn comes first, turns of equal number follow one another
by their symbols; null role or text is empty; rows without a conv_id belong to no
conversation and are left out; repeated rows are repeated turns; remainders have
the sign of the id, as in SQL; an empty table gives no node; other columns of the
input are not read. All symbols of one conversation must fit in one row (2 GB: 50
million turns). The hash of the ids that end at a node is sequential by nature, so
one task streams them where a node's list is longer than a stretch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtrail.llm.store import written

SYMBOL = 20
CHUNK_TURNS = 256
FOREST_ROWS = 100_000
FOREST_BYTES = 32_000_000
GROUP = 256
ENDS_AT_ONCE = 65_536
NOBODY = 2**63 - 1
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long,"
    " saved_tokens long, ends_sha256 string"
)
# What a forest gives: complete nodes (0), nodes of its edge lines (1), ids that end at one of them (2).
GROWN = (
    f"kind int, part int, forest int, {NODE}, node binary, parent_node binary,"
    " side int, key binary, ends binary, piece int"
)
_NAMES = [x.split()[0] for x in GROWN.split(", ")]
_LONGS = _NAMES[3:10]
_KINDS = {"string": pa.string(), "binary": pa.binary(), "int": pa.int32(), "long": pa.int64()}
_ARROW = pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in GROWN.split(", "))])


# --- strings of symbols -----------------------------------------------------


def conversation_keys(turns: DataFrame) -> DataFrame:
    """(conv_id, key): the symbols of a conversation's turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    size = F.lpad(F.hex(F.length(text)), 8, "0")
    light = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long").alias("turn"),
        F.concat(digest, size).alias("symbol"),
    )

    def joined(of: str, order: str):
        ordered = F.sort_array(F.collect_list(F.struct(order, of)))
        return F.array_join(F.transform(ordered, lambda x: x[of]), "").alias(of)

    # In two steps, so that a conversation of very many turns is gathered as few rows.
    chunk = F.expr(f"turn DIV {CHUNK_TURNS} - IF(turn % {CHUNK_TURNS} < 0, 1, 0)").alias("chunk")
    chunks = light.groupBy("conv_id", chunk).agg(joined("symbol", "turn"))
    return chunks.groupBy("conv_id").agg(joined("symbol", "chunk")).select(
        "conv_id", F.unhex("symbol").alias("key")
    )


def with_shared_heads(keys: DataFrame, every: int = 100, most: int = 5) -> DataFrame:
    """Each conversation with its first turns taken from the first one of its hundred.

    The number of turns taken, up to `most`, is a checksum of the id.
    """
    taken = F.expr(f"crc32(CAST(CAST(conv_id AS STRING) AS BINARY)) % {most + 1} * {SYMBOL}").cast("int")
    heads = keys.where(f"conv_id % {every} = 0").select(
        F.col("conv_id").alias("first"), F.col("key").substr(1, most * SYMBOL).alias("head")
    )
    head = F.coalesce(F.col("head").substr(F.lit(1), taken), F.lit(b""))
    own = F.col("key").substr(taken + 1, F.greatest(F.octet_length("key") - taken, F.lit(0)))
    return (
        keys.withColumn("first", F.expr(f"conv_id - conv_id % {every}"))
        .join(heads, "first", "left")
        .select("conv_id", F.concat(head, own).alias("key"))
    )


# --- growing a forest -------------------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """How many symbols two strings share at their beginning."""
    n = min(len(a), len(b)) // SYMBOL
    if a[: n * SYMBOL] == b[: n * SYMBOL]:
        return n
    low, high = 0, n  # the first `low` agree, the first `high` do not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low * SYMBOL : mid * SYMBOL] == b[low * SYMBOL : mid * SYMBOL]:
            low = mid
        else:
            high = mid
    return low


def prefix_ids(key: bytes) -> list[bytes]:
    """Digests of a string's prefixes, by depth from 0."""
    h = hashlib.md5()
    found = [h.digest()]
    for low in range(0, len(key), SYMBOL):
        h.update(key[low : low + SYMBOL])
        found.append(h.digest())
    return found


@dataclass
class Grown:
    """Rows of a forest: complete nodes, edge lines, and for each of those its ender rows."""

    nodes: list[list] = field(default_factory=list)
    unresolved: dict[int, bytes] = field(default_factory=dict)
    ids: list[bytes | None] = field(default_factory=list)
    lines: list[tuple] = field(default_factory=list)
    ends: list[tuple[bytes, int, int]] = field(default_factory=list)


class Forest:
    """Union-find over rows in sorted order, each the end of a string or a node of an edge line.

    Row r stands at `depth[r]` on `keys[r]`, and `lcp[r]` is its common prefix with row
    r - 1. What is summed at the top node of a component is kept at its root.
    """

    def __init__(self, keys, depth, lcp, n, least, kids, leaves, saved, ends, left, right, last: bool, named: bool):
        self.keys, self.lcp, self.top = keys, lcp, list(depth)
        self.n, self.least, self.kids, self.leaves, self.saved = n, least, kids, leaves, saved
        self.low, self.high = ends
        self.left, self.right, self.last, self.named = left, right, last, named
        self.waiting: list[list[int]] = [[] for _ in depth]
        self.up = list(range(len(depth)))
        self.grown = Grown()
        self.lined: dict[bytes, list[bytes]] = {}

    def _id(self, key: bytes, depth: int) -> bytes:
        if key not in self.lined:
            self.lined[key] = prefix_ids(key)
        return self.lined[key][depth]

    def _root(self, row: int) -> int:
        up = self.up
        while up[row] != row:
            up[row] = up[up[row]]
            row = up[row]
        return row

    def _close(self, c: int, is_left: bool, is_right: bool) -> int | None:
        """Settle the top node of component c; its number if it is complete."""
        t, grown = self.top[c], self.grown
        if (is_left or is_right) and not self.last:
            side = 0 if is_left else 1
            key = self.keys[self.left if is_left else self.right]
            node = self._id(key, t)
            for child in self.waiting[c]:
                grown.unresolved[child] = node
            grown.lines.append(
                (side, t, node, self.n[c], self.least[c], self.kids[c], self.leaves[c], self.saved[c])
            )
            if self.low[c] < self.high[c]:
                grown.ends.append((node, self.low[c], self.high[c]))
            self.n[c], self.least[c], self.kids[c], self.leaves[c], self.saved[c] = 0, NOBODY, 0, 0, 0
            return None
        kids, least = self.kids[c], self.least[c]
        self.leaves[c] += kids == 0
        if t:
            key = self.keys[c]
            size = int.from_bytes(key[t * SYMBOL - 4 : t * SYMBOL], "big")
            self.saved[c] += (self.n[c] - 1) * size
        number = len(grown.nodes)
        grown.nodes.append(
            [least, t, None, self.n[c], kids, self.leaves[c], self.saved[c], self.low[c], self.high[c]]
        )
        grown.ids.append(self._id(self.keys[c], t) if self.named else None)
        for child in self.waiting[c]:
            grown.nodes[child][2] = least
        return number

    def _lift(self, c: int, depth: int, is_left: bool, is_right: bool) -> None:
        """Take component c up a chain until its top node is at that depth."""
        while self.top[c] > depth:
            number = self._close(c, is_left, is_right)
            self.top[c] -= 1
            self.low[c] = self.high[c] = 0
            if number is None:
                self.kids[c], self.waiting[c] = 0, []
            else:
                self.kids[c], self.waiting[c] = 1, [number]

    def grow(self) -> Grown:
        left, right = self.left, self.right
        edges = np.argsort(-np.asarray(self.lcp[1:], np.int64), kind="stable") + 1
        for r in edges.tolist():
            a, b, depth = self._root(r - 1), self._root(r), self.lcp[r]
            if self.top[a] > depth or self.top[b] > depth:
                at_left, at_right = self._root(left), self._root(right)
                self._lift(a, depth, a == at_left, a == at_right)
                self._lift(b, depth, b == at_left, b == at_right)
            # One component: the top nodes of both are the same node.
            self.up[b] = a
            self.n[a] += self.n[b]
            self.least[a] = min(self.least[a], self.least[b])
            self.kids[a] += self.kids[b]
            self.leaves[a] += self.leaves[b]
            self.saved[a] += self.saved[b]
            self.waiting[a] += self.waiting[b]
            self.waiting[b] = []
            if self.low[a] == self.high[a]:
                self.low[a], self.high[a] = self.low[b], self.high[b]
            elif self.low[b] < self.high[b]:
                self.high[a] = self.high[b]
        root = self._root(0)
        self._lift(root, 0, True, True)
        self._close(root, True, True)
        return self.grown


def grow_rows(keys: list[bytes], convs: list[int], last: bool = False) -> Grown:
    """The forest of a stretch of sorted (key, conv_id) rows."""
    m = len(keys)
    lcp = [0, *(common(a, b) for a, b in zip(keys, keys[1:]))]
    depth = [len(k) // SYMBOL for k in keys]
    zeros = [[0] * m for _ in range(3)]
    ends = (list(range(m)), list(range(1, m + 1)))
    return Forest(keys, depth, lcp, [1] * m, list(convs), *zeros, ends, 0, m - 1, last, False).grow()


def merge_lines(lines: list[tuple[bytes, list[tuple]]], last: bool) -> tuple[Grown, list[bytes]]:
    """One forest of the edge lines of neighbouring ones, and the strings of its rows.

    A line is a string and the nodes on it, (depth, n, least, kids, leaves, saved) from
    the top; lines are in sorted order, and the nodes of one above its common prefix
    with the line before are the same as there.
    """
    keys: list[bytes] = []
    depth: list[int] = []
    sums: list[list[int]] = []
    path: list[int] = []
    before, first_end, last_end = None, 0, 0
    for key, nodes in lines:
        shared = common(before, key) if before is not None else -1
        path = path[: shared + 1]
        for d, *found in nodes:
            if d <= shared:
                row = sums[path[d]]
                for k in (0, 2, 3, 4):
                    row[k] += found[k]
                row[1] = min(row[1], found[1])
            else:
                assert d == len(path)
                path.append(len(keys))
                keys.append(key)
                depth.append(d)
                sums.append(list(found))
        last_end = path[len(key) // SYMBOL]
        if before is None:
            first_end = last_end
        before = key
    lcp = [0, *(d - 1 for d in depth[1:])]
    columns = [[row[k] for row in sums] for k in range(5)]
    none = ([0] * len(keys), [0] * len(keys))
    forest = Forest(keys, depth, lcp, *columns, none, first_end, last_end, last, True)
    return forest.grow(), keys


# --- as Spark jobs ----------------------------------------------------------


def _node_rows(grown: Grown, part: int, forest: int, convs: list[int] | None) -> dict[str, list]:
    """Columns of the complete nodes of a forest."""
    nodes = list(zip(*grown.nodes)) or [()] * 9
    count = len(grown.nodes)
    columns: dict[str, list] = dict(zip(_LONGS, nodes))
    if convs is not None:
        text = [NO_ENDS] * count
        for i, (low, high) in enumerate(zip(nodes[7], nodes[8])):
            if low < high:
                text[i] = hashlib.sha256(",".join(map(str, convs[low:high])).encode()).hexdigest()
        columns["ends_sha256"] = text
    columns |= {"kind": [0] * count, "part": [part] * count, "forest": [forest] * count}
    columns["node"] = grown.ids
    columns["parent_node"] = [grown.unresolved.get(i) for i in range(count)]
    return columns


def _line_rows(grown: Grown, part: int, forest: int, ends: tuple[bytes, bytes]) -> dict[str, list]:
    """Columns of the edge lines; the deepest node of each carries the string."""
    lines = sorted(grown.lines)
    deepest = {side: i for i, (side, *_) in enumerate(lines)}
    side, depth, node, n, least, kids, leaves, saved = zip(*lines)
    return {
        "kind": [1] * len(lines), "part": [part] * len(lines), "forest": [forest] * len(lines),
        "side": side, "depth": depth, "node": node, "n_convs": n, "conv_id": least,
        "n_children": kids, "n_leaves": leaves, "saved_tokens": saved,
        "key": [ends[s] if deepest[s] == i else None for i, s in enumerate(side)],
    }


def _batch(columns: dict[str, list]) -> pa.RecordBatch:
    count = len(columns["kind"])
    none = [None] * count
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(f.name, none), f.type) for f in _ARROW], schema=_ARROW
    )


def _planter(rows: int, size: int):
    """Forests of a task's sorted rows, a stretch of at most so many rows or bytes at a time."""

    def plant(keys: list[bytes], convs: list[int], forest: int) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        grown = grow_rows(keys, convs)
        yield _batch(_node_rows(grown, part, forest, convs))
        yield _batch(_line_rows(grown, part, forest, (keys[0], keys[-1])))
        for node, low, high in grown.ends:
            for piece, at in enumerate(range(low, high, ENDS_AT_ONCE)):
                ids = np.array(convs[at : min(high, at + ENDS_AT_ONCE)], "<i8").tobytes()
                yield _batch(
                    {"kind": [2], "part": [part], "forest": [forest], "node": [node], "ends": [ids], "piece": [piece]}
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[bytes] = []
        convs: list[int] = []
        held, forest = 0, 0
        for batch in batches:
            for key, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(key)
                convs.append(conv)
                held += len(key)
                if len(keys) >= rows or held >= size:
                    yield from plant(keys, convs, forest)
                    keys, convs, held, forest = [], [], 0, forest + 1
        if keys:
            yield from plant(keys, convs, forest)

    return run


def _merger(last: bool):
    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "forest", "side", "depth"])
        lines: list[tuple[bytes, list[tuple]]] = []
        held: list[tuple] = []
        fields = ["depth", "n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens"]
        for key, *found in zip(rows["key"], *(rows[c].astype("int64").tolist() for c in fields)):
            held.append(tuple(found))
            if key is not None:
                lines.append((bytes(key), held))
                held = []
        grown, _ = merge_lines(lines, last)
        part, forest = int(rows["part"].iloc[0]), int(rows["forest"].iloc[0])
        batches = [_batch(_node_rows(grown, part, forest, None))]
        if not last:
            batches.append(_batch(_line_rows(grown, part, forest, (lines[0][0], lines[-1][0]))))
        return pa.Table.from_batches(batches).to_pandas(types_mapper=_nullable)

    return merge


def _nullable(kind: pa.DataType):
    return {pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}.get(kind)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per node from its sorted pieces, hashed as they come."""
    node, state = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([node], pa.binary()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"]
        )

    for batch in batches:
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
            if key != node:
                if state is not None:
                    yield row()
                node, state = key, hashlib.sha256()
                comma = b""
            state.update(comma + ",".join(map(str, np.frombuffer(ids, "<i8").tolist())).encode())
            comma = b","
    if state is not None:
        yield row()


def _merged(lines: DataFrame, group: int) -> DataFrame:
    """Complete nodes from the edge lines of all forests, by rounds over neighbouring ones."""
    done: list[DataFrame] = []
    while True:
        forests = lines.select("part", "forest").distinct()
        count, most = forests.agg(F.count(F.lit(1)), F.max("part")).first()
        last = count <= group
        # First the forests of each task, then of neighbouring tasks.
        many = forests.groupBy("part").count().where("count > 1").limit(1).count() if not last else 0
        width = (most or 0) + 1 if last else 1 if many else group
        grown = lines.groupBy(F.expr(f"part DIV {width}")).applyInPandas(_merger(last), GROWN)
        step = written(grown, "trie-merge")
        done.append(step.where("kind = 0"))
        if last:
            break
        lines = step.where("kind = 1")
        if not many:
            lines = lines.withColumns({"part": F.expr(f"part DIV {width}"), "forest": F.lit(0)})
    nodes = done[0]
    for more in done[1:]:
        nodes = nodes.unionByName(more)
    return nodes


def prefix_trie(
    keys: DataFrame, forest_rows: int = FOREST_ROWS, forest_bytes: int = FOREST_BYTES, group: int = GROUP
) -> DataFrame:
    """One row per node of the trie of (conv_id, key)."""
    names = [x.split()[0] for x in NODE.split(", ")]
    planted = written(
        keys.select("key", "conv_id")
        .repartitionByRange("key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_planter(forest_rows, forest_bytes), GROWN),
        "trie",
    )
    lines = planted.where("kind = 1")
    edge = _merged(lines, group)
    hashed = (
        planted.where("kind = 2")
        .select("node", "part", "forest", "piece", "ends")
        .repartition("node")
        .sortWithinPartitions("node", "part", "forest", "piece")
        .mapInArrow(_hash_ends, "node binary, ends_sha256 string")
    )
    of_parent = edge.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("_parent"))
    found = (
        edge.drop("ends_sha256")
        .join(hashed, "node", "left")
        .join(of_parent, "parent_node", "left")
        .withColumns(
            {
                "parent_conv_id": F.coalesce("parent_conv_id", "_parent"),
                "ends_sha256": F.coalesce("ends_sha256", F.lit(NO_ENDS)),
            }
        )
    )
    # Parents on an edge line, by forest, so that the children of one node are not one key.
    parents = lines.join(edge.select("node", F.col("conv_id").alias("_parent")), "node").select(
        "part", "forest", F.col("node").alias("parent_node"), "_parent"
    )
    inner = planted.where("kind = 0")
    beside = (
        inner.where("parent_node IS NOT NULL")
        .drop("parent_conv_id")
        .join(parents, ["part", "forest", "parent_node"])
        .withColumnRenamed("_parent", "parent_conv_id")
    )
    return (
        inner.where("parent_node IS NULL")
        .select(*names)
        .unionByName(beside.select(*names))
        .unionByName(found.select(*names))
    )


def conversation_trie(turns: DataFrame, **limits: int) -> DataFrame:
    """The trie of the conversations with shared heads."""
    keys = written(conversation_keys(turns), "conversation-keys")
    rebuilt = written(with_shared_heads(keys), "rebuilt-keys")
    return prefix_trie(rebuilt, **limits).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
