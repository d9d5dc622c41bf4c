"""The conversation trie against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from playtrail.llm import queries
from playtrail.llm.prefix_trie import SYMBOL, common, conversation_trie

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, conv string, depth int"


def symbol(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, symbol(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        taken = zlib.crc32(str(c).encode()) % 6
        first = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        rebuilt[c] = tuple(own.get(first, [])[:taken] + turns[taken:])
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d:
                children[turns[: d - 1]].add(turns[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, held in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(held) - 1) * len(node[-1][1]) if node else 0
    found = []
    for node, held in members.items():
        ends = ",".join(map(str, sorted(c for c in held if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        found.append(
            (min(held), len(node), parent, len(held), len(children[node]), leaves[node], saved[node],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(found, key=str)


def rows_of(df):
    return [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]


def trie(df, **limits):
    return sorted((tuple(r) for r in conversation_trie(df, **limits).collect()), key=str)


@pytest.fixture(scope="module")
def talks(llm):
    """Nulls, repeated turns, negative ids, a long conversation and a third with one text."""
    rng = random.Random(5)
    rows = []
    for c in range(-120, 330):
        if rng.random() < 0.2:
            continue
        for t in range(rng.choice([1, 1, 2, 4, 7, 9])):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["u", "a", None]), rng.choice(["x", "yy", "", None])))
    rows += [(777, i, "u", "x") for i in range(600)] + [(777, 3, "u", "x")] * 2
    rows += [(900 + i, t, "u", "x") for i in range(90) for t in range(8)] + [(None, 1, "a", "b")] * 5
    rows.append((1000, 0, "a", "long " * 100_000))
    return llm.createDataFrame([(*r, "c", 1) for r in rows], SCHEMA)


@pytest.mark.parametrize("rows, group", [(100_000, 256), (7, 3), (1, 2)])
def test_trie_is_brute_force_at_any_stretch(talks, rows, group):
    assert trie(talks, forest_rows=rows, group=group) == brute(rows_of(talks))


def test_query(llm):
    turns = llm.read.parquet(f"{SMALL}/conversations.parquet")
    found = queries.op11_prefix_trie(llm, SMALL)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows_of(turns))


def test_turnless_conversations_are_members_of_the_root(llm):
    # Conversation 5 takes five turns of the absent conversation 0 and has none after them.
    rows = [(c, 0, "u", "x") for c in range(1, 60)]
    df = llm.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    got = trie(df)
    assert got == brute(rows)
    assert any(depth == 0 and ends != hashlib.sha256(b"").hexdigest() for _, depth, *_, ends in got)


def test_empty_table(talks):
    assert conversation_trie(talks.limit(0)).collect() == []


def test_common_prefix():
    a, b = b"a" * SYMBOL, b"b" * SYMBOL
    assert common(a * 3 + b, a * 3 + b * 2) == 4
    assert common(a * 5 + b, a * 6) == 5
    assert common(b"", a) == 0
    assert common(b + a, a + a) == 0
