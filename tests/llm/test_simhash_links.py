"""Links of fingerprints against all pairs, for every number of bits and in hot buckets."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from playtrail.llm import simhash, store
from playtrail.llm.components import _star, components


def roots(prints, bits):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def signed(p):
    return p - 2**64 if p >= 2**63 else p


@pytest.mark.parametrize("bits", [0, 1, 2, 3, 5])
@pytest.mark.parametrize("tile", [simhash.TILE, 4])
def test_groups_are_those_of_all_pairs(llm, bits, tile):
    rng = np.random.default_rng(bits)
    prints = {0, 2**64 - 1}
    for _ in range(12):
        base = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(20):
            # Flips near each other, so that links of a chain hold several of them.
            at = (rng.integers(0, 64) + rng.integers(0, 20, rng.integers(0, bits + 3))) % 64
            prints.add(base ^ sum(1 << int(b) for b in set(at.tolist())))
    prints = sorted(prints, key=signed)
    df = llm.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = {r["node"]: r["root"] for r in components(simhash.fingerprint_links(df, bits, tile)).collect()}
    groups = defaultdict(set)
    for p, root in zip(prints, roots(prints, bits)):
        groups[root].add(found.get(signed(p), signed(p)))
    assert all(len(g) == 1 for g in groups.values())
    assert len(set.union(*groups.values())) == len(groups)


def test_every_single_difference_is_a_link(llm):
    base = 0x0123456789ABCDEF
    prints = [base, *(base ^ (1 << b) for b in range(64))]
    edges = simhash.fingerprint_links(llm.createDataFrame([(signed(p),) for p in prints], "fp long"), 1)
    assert {r["root"] for r in components(edges).collect()} == {min(map(signed, prints))}


def test_rounds_leave_one_table(llm, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "scratch_root", lambda spark: f"file://{tmp_path}")
    chain = llm.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r["root"] for r in components(chain).collect()} == {0}
    assert len(list(tmp_path.glob("edges-*"))) == 1
    with pytest.raises(ValueError, match="not in the shared folder"):
        store.discard(llm, "file:///elsewhere/edges")


def test_a_node_with_many_neighbours(llm):
    star = llm.createDataFrame([(5000, i) for i in range(3000)] + [(5000, 7)] * 9, "a long, b long")
    assert {r["root"] for r in components(star).collect()} == {0}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_exploded_prints_are_not_broadcast(llm, tmp_path):
    """About 36 bucket rows a print, in a table that Spark sizes by the file of prints."""
    rng = np.random.default_rng(7)
    prints = rng.integers(-(2**63), 2**63 - 1, 500).tolist()
    llm.createDataFrame([(p,) for p in prints], "fp long").write.parquet(f"{tmp_path}/prints")
    links = plan(simhash.fingerprint_links(llm.read.parquet(f"{tmp_path}/prints")))
    assert "SortMergeJoin" in links and "BroadcastHashJoin" not in links


def test_no_written_table_of_a_group_is_broadcast(llm, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "scratch_root", lambda spark: f"file://{tmp_path}")
    chain = [(i, i + 1) for i in range(5)]
    edges = llm.createDataFrame(chain, "u long, v long")
    edges.write.parquet(f"{tmp_path}/edges")
    for larger in (True, False):
        star = plan(_star(llm.read.parquet(f"{tmp_path}/edges"), larger))
        assert "SortMergeJoin" in star and "BroadcastHashJoin" not in star
    docs = llm.createDataFrame([(i, f"one text {i % 3}") for i in range(9)], "doc_id long, text string")
    assert plan(simhash.simhash_groups(docs)).count("SortMergeJoin") >= 2
