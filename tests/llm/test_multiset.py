"""Multiset fingerprints: their sums, and the query against a brute-force version."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from playtrail.llm import multiset_hash as m
from playtrail.llm import queries

SMALL = "/root/testdata/sf0.001"


def brute(df):
    text = F.coalesce("text", F.lit(""))
    rows = [tuple(r) for r in df.select("doc_id", text, F.xxhash64(text)).collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    found = []
    for i, (doc_id, text, _) in enumerate(rows):
        after, half = rows[(i + 1) % len(rows)][1], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed, other = map(m.fingerprint, (text, edited, after))
        found.append(
            (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), m.printable(own), m.printable(changed),
             float(m.likeness(own, changed)), float(m.likeness(own, other)))
        )
    return sorted(found, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query(llm):
    assert rows_of(queries.op12_multiset_hash(llm, SMALL)) == brute(llm.read.parquet(f"{SMALL}/documents.parquet"))


@pytest.mark.parametrize("bucket_bytes, hot_rows", [(1 << 30, 1000), (100, 50), (100, 1000)])
def test_any_buckets_and_hot_rows(llm, bucket_bytes, hot_rows):
    rows = [(5, "a b\nc d e f g")] * 1200 + [(None, f"x{i % 7}") for i in range(100)]
    rows += [(i, None if i % 3 else "q\n\n" + "w z " * i) for i in range(60)] + [(2**63 - 1, "m"), (-(2**63), "n")]
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert rows_of(m.document_fingerprints(df, bucket_bytes, hot_rows)) == brute(df)


def test_odd(odd, none):
    assert rows_of(m.document_fingerprints(odd.drop("part"))) == brute(odd)
    assert m.document_fingerprints(none).collect() == []
    (only,) = m.document_fingerprints(odd.where("doc_id = 4")).collect()
    assert only.near_next == 1.0


def test_order_does_not_count_and_paragraphs_come_and_go():
    rng = random.Random(3)
    parts = [" ".join(rng.choices("abcdefgh", k=rng.randrange(12))) for _ in range(40)]
    text = "\n".join(parts)
    shuffled = parts[:]
    rng.shuffle(shuffled)
    assert (m.fingerprint("\n".join(shuffled)) == m.fingerprint(text)).all()
    assert not (m.fingerprint("\n".join([*parts, parts[0]])) == m.fingerprint(text)).all()
    without = m.removed(m.fingerprint(text), m.summed([[parts[3], parts[7]]])[0])
    assert (without == m.fingerprint("\n".join(parts[:3] + parts[4:7] + parts[8:]))).all()
    assert (m.added(without, m.summed([[parts[7], parts[3]]])[0]) == m.fingerprint(text)).all()


def test_likeness_is_near_the_share_of_common_runs():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(4000)]
    errors = []
    for _ in range(60):
        a, b = (" ".join(rng.choices(words, k=300)) for _ in range(2))
        cut = rng.randrange(300)
        mixed = " ".join(a.split()[:cut] + b.split()[cut:])
        runs = [{tuple(t.split()[i : i + 3]) for i in range(298)} for t in (a, mixed)]
        exact = 2 * len(runs[0] & runs[1]) / sum(map(len, runs))
        errors.append(float(m.likeness(m.fingerprint(a), m.fingerprint(mixed))) - exact)
    assert np.std(errors) < 0.08
    assert m.likeness(m.fingerprint(""), m.fingerprint("a b")) == 0.0
    assert m.likeness(m.fingerprint(""), m.fingerprint(None)) == 1.0
