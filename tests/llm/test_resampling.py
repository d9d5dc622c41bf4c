"""Importance resampling and the radix sort against brute-force versions."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from playtrail.llm import queries, radix
from playtrail.llm import resampling as r

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return words, [zlib.crc32(run.encode()) % 10000 for run in runs]


def brute(docs, target):
    found = [(d, *features(t)) for d, t in docs]
    s, t = Counter(), Counter()
    for _, _, buckets in found:
        s.update(buckets)
    for text in target:
        t.update(features(text)[1])
    above, below = s.total() + 10000, t.total() + 10000
    gain = [math.floor(1000 * math.log((t[i] + 1) * above / ((s[i] + 1) * below))) for i in range(10000)]
    rows = []
    for d, words, buckets in found:
        h = int(hashlib.sha256(f"42:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([d, len(buckets), weight, score, None, len(words)])
    able = sorted((x for x in rows if x[5] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    for rank, row in enumerate(able[: 5 * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(x[:5]) for x in rows), key=str)


def resampled(docs, target):
    return sorted((tuple(x) for x in r.resample(docs, target).collect()), key=str)


def pairs(df):
    return [(x["doc_id"], x["text"]) for x in df.select("doc_id", "text").collect()]


def test_query(llm):
    docs, target = (llm.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = sorted((tuple(x) for x in queries.op13_resampling(llm, SMALL).collect()), key=str)
    assert got == brute(pairs(docs), [x["text"] for x in target.collect()])
    assert sum(x[4] is not None for x in got) > 5


def test_odd_and_empty(llm, odd, none):
    target = llm.createDataFrame([("The lazy dog runs",), (None,), ("",)], "text string")
    wide = odd.withColumns({"rank": F.lit("x"), "weight": F.lit(1)})
    many = wide
    for _ in range(4):
        many = many.unionByName(many)
    assert resampled(many, target) == brute(pairs(many), ["The lazy dog runs", None, ""])
    assert resampled(odd, target.limit(0)) == brute(pairs(odd), [])
    assert resampled(none, target) == []


def test_buckets_of_long_words_and_all_scripts():
    rng = random.Random(1)
    parts = ["a", "B9", " ", "-", "é", "ß", "中文", "\x7f", "w" * 47, "w" * 48, "w" * 49, "z" * 300, "\n", "_"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(500)] + [None, ""]
    for sliced in (pa.array(texts), pa.array(["x", *texts])[1:]):
        ((low, words, owners, found),) = r.feature_buckets(sliced)
        for i, text in enumerate(texts):
            want = features(text)
            assert words[i] == len(want[0])
            assert Counter(found[owners == i].tolist()) == Counter(want[1])


@pytest.mark.parametrize("block_rows", [1 << 18, 16, 1])
def test_radix_sort(llm, block_rows):
    rng = random.Random(2)
    keys = [rng.choice([None, -(2**63), -1, 0, 1, 2047, 2048, 2**40, 2**63 - 1, rng.randrange(-9, 9)]) for _ in range(60)]
    rows = [(k, rng.choice([-5, 0, 3, 2**33])) for k in keys] + [(7, 7)] * 30
    df = llm.createDataFrame(rows, "id long, score long").repartition(3)
    digits = [*radix.ascending(F.col("id")), *radix.descending(F.col("score"))]
    got = sorted(radix.radix_sorted(df, digits, block_rows).collect(), key=lambda x: x["_at"])
    assert [x["_at"] for x in got] == list(range(len(rows)))
    want = sorted(rows, key=lambda x: (-x[1], x[0] is None, x[0] or 0))
    assert [(x["id"], x["score"]) for x in got] == want


def test_radix_sort_keeps_the_order_of_equal_digits_and_takes_nothing(llm):
    same = llm.createDataFrame([(1,)] * 5, "k long")
    places = [x["_at"] for x in radix.radix_sorted(same, radix.ascending(F.col("k"))).collect()]
    assert sorted(places) == list(range(5))
    assert radix.radix_sorted(same.limit(0), radix.ascending(F.col("k"))).collect() == []


def test_gains_are_floors():
    gain = r.gains(np.array([0, 5, 9]), np.array([3, 0, 0]))
    above, below = 14 + 3, 3 + 3
    want = [math.floor(1000 * math.log((t + 1) * above / ((s + 1) * below))) for s, t in ((0, 3), (5, 0), (9, 0))]
    assert gain.tolist() == want
