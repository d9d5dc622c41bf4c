"""Benchmark overlaps against a brute-force version that compares words on every diagonal."""

from __future__ import annotations

import itertools
import math
import random

import pytest

from playtrail.llm import decontamination as d
from playtrail.llm import queries
from playtrail.llm.words import words_of

SMALL = "/root/testdata/sf0.001"


def test_masks_survive_any_two_substitutions():
    seen = lambda places, m, s: all(c == "0" or s + k not in places for k, c in enumerate(m))
    for places in itertools.combinations(range(13), 2):
        assert any(seen(places, m, s) for m in d.MASKS for s in range(13 - len(m) + 1))


def seeded(same, masks):
    """Whether some mask reads only matching words somewhere."""
    return any(
        all(c == "0" or same[s + k] for k, c in enumerate(m)) for m in masks for s in range(len(same) - len(m) + 1)
    )


def brute_best(same):
    """Best scoring stretch, the earliest end and then the earliest start with that score."""
    best = (0, 0, 0)
    for end in range(len(same) + 1):
        score, found = 0, (0, end)
        for start in range(end - 1, -1, -1):
            score += 1 if same[start] else -2
            if score >= found[0]:
                found = (score, start)
        if found[0] > best[0]:
            best = (found[0], found[1], end)
    return best[1], best[2]


def brute_stretches(same, need, low=0):
    if len(same) < need:
        return []
    start, end = brute_best(same)
    if sum(same[start:end]) < need:
        return []
    return [
        *brute_stretches(same[:start], need, low),
        (sum(same[start:end]), low + start, low + end),
        *brute_stretches(same[end:], need, low + end),
    ]


def brute(docs, items):
    found = []
    for doc_id, text in docs:
        words = words_of(text or "")
        for item_id, passage in items:
            item = words_of(passage or "")
            if not item:
                continue
            n = len(item)
            need = n if n < 5 else min(12, math.ceil(0.8 * n))
            masks = ["1" * n] if n < 5 else d.MASKS
            known, kept = set(item), []
            if len(known.intersection(words)) < min(need, len(known)) / 2:
                continue
            for diagonal in range(1 - n, len(words)):
                low, high = max(0, -diagonal), min(n, len(words) - diagonal)
                same = [words[diagonal + k] == item[k] for k in range(low, high)]
                if sum(same) >= need and seeded(same, masks):
                    kept += [(-m, low + diagonal + a, low + diagonal + b) for m, a, b in brute_stretches(same, need)]
            apart = []
            for m, a, b in sorted(kept):
                if all(b <= x or y <= a for _, x, y in apart):
                    apart.append((m, a, b))
            found += [(doc_id, item_id, -m, a, b) for m, a, b in apart]
    return sorted(found, key=str)


def pairs(df, key):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


def overlaps(docs, items):
    return sorted((tuple(r) for r in d.find_overlaps(docs, items).collect()), key=str)


@pytest.fixture(scope="module")
def planted(llm):
    """Items of all lengths, and documents that hold them whole, twice, in parts, and with substitutions."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([1, 2, 3, 4, 4, 5, 6, 9, 13, 30, 60, 200])]
    items += [(9, items[9][1]), (None, items[10][1]), (50, None), (51, ""), (52, " .,- ")]
    items += [(53, "ho ho ho ho ho ho ho"), (54, "le le le le")]
    docs = [(0, None), (1, ""), (2, "ho " * 40), (None, items[9][1]), (None, items[9][1]), (3, "le le le le le le le le le")]
    for i in range(120):
        words = rng.choices([f"v{k}" for k in range(400)], k=rng.randrange(40))
        for _ in range(rng.randrange(1, 4)):
            passage = rng.choice(items[:12])[1].split()
            cut = rng.randrange(len(passage))
            passage = rng.choice([passage, passage, passage[cut:], passage[:cut], passage[:cut] + ["new", "words"] + passage[cut:]])
            rate = rng.choice([0, 0, 0.05, 0.15, 0.3])
            words += [w if rng.random() >= rate else "other" for w in passage]
            words += rng.choices([f"v{k}" for k in range(400)], k=rng.randrange(9))
        docs.append((100 + i, " ".join(words)))
    return (
        llm.createDataFrame([(*x, "a", 1) for x in docs], "doc_id long, text string, item_id string, row int"),
        llm.createDataFrame([(*x, "b") for x in items], "item_id long, text string, doc_id string"),
    )


def test_every_overlap_of_planted_passages(planted):
    docs, items = planted
    found = overlaps(docs, items)
    assert found == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))
    assert len({(a, b) for a, b, *_ in found}) < len(found)  # some documents hold an item twice


def test_query(llm):
    docs, items = (llm.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    got = sorted((tuple(r) for r in queries.op3_decontamination(llm, SMALL).collect()), key=str)
    assert got == brute(pairs(docs, "doc_id"), pairs(items, "item_id"))


def test_a_passage_held_twice_is_two_rows(llm):
    passage = " ".join(f"w{i}" for i in range(20))
    docs = llm.createDataFrame([(1, f"{passage} between {passage}")], "doc_id long, text string")
    items = llm.createDataFrame([(5, passage)], "item_id long, text string")
    assert overlaps(docs, items) == [(1, 5, 20, 0, 20), (1, 5, 20, 21, 41)]


def test_items_of_four_words_are_found(llm):
    docs = llm.createDataFrame([(1, "He said: the quick brown fox! And left.")], "doc_id long, text string")
    items = llm.createDataFrame([(5, "The quick brown fox")], "item_id long, text string")
    assert overlaps(docs, items) == [(1, 5, 4, 2, 6)]


def test_dropped_documents(planted):
    docs, items = planted
    texts, passages = pairs(docs, "doc_id"), pairs(items, "item_id")
    dirty = {t for t in {t for _, t in texts} if brute([(0, t)], [(i, p) for i, p in passages if len(words_of(p or "")) >= 5])}
    dirty |= {t for _, t in texts if t and any(words_of(t) == words_of(p or "") for _, p in passages)}
    kept = d.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(map(str, pairs(kept, "doc_id"))) == sorted(str(x) for x in texts if x[1] not in dirty)
    clash = docs.withColumnsRenamed({"row": "_digest"})
    assert d.drop_contaminated(clash, items).count() == kept.count()


def test_odd_and_empty(llm, odd, none, planted):
    _, items = planted
    assert overlaps(odd, items) == [] and overlaps(none, items) == []
    assert overlaps(odd, items.limit(0)) == []
    assert d.drop_contaminated(odd, items).count() == odd.count()
    assert d.drop_contaminated(odd, items.limit(0)).count() == odd.count()
    assert d.drop_contaminated(none, items).count() == 0


def test_what_is_sent_to_tasks_has_one_size(llm, planted):
    _, items = planted
    sizes = {len(d.seed_filter(d.item_seeds(x))) for x in (items, items.limit(0), items.limit(1))}
    assert sizes == {1 << (d.FILTER_BITS - 3)}


def test_exploded_seeds_are_not_broadcast(llm):
    """Sixteen salted rows for every window of an item, in a table that Spark sizes by the items' file."""
    words = [f"w{i}" for i in range(60)]
    items = llm.createDataFrame([(1, " ".join(words[:30]))], "item_id long, text string")
    docs = llm.createDataFrame([(i, " ".join(words[i:])) for i in range(9)], "doc_id long, text string")
    found = d.find_overlaps(docs, items)
    text = found._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in text.splitlines() if "Join" in line]
    assert sum("SortMergeJoin" in j for j in joins) == 2
    assert [j for j in joins if "Broadcast" in j and "hash" in j] == []
    assert found.count() == 9
