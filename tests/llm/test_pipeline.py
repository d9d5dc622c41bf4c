from __future__ import annotations

import corpus_pipeline
from playtrail.llm import pii, quality, simhash
from playtrail.llm.store import written
from playtrail.llm.words import words_of

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns(llm, odd, none):
    for source in (odd, none):
        docs = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            after = written(stage(llm, docs, SMALL), name.replace(" ", "-"))
            assert after.columns == source.columns, name
            assert after.count() <= docs.count()
            docs = after
        assert corpus_pipeline.STAGES[-1][1](llm, docs, SMALL).count() >= docs.count()


def test_run_against_brute_force(llm):
    docs, labels, bench = (
        llm.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels", "benchmark")
    )
    kept = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in quality.quality_scores(docs, labels).where("predicted = 1").collect()}
    kept = {d: t for d, t in kept.items() if d in good}
    ids = sorted(kept)
    prints = [simhash.fingerprint(kept[d]) for d in ids]
    label = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    kept = {ids[root]: kept[ids[root]] for root in set(label)}
    items = [" " + " ".join(words_of(r["text"])) + " " for r in bench.collect()]
    dirty = {d for d, t in kept.items() if any(i in " " + " ".join(words_of(t)) + " " for i in items)}
    got = {r["doc_id"] for r in corpus_pipeline.run(llm, SMALL).collect()}
    assert got == set(kept) - dirty


def test_redaction_takes_effect(llm):
    docs = llm.read.parquet(f"{SMALL}/documents.parquet")
    after = corpus_pipeline.personal_data(llm, docs, SMALL).collect()
    assert all(not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in after)
