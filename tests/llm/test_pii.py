"""Personal data: odd texts, the bounded sample, and the query against a brute-force version."""

from __future__ import annotations

import hashlib
import re

import pytest

from playtrail.llm import pii

SMALL = "/root/testdata/sf0.001"
KINDS = ("email", "ip", "card", "phone")
PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(n // 10 + n % 10 for n in doubled) % 10 == 0


def holds(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == 1:
        return all(int(p[-400:]) <= 255 and not p[:-400].strip("0") for p in span.split("."))
    if kind == 2:
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == 0 or 10 <= len(digits) <= 15


def brute(text):
    found = [(m.start(), k, m.end()) for k in range(4) for m in re.finditer(PATTERNS[k], text) if holds(k, m[0])]
    return sorted(found)


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def checked(df):
    """Base columns equal to brute force; every span list holds the base spans and is sorted."""
    texts = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
    want = []
    for doc_id, text in texts:
        base = brute(text)
        counts = [sum(k == kind for _, k, _ in base) for kind in range(4)]
        want.append((doc_id, *counts, hashlib.sha256(listed(base).encode()).hexdigest()))
    rows = pii.find_pii(df).collect()
    assert sorted((tuple(r)[:6] for r in rows), key=str) == sorted(want, key=str)
    bases = {row[-1]: None for row in want}
    for doc_id, text in texts:
        bases[hashlib.sha256(listed(brute(text)).encode()).hexdigest()] = set(listed(brute(text)).split(",")) - {""}
    for r in rows:
        spans = [s for s in r["spans"].split(",") if s]
        assert bases[r["base_sha256"]] <= set(spans)
        keys = [(int(a), KINDS.index(k)) for k, a, _ in (s.split(":") for s in spans)]
        assert keys == sorted(keys)
    return rows


def test_query_on_whole_tables(llm, odd):
    checked(llm.read.parquet(f"{SMALL}/documents.parquet"))
    checked(odd.withColumnsRenamed({"part": "spans", "score": "n_ip"}))


ZEROS = "0" * 5000


@pytest.mark.parametrize(
    "text",
    [ZEROS + ".1.2.3", "1." + ZEROS + "7.2.3", ZEROS + "256.1.2.3", "1.2.3." + "9" * 5000, "at " + ZEROS, ZEROS + "@" + ZEROS + ".x"],
)
def test_long_runs_of_digits(llm, text):
    df = llm.createDataFrame([(1, text, len(text))], "doc_id long, text string, n_chars long")
    assert pii.base_spans(text) == brute(text)
    checked(df)
    (row,) = pii.redact_pii(df).collect()
    whole = all(ZEROS not in text[a:b] for a, _, b in brute(text))
    assert (ZEROS in row["text"]) == (ZEROS in text and whole)


def planted(llm):
    """Base matches to learn from, and spans that only the model can find."""
    rows = [(i, f"Please call +1 (212) 555-{i:04} today, or write to user{i}@mail.org about it.") for i in range(60)]
    rows += [(100 + i, f"In {1900 + i} the host 10.0.{i}.7 had {i * 37} visits, page {i}.") for i in range(60)]
    rows += [(200 + i, f"Chapter {i} of {2000 + i}: version {i}.2, call no. {i * 991}.") for i in range(60)]
    rows += [(300 + i, f"Please call (212) 555-{i:04} today, he said.") for i in range(10)]
    return llm.createDataFrame([(*r, len(r[1])) for r in rows], "doc_id long, text string, n_chars long")


def test_the_model_adds_spans_that_no_base_pattern_finds(llm):
    df = planted(llm)
    rows = {r["doc_id"]: r for r in checked(df)}
    for i in range(10):
        text = f"Please call (212) 555-{i:04} today, he said."
        at = text.index("(212)")
        assert rows[300 + i]["n_phone"] == 0
        assert f"phone:{at}:{at + 14}" in rows[300 + i]["spans"].split(",")
    assert all(rows[200 + i]["spans"] == "" for i in range(60))
    redacted = {r["doc_id"]: r for r in pii.redact_pii(df).collect()}
    assert redacted[303]["text"] == "Please call [PHONE] today, he said."
    assert redacted[303]["n_chars"] == len(redacted[303]["text"])


def test_the_sample_is_bounded_and_draws_rare_kinds_from_anywhere(llm):
    rows = [(i, "year 1999 and 2001 " * 30 + f" in {i}") for i in range(400)]
    rows.append((999, "x " * 50_000 + "mail a.b@x.org now " + "y " * 50_000))
    df = llm.createDataFrame(rows, "doc_id long, text string").repartition(7)
    sample = pii.sample_windows(df, 5)
    assert len(sample) <= 5 * len(KINDS) + 10
    assert any("a.b@x.org" in w for w in sample)
    assert max(map(len, sample)) <= 2 * pii.WINDOW + 40
    assert sample == pii.sample_windows(df.repartition(3), 5)
    # Many copies of one text are one window.
    same = llm.createDataFrame([(i, "write to a.b@x.org") for i in range(500)], "doc_id long, text string")
    assert pii.sample_windows(same, 5) == ["write to a.b@x.org"]
    assert pii.sample_windows(df.limit(0), 5) == []


def test_places_of_a_text():
    text = "On 12 May write to a.b@x.org or 7."
    assert [(k, text[19:28] in w) for k, w in pii.sample_places(text)] == [(0, True), (4, True), (4, True)]
