"""Personal data by patterns and by a semi-Markov conditional random field.

The base patterns (e-mail, IP address, card, phone) are always reported. Beside
them a semi-Markov model reads the surroundings of every digit and at sign: it
scores whole candidate spans of at most `MAX_TOKENS` tokens by features of the
span (shape, checksum, borders, words before), and dynamic programming over the
row of tokens chooses boundaries and types together. What it finds beyond the
base spans, and apart from them, is added where it beats "no entity" by `MARGIN`.

The weights are learned by gradient ascent on the likelihood of base matches in a
bounded sample: of every kind `windows` places with a base match, and twice as many
numbers or at signs outside of any (hard negatives), each with the `WINDOW`
characters around it. They are drawn by a hash from all whole texts, so a kind that
is rare is learned from wherever it occurs. A task keeps the places of the smallest
hashes, groups of tasks do so again, and the driver is sent the sample alone. Every
whole text is then read. Documents are never shuffled, and a text without a digit
or at sign costs one search.

Defined results: a null text is an empty one and has no spans; spans of one start
are ordered by kind as listed; repeated rows give equal rows; without any match to
learn from nothing is added; an empty table gives an empty one. `find_pii` reads no
column but `doc_id` and `text`, whatever the others are called; `redact_pii` keeps
all columns and changes `text` and, where it is there, `n_chars`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KINDS = ("email", "ip", "card", "phone")
# The base patterns. A digit before an address or card would only repeat a try.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TRIGGER = re.compile(r"[@0-9]+")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
INNER = re.compile(r"[A-Za-z0-9@._%+()\x20-]+")
CUES = {
    "email": ("mail", "email", "contact", "write"),
    "ip": ("ip", "host", "server", "addr", "address"),
    "card": ("card", "visa", "mastercard", "amex", "credit"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
}
GROUPED_PHONE = re.compile(r"(?:\+?[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}")
COUNTRY_CODE = re.compile(r"^\+[0-9]{1,3}[ .-]*")
GROUPED_CARD = re.compile(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}")
FULL_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
AROUND = 48
MAX_TOKENS = 24
MARGIN = 1.0
SAMPLE_WINDOWS = 40
WINDOW = 64
SAMPLE_GROUPS = 16
EPOCHS = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _at_most_255(digits: str) -> bool:
    value = digits.lstrip("0")
    return len(value) < 4 and int(value or "0") <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches from left to right, in time proportional to the text."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            last = found.end()
            yield start, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base patterns, sorted."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    for m in IP.finditer(text):
        if all(_at_most_255(p) for p in m.group().split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = re.sub("[ -]", "", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 10 <= sum(map(str.isdigit, m.group())) <= 15:
            spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def span_features(text: str, start: int, end: int, tokens: int, before: str) -> list[float]:
    """Features of one whole candidate span."""
    span = text[start:end]
    digits = re.sub("[^0-9]", "", span)
    n = len(digits)
    parts = span.split(".")
    octets = len(parts) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    left, right = text[start - 1 : start], text[end : end + 1]
    words = {w.lower() for w in re.findall("[A-Za-z]+", before)}
    only_numbers = not re.search("[A-Za-z@]", span)
    return [
        1.0,
        float(span.count("@") == 1),
        float(bool(FULL_EMAIL.fullmatch(span))),
        float(octets),
        float(only_numbers and 14 <= n <= 19 and "." not in span and luhn(digits)),
        float(bool(GROUPED_CARD.fullmatch(span))),
        float(span[0] == "+" and only_numbers and 10 <= n <= 15),
        float(bool(GROUPED_PHONE.fullmatch(span))),
        float(14 <= n <= 19),
        float(10 <= n <= 13),
        float(bool(re.search("[A-Za-z]", span))),
        float(" " in span),
        float(not (left.isalnum() or left in ("@", "_", ".", "-", "+", "%"))),
        float(not (right.isalnum() or right in ("@", "_", "-"))),
        tokens / 10,
        *[float(not words.isdisjoint(CUES[k])) for k in KINDS],
    ]


@dataclass
class Zone:
    """A stretch of tokens, and the candidate spans in it."""

    tokens: list[tuple[int, int]]
    spans: np.ndarray  # first token, token after the last
    features: np.ndarray


def zones(text: str) -> Iterator[Zone]:
    """Stretches around digits and at signs, as wide as words that touch them."""
    bounds: list[list[int]] = []
    for m in TRIGGER.finditer(text):
        low, high = max(0, m.start() - AROUND), min(len(text), m.end() + AROUND)
        if bounds and low <= bounds[-1][1]:
            bounds[-1][1] = high
        else:
            bounds.append([low, high])
    for low, high in bounds:
        tokens = [m.span() for m in TOKEN.finditer(text, low, high)]
        digits = np.cumsum([0, *(b - a if text[a].isdigit() else 0 for a, b in tokens)])
        ats = np.cumsum([0, *(text[a] == "@" for a, _ in tokens)])
        spans, features = [], []
        for i, (start, _) in enumerate(tokens):
            if not (text[start].isascii() and (text[start].isalnum() or text[start] in "+(")):
                continue
            reach = INNER.match(text, start)
            stop = reach.end() if reach else start
            for j in range(i, min(len(tokens), i + MAX_TOKENS)):
                end = tokens[j][1]
                if end > stop:
                    break
                n = digits[j + 1] - digits[i]
                if text[end - 1].isalnum() and (ats[j + 1] - ats[i] == 1 or n >= 4):
                    before = text[max(0, start - 24) : start]
                    spans.append((i, j + 1))
                    features.append(span_features(text, start, end, j + 1 - i, before))
        if spans:
            yield Zone(tokens, np.array(spans), np.array(features))


def _lattice(zone: Zone, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward and backward log sums over segmentations; a token outside scores 0."""
    n = len(zone.tokens)
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    for k, (i, j) in enumerate(zone.spans.tolist()):
        by_end[j].append(k)
        by_start[i].append(k)
    ahead, back = np.zeros(n + 1), np.zeros(n + 1)
    of_span = np.logaddexp.reduce(scores, axis=1)
    for j in range(1, n + 1):
        terms = [ahead[j - 1], *(ahead[zone.spans[k, 0]] + of_span[k] for k in by_end[j])]
        ahead[j] = np.logaddexp.reduce(terms)
    for i in range(n - 1, -1, -1):
        terms = [back[i + 1], *(back[zone.spans[k, 1]] + of_span[k] for k in by_start[i])]
        back[i] = np.logaddexp.reduce(terms)
    return ahead, back, float(ahead[n])


def best_spans(zone: Zone, weights: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(first token, kind, token after the last, score) of the best segmentation."""
    scores = zone.features @ weights.T
    kind, score = scores.argmax(1), scores.max(1)
    n = len(zone.tokens)
    by_end: dict[int, list[int]] = {}
    for k in np.flatnonzero(score > 0).tolist():
        by_end.setdefault(int(zone.spans[k, 1]), []).append(k)
    if not by_end:
        return []
    best, taken = [0.0] * (n + 1), [-1] * (n + 1)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for k in by_end.get(j, ()):
            value = best[zone.spans[k, 0]] + score[k]
            if value > best[j]:
                best[j], taken[j] = value, k
    found, j = [], n
    while j > 0:
        k = taken[j]
        if k < 0:
            j -= 1
        else:
            found.append((int(zone.spans[k, 0]), int(kind[k]), int(zone.spans[k, 1]), float(score[k])))
            j = int(zone.spans[k, 0])
    return found[::-1]


def examples(text: str) -> Iterator[tuple[str, dict[tuple[int, int], int]]]:
    """The text with its base spans, and again without the country code of a grouped phone number.

    The second teaches what the base patterns leave out: nothing in the base matches
    alone could tell the model that a number is one without its plus sign too.
    """
    base = base_spans(text)
    yield text, {(a, b): kind for a, kind, b in base}
    for start, kind, end in base:
        local = COUNTRY_CODE.sub("", text[start:end])
        if kind == KINDS.index("phone") and GROUPED_PHONE.fullmatch(local):
            changed = text[:start] + local + text[end:]
            gold = {(a, b): k for a, k, b in base_spans(changed)}
            yield changed, gold | {(start, start + len(local)): kind}


def train(texts: list[str], epochs: int = EPOCHS, penalty: float = 0.02) -> np.ndarray:
    """Weights (kind, feature) that make the base matches of the texts likely."""
    data = []
    for text, gold in (example for given in texts for example in examples(given)):
        for zone in zones(text):
            places = [(zone.tokens[i][0], zone.tokens[j - 1][1]) for i, j in zone.spans.tolist()]
            data.append((zone, [(k, gold[p]) for k, p in enumerate(places) if p in gold]))
    weights = np.zeros((len(KINDS), 15 + len(KINDS)))
    weights[:, 0] = -4
    if not any(gold for _, gold in data):
        return weights
    moment, square = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, epochs + 1):
        slope = -penalty * weights
        for zone, gold in data:
            scores = zone.features @ weights.T
            ahead, back, total = _lattice(zone, scores)
            inside = ahead[zone.spans[:, 0]] + back[zone.spans[:, 1]] - total
            slope -= np.exp(np.minimum(scores + inside[:, None], 0)).T @ zone.features
            for k, kind in gold:
                slope[kind] += zone.features[k]
        # Adam: steps of about one size for each weight.
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        weights += 0.3 * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return weights


def added_spans(text: str, base: list[tuple[int, int, int]], weights: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of the model that touch no base span."""
    found = []
    for zone in zones(text):
        for i, kind, j, score in best_spans(zone, weights):
            start, end = zone.tokens[i][0], zone.tokens[j - 1][1]
            if score >= MARGIN and not any(a < end and start < b for a, _, b in base):
                found.append((start, kind, end))
    return found


def all_spans(text: str, weights: np.ndarray) -> tuple[list, list]:
    if not TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, weights))


def _around(text: str, start: int, end: int) -> str:
    """The text around a span, cut at white space where there is some nearby."""
    low, high = max(0, start - WINDOW), min(len(text), end + WINDOW)
    if low:
        gap = text.find(" ", low, start)
        low = gap + 1 if gap >= 0 else low
    if high < len(text):
        gap = text.rfind(" ", end, high)
        high = gap if gap >= 0 else high
    return text[low:high]


def sample_places(text: str) -> Iterator[tuple[int, str]]:
    """(kind, window) of every base match, and of every number or at sign outside of them."""
    base = base_spans(text)
    for start, kind, end in base:
        yield kind, _around(text, start, end)
    reached, k = 0, 0
    for m in TRIGGER.finditer(text):
        while k < len(base) and base[k][0] < m.end():
            reached = max(reached, base[k][2])
            k += 1
        if m.start() >= reached:
            yield len(KINDS), _around(text, *m.span())


def sample_windows(docs: DataFrame, windows: int = SAMPLE_WINDOWS) -> list[str]:
    """The texts of the sample: at most `windows` a kind and twice as many negatives."""
    from xxhash import xxh64_intdigest

    limits = [windows] * len(KINDS) + [2 * windows]

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The least hashes of each kind, and the greatest of them that still counts.
        held: list[dict[int, str]] = [{} for _ in limits]
        most = [1 << 63] * len(limits)
        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if not text or not TRIGGER.search(text):
                    continue
                for kind, window in sample_places(text):
                    order = xxh64_intdigest(window.encode(), kind) >> 1
                    if order < most[kind]:
                        held[kind][order] = window
                        if len(held[kind]) >= 2 * limits[kind]:
                            held[kind] = dict(sorted(held[kind].items())[: limits[kind]])
                            most[kind] = max(held[kind])
        rows = [(k, o, w) for k, found in enumerate(held) for o, w in sorted(found.items())[: limits[k]]]
        columns = list(zip(*rows)) or [()] * 3
        kinds = [pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "priority", "window"]
        )

    drawn = docs.select(F.col("text").cast("string")).mapInArrow(draw, "kind int, priority long, window string")
    limit = F.when(F.col("kind") == len(KINDS), 2 * windows).otherwise(windows)
    # Equal windows have equal hashes and count once; first within groups of tasks, then over all.
    rows = drawn.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(SAMPLE_GROUPS)))
    for keys in (["kind", "part"], ["kind"]):
        place = F.dense_rank().over(Window.partitionBy(*keys).orderBy("priority"))
        rows = rows.withColumn("place", place).where(F.col("place") <= limit).dropDuplicates([*keys, "priority"])
    return [r["window"] for r in sorted(rows.collect(), key=lambda r: (r["kind"], r["priority"]))]


def fit_pii(docs: DataFrame, windows: int = SAMPLE_WINDOWS) -> np.ndarray:
    return train(sample_windows(docs, windows))


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


DIGEST = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"
)


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: base counts, their digest, and all spans."""
    weights = fit_pii(docs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                base, spans = all_spans(text.as_py() or "", weights)
                counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                digest = hashlib.sha256(_listed(base).encode()).hexdigest()
                rows.append((doc_id, *counts, digest, _listed(spans)))
            kinds = [pa.int64()] * 5 + [pa.string()] * 2
            names = [x.split()[0] for x in DIGEST.split(", ")]
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(find, DIGEST)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one."""
    out, last = [], 0
    for start, kind, end in spans:
        if start >= last:
            out += [text[last:start], f"[{KINDS[kind].upper()}]"]
        last = max(last, end)
    return "".join([*out, text[last:]])


def redact_pii(docs: DataFrame) -> DataFrame:
    """The documents with personal data replaced and `n_chars`, if there, counted anew."""
    weights = fit_pii(docs)
    names = docs.columns

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = names.index("text")
            texts = batch.column(at).to_pylist()
            texts = [t if t is None else redacted(t, all_spans(t, weights)[1]) for t in texts]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.column(at).type)
            if "n_chars" in names:
                k = names.index("n_chars")
                kept = columns[k].to_pylist()
                counted = [n if t is None else len(t) for n, t in zip(kept, texts)]
                columns[k] = pa.array(counted, columns[k].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(redact, docs.schema)
