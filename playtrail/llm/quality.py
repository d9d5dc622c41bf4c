"""Quality scores from two compression dictionaries.

One zstandard dictionary is built from text labelled good and one from text
labelled bad. A text is compressed piece by piece with each; how many bytes a
byte of it costs more with the bad dictionary than with the good one is the
evidence, and a rising curve fitted on labelled rows that built no dictionary
(isotonic regression, with a slight logistic slope so that no scores tie that
evidence tells apart) turns it into a score.

The model is fitted on bounded samples (`dictionary_rows` a class, and
`calibration_rows`, each row with at most `sample_chars` characters from a place
its id decides); every whole text is scored. Those three are parameters of the fit
(`fit_quality`).

Defined results: a null text is an empty one; an empty text has evidence 0 and
gets the score of that; repeated rows score alike; a missing class leaves every
score at the share of good labels (0.5 without any label); other columns, also
ones named like the result's, are not read. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
PIECE = 512
LEVEL = 3
DICTIONARY_BYTES = 65_536
SAMPLE_CHARS = 16_384
DICTIONARY_ROWS = 1_500
CALIBRATION_ROWS = 6_000
THRESHOLD = 0.3
TILT = 0.02
SPREAD = 0.05


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id as text, modulo `FOLDS`; a missing id counts as an empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return (F.crc32(text.cast("binary")) % FOLDS).cast("int")


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    #: Evidence and the share of good labels there, both rising.
    knots: list[float]
    shares: list[float]

    def evidence(self, texts: Iterator[str | None]) -> np.ndarray:
        if not self.good or not self.bad:
            return np.array([0.0 for _ in texts])
        packers = [_compressor(self.good), _compressor(self.bad)]
        found = []
        for text in texts:
            data = (text or "").encode()
            good, bad = (
                sum(len(p.compress(data[i : i + PIECE])) for i in range(0, len(data), PIECE))
                for p in packers
            )
            found.append((bad - good) / max(1, len(data)))
        return np.array(found, float)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        slope = 1 / (1 + np.exp(-np.clip(evidence / SPREAD, -500, 500)))
        return (1 - TILT) * np.interp(evidence, self.knots, self.shares) + TILT * slope


def _compressor(dictionary: bytes):
    import zstandard

    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=held, write_content_size=False, write_dict_id=False
    )


def build_dictionary(texts: list[str], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary, or the texts themselves where they are too few to train one."""
    import zstandard

    data = [t.encode() for t in texts if t]
    pieces = [d[i : i + 2048] for d in data for i in range(0, len(d), 2048)]
    try:
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(data)[-size:]


def fit_curve(evidence: np.ndarray, label: np.ndarray) -> tuple[list[float], list[float]]:
    """Isotonic regression: the middle of each pool of neighbours, and its share of good labels."""
    pools: list[list[float]] = []  # good, rows, first, last
    order = np.argsort(evidence, kind="stable")
    for x, good in zip(evidence[order].tolist(), label[order].tolist()):
        pools.append([good, 1, x, x])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            good, rows, _, last = pools.pop()
            pools[-1][0] += good
            pools[-1][1] += rows
            pools[-1][3] = last
    share = float(label.mean())
    middle = [(first + last) / 2 for _, _, first, last in pools]
    shares = np.maximum.accumulate([(good + share) / (rows + 1) for good, rows, _, _ in pools])
    return middle, shares.tolist()


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int, chars: int = SAMPLE_CHARS) -> list:
    """Up to `rows` labelled documents, by the hash of their ids: (doc_id, quality, text)."""
    chosen = (
        labels.groupBy("doc_id")
        .agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    spare = F.greatest(F.length(text) - chars, F.lit(0)) + 1
    part = F.substring(text, (F.pmod(F.xxhash64("doc_id"), spare) + 1).cast("int"), F.lit(chars))
    # `chosen` has at most `rows` rows.
    found = docs.select("doc_id", part.alias("text")).join(F.broadcast(chosen), "doc_id")
    found = found.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    return sorted(found.collect(), key=lambda r: r["doc_id"])


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    dictionary_rows: int = DICTIONARY_ROWS,
    calibration_rows: int = CALIBRATION_ROWS,
    sample_chars: int = SAMPLE_CHARS,
) -> QualityModel:
    """Fit on labelled rows outside fold 0; the last fold calibrates."""
    docs = docs.select(F.col("doc_id"), F.col("text"))
    labels = labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
    labels = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    first, last = labels.where(fold().between(1, FOLDS - 2)), labels.where(fold() == FOLDS - 1)
    texts = [
        [r["text"] for r in labelled_sample(docs, first.where(F.col("quality") == q), dictionary_rows, sample_chars)]
        for q in (1, 0)
    ]
    good, bad = (build_dictionary(t) if t else b"" for t in texts)
    held = labelled_sample(docs, last, calibration_rows, sample_chars)
    label = np.array([r["quality"] for r in held], int)
    counts = [len(t) + int((label == q).sum()) for q, t in zip((1, 0), texts)]
    share = counts[0] / sum(counts) if sum(counts) else 0.5
    model = QualityModel(good, bad, [0.0], [share])
    if good and bad:
        if len(set(label.tolist())) == 2:
            model.knots, model.shares = fit_curve(model.evidence(r["text"] for r in held), label)
        else:  # nothing to calibrate on: the sign of the evidence decides
            model.knots, model.shares = [-SPREAD, 0.0, SPREAD], [0.0, share, 1.0]
    return model


def score_quality(docs: DataFrame, model: QualityModel, score: str, text: str = "text") -> DataFrame:
    """The rows with the score appended under that name; `text` names the column that is scored."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            evidence = model.evidence(t.as_py() for t in batch.column(text))
            yield batch.append_column(score, pa.array(model.score(evidence)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(compute, f"{schema}, `{score}` double")


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    model = fit_quality(docs, labels)
    scored = score_quality(docs.select("doc_id", "text"), model, "score")
    return scored.select(
        "doc_id",
        (fold() == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, columns as they are."""
    score = "_score"
    while score in {c.lower() for c in docs.columns}:
        score = "_" + score
    scored = score_quality(docs, fit_quality(docs, labels), score)
    return scored.where(F.col(score) >= threshold).drop(score)
