"""Words of many texts at once.

A word is what stands between white space, in lower case, without the marks at
its ends; what has no letter or digit is no word. Words are coded per batch, so
that Python looks at each distinct one once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8_000_000
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def normal(word: str) -> str:
    word = word.lower()
    return word if word.isalnum() else EDGES.sub("", word)


def words_of(text: str) -> list[str]:
    return [w for w in map(normal, text.split()) if w]


def coded_words(texts: pa.Array) -> Iterator[tuple[int, list[str], np.ndarray, np.ndarray]]:
    """For slices of the texts: first row, distinct words, their codes in a row, ends per text."""
    texts = pc.fill_null(texts, "")
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1), len(texts)]
    for low, high in zip(edges, edges[1:]):
        if high == low:
            continue
        parts = pc.utf8_split_whitespace(texts.slice(low, high - low))
        coded = parts.flatten().dictionary_encode()
        known: dict[str, int] = {}
        codes = [
            known.setdefault(w, len(known)) if w else -1
            for w in map(normal, coded.dictionary.to_pylist())
        ]
        all_codes = np.array(codes, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        ends = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        real = all_codes >= 0
        before = np.concatenate([[0], np.cumsum(real)])
        yield low, list(known), all_codes[real], before[ends]
