"""Token ids of many texts by a `tokenizers` file, with a bounded word cache.

A text falls into chunks at single spaces, where neither kind of tokenizer here
ever makes a token across: one drops white space, the other starts a token with
the space. So the ids of a text are those of its chunks in a row, and a chunk
seen before costs a lookup. Texts in which a space could matter otherwise (runs
of white space, rare white space, the look of a special token) go to the
tokenizer whole.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 8_000_000
CACHE_WORDS = 400_000
JOINED_WORDS = 2_000
ODD_WITH_SPACES = (
    r"<\||[ \n][ \n]|^[ \n]|[ \n]$"
    r"|[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
ODD_WITHOUT_SPACES = r"<\|"
# Its last letter is none that normal forms or lower case turn into a letter and a sign, which
# could join the mark (U+0130, and some of the blocks from Devanagari to Tibetan and of U+FB1D on).
MARKED_WORD = r"^\p{L}*[^\P{L}\x{130}\x{900}-\x{fff}\x{fb1d}-\x{fb4f}][.,]$"

_ENCODERS: dict[str, TextEncoder] = {}


def _items(values: pa.Array) -> list:
    # By way of NumPy: `to_pylist` makes an Arrow scalar of every item first.
    return values.to_numpy(zero_copy_only=False).tolist()


class TextEncoder:
    """`encode` gives one array of ids per text."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        whole, first, second = (self._ids(x) for x in ("a b", "a", "b"))
        self.spaced = whole != first + second
        self.cache_words = cache_words
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.vocabulary_size = max(vocabulary.values()) + 1
        # Where a word starts (spaces kept) or ends (spaces dropped) in a row of ids.
        edge = np.zeros(self.vocabulary_size, bool)
        edge[[i for t, i in vocabulary.items() if (t[:1] == "Ġ" if self.spaced else t[-4:] == "</w>")]] = True
        self.edge = edge
        self.mark_ids = {c: array("I", self._ids(c)).tobytes() for c in ".,"}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers; a null is an empty text."""
        texts = pc.fill_null(texts, "")
        found: list[np.ndarray] = []
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False)) // SLICE_BYTES
        edges = [0, *(np.flatnonzero(np.diff(sizes)) + 1), len(texts)]
        for low, high in zip(edges, edges[1:]):
            if high > low:
                found += self._slice(texts.slice(low, high - low))
        return found

    def _slice(self, texts: pa.Array) -> list[np.ndarray]:
        pattern = ODD_WITH_SPACES if self.spaced else ODD_WITHOUT_SPACES
        odd = pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)
        plain = iter(self._plain(texts.filter(pa.array(~odd))) if not odd.all() else ())
        return [
            np.array(self._ids(texts[i].as_py()), "<u4") if is_odd else next(plain)
            for i, is_odd in enumerate(odd)
        ]

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        if self.spaced:
            # A line break stays at the head of its chunk; one more is put before the text,
            # so that its first word is not taken for one after a space, and dropped below.
            texts = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        else:
            texts = pc.replace_substring(texts, "\n", " ")
        parts = pc.split_pattern(texts, " ")
        coded = parts.flatten().dictionary_encode()
        values = self._lookup(coded.dictionary)
        lengths = np.fromiter(map(len, values), np.int64, len(values)) // 4
        data = np.frombuffer(b"".join(values), "<u4")
        starts = np.cumsum(lengths) - lengths
        chunk = coded.indices.to_numpy(zero_copy_only=False)
        of_chunk = lengths[chunk]
        ends = np.cumsum(of_chunk)
        at = np.arange(ends[-1] if len(ends) else 0)
        ids = data[at + np.repeat(starts[chunk] - (ends - of_chunk), of_chunk)]
        last = np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        stops = np.concatenate([[0], ends[last - 1]])
        return [ids[a + self.spaced : b] for a, b in zip(stops, stops[1:])]

    def _lookup(self, chunks: pa.Array) -> list[bytes]:
        """Ids of different chunks; a word and the mark after it are never one token, so words
        are looked up without it."""
        marked = pc.match_substring_regex(chunks, MARKED_WORD)
        words = pc.if_else(marked, pc.utf8_slice_codeunits(chunks, 0, -1), chunks).dictionary_encode()
        known = self._cached(_items(words.dictionary))
        values = [known[i] for i in _items(words.indices)]
        marks = _items(pc.utf8_slice_codeunits(chunks.filter(marked), -1))
        for i, mark in zip(np.flatnonzero(marked).tolist(), marks):
            values[i] += self.mark_ids[mark]
        return values

    def _cached(self, words: list[str]) -> list[bytes]:
        if len(self.new) > self.cache_words:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        found = list(map(new.get, words))
        missing = [i for i, value in enumerate(found) if value is None]
        if old:
            for i in missing:
                value = old.get(words[i])
                if value is not None:
                    found[i] = new[words[i]] = value
            missing = [i for i in missing if found[i] is None]
        if missing:
            unseen = [words[i] for i in missing]
            values = self._words(unseen)
            new.update(zip(unseen, values))
            for i, value in zip(missing, values):
                found[i] = value
        return found

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of chunks: plain words many at a time, the others one by one."""
        values: list[bytes] = [b""] * len(words)
        simple = [i for i, word in enumerate(words) if word.isalpha()]
        other = [i for i, word in enumerate(words) if not word.isalpha()]
        head = " " if self.spaced else ""
        for low in range(0, len(simple), JOINED_WORDS):
            run = simple[low : low + JOINED_WORDS]
            (row,) = self._rows([head + " ".join([words[i] for i in run])])
            marks = np.flatnonzero(self.edge[np.frombuffer(row, "<u4")])
            if len(marks) != len(run):
                other += run
                continue
            cuts = [*marks.tolist(), len(row) // 4] if self.spaced else [0, *(marks + 1).tolist()]
            for i, a, b in zip(run, cuts, cuts[1:]):
                values[i] = row[4 * a : 4 * b]
        texts = [" " + words[i] if self.spaced and words[i][:1] != "\n" else words[i] for i in other]
        for i, row in zip(other, self._rows(texts)):
            values[i] = row
        return values

    def _rows(self, texts: list[str]) -> Iterator[bytes]:
        for low in range(0, len(texts), JOINED_WORDS):
            some = texts[low : low + JOINED_WORDS]
            for coded in self.tokenizer.encode_batch_fast(some, add_special_tokens=False):
                yield array("I", coded.ids).tobytes()


def encoder(path: str) -> TextEncoder:
    """One encoder, and so one cache, per file and worker process."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]
