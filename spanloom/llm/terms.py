"""Words of many texts as integers, without a step for each word.

A word is a run of bytes of one class in a text's UTF-8 form, A-Z taken as
a-z.  As every byte of a character beyond ASCII is 128 or more, a class of
bytes is a class of characters too.  The bytes of all words are laid in one
Arrow array and dictionary-encoded there, so equal codes mean equal words.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of letters, and of letters and digits; all bytes beyond ASCII are in both.
LETTERS = np.zeros(256, bool)
LETTERS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
ALPHANUMERIC = LETTERS.copy()
ALPHANUMERIC[0x30:0x3A] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@dataclass(frozen=True)
class Words:
    """``codes``: each word's place in ``terms``; ``counts``: words of each text; ``starts``, ``stops``: bytes of each word in its own text."""

    codes: np.ndarray
    counts: np.ndarray
    terms: pa.Array
    starts: np.ndarray
    stops: np.ndarray

    @classmethod
    def of(cls, texts: pa.Array, inside: np.ndarray) -> Words:
        """The words of an Arrow array of strings (null: none)."""
        n = len(texts)
        if not n:
            none = np.empty(0, np.int64)
            return cls(none, none, pa.array([], pa.large_binary()), none, none)
        plain = pc.fill_null(texts.cast(pa.large_binary()), b"")
        bounds = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + n + 1]
        data = plain.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.empty(0, np.uint8)
        bounds = bounds - bounds[0]
        within = inside[raw]
        edge = np.zeros(len(raw) + 1, bool)  # a word does not reach over the end of its text
        edge[bounds] = True
        first, last = within.copy(), within.copy()
        first[1:] &= ~within[:-1] | edge[1:-1]
        last[:-1] &= ~within[1:] | edge[1:-1]
        starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        ends = np.concatenate((np.zeros(1, np.int64), np.cumsum(stops - starts)))
        letters = _LOWER[raw[within]]
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(letters)]).dictionary_encode()
        counts = np.diff(np.searchsorted(starts, bounds))
        base = np.repeat(bounds[:-1], counts)
        return cls(words.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts, words.dictionary, starts - base, stops - base)
