"""Vectorised hashing of words and characters, used inside Spark tasks.

All functions work on whole texts; long texts are walked in segments so that
temporary arrays stay small whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: The separators of words: space and U+0009 to U+000D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
SEGMENT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the one of the splitmix generator)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[0] = 1
    return np.multiply.accumulate(out)


_tables: dict[str, np.ndarray] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        n = max(n, SEGMENT + 4096)
        if n > 4 * SEGMENT:  # one very long word: not worth keeping
            return _powers(_BASE, n), _powers(_INVERSE, n)
        _tables["up"], _tables["down"] = _powers(_BASE, n), _powers(_INVERSE, n)
    return _tables["up"], _tables["down"]


def words_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (bytes) of each word ``[^\\x20\\x09-\\x0D]+``."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~SEPARATOR[raw]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    out = np.empty(len(starts), U)
    at = 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + SEGMENT, "right")))
        piece = raw[low : ends[stop - 1]].astype(U) + U(1)
        up, down = _power_tables(len(piece))
        total = np.empty(len(piece) + 1, U)
        total[0] = 0
        np.cumsum(piece * up[: len(piece)], out=total[1:])
        s, e = starts[at:stop] - low, ends[at:stop] - low
        out[at:stop] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
        at = stop
    return out, starts, ends


def windows(words: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.empty(0, U)
    factor = U((_BASE * (2 * seed + 3)) % 2**64 | 1)
    out = np.full(m, seed + n, U)
    for j in range(n):
        out *= factor
        out += words[j : j + m]
    return mix(out)


def groups(texts: list, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` characters together."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def slices(batch: pa.RecordBatch, column: str, rows: int = 256, limit: int = 2 * SEGMENT) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of at most ``rows`` rows and about ``limit`` bytes of ``column`` (a longer value goes alone)."""
    kind = batch.schema.field(column).type
    unit = 4 if pa.types.is_list(kind) else 1
    sizes = (pc.list_value_length if unit > 1 else pc.binary_length)(batch[column])
    sizes = pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64) * unit
    pa.default_memory_pool().release_unused()  # a worker would keep what earlier batches and tasks took
    start = size = 0
    for i, n in enumerate(sizes.tolist()):
        if i - start >= rows or (i > start and size + n > limit):
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < batch.num_rows:
        yield batch.slice(start)


_SPACE = np.zeros(0x110000, bool)
_SPACE[[i for i in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]]] = True


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(points: np.ndarray, space: np.ndarray, shift: U, sizes: tuple[int, ...]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and buckets of the n-grams of each size without white space strictly inside."""
    inner = np.zeros(len(points), bool)
    acc = points.copy()
    for n in range(2, max(sizes) + 1):
        acc = acc[:-1] * U(_BASE) + points[n - 1 :]
        inner = inner[:-1] | space[n - 2 : len(points) - 1] if n > 2 else inner[:-1]
        if n in sizes:
            at = np.flatnonzero(~inner)
            yield at, mix(acc[at] + U(n)) >> shift


def _pairs(words: np.ndarray) -> np.ndarray:
    """Hashes of neighbours; a word that repeats the one before it makes the same pair whatever the word."""
    return mix(np.where(words[1:] == words[:-1], U(2), words[:-1] * U(3) + words[1:]))


def subwords(texts: list[str], bits: int, sizes: tuple[int, ...] = (3, 4, 5)) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words, pairs of words and character n-grams, and the text of each.

    An n-gram may begin or end with the white space around its word but holds
    none inside, as if words were written ``<word>``.
    """
    joined = code_points(" " + "  ".join(texts) + " ")
    ends = np.cumsum([len(t) + 2 for t in texts])
    points = joined.astype(U)
    space = _SPACE[joined]
    points[space] = U(32)
    shift = U(64 - bits)
    buckets, owners = [], []
    for at, bucket in _grams(points, space, shift, sizes):
        buckets.append(bucket)
        owners.append(at)
    edge = np.diff(np.concatenate(([True], space, [True])).astype(np.int8))
    starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(starts):
        up, down = _power_tables(len(points))
        total = np.concatenate((np.zeros(1, U), np.cumsum((points + U(1)) * up[: len(points)])))
        words = mix((total[stops] - total[starts]) * down[starts] + U(1))
        buckets.append(words >> shift)
        owners.append(starts)
        same = np.searchsorted(ends, starts[1:], "right") == np.searchsorted(ends, starts[:-1], "right")
        buckets.append(_pairs(words)[same] >> shift)
        owners.append(starts[1:][same])
    owner = np.searchsorted(ends, np.concatenate(owners), "right")
    return np.concatenate(buckets).astype(np.int64), np.minimum(owner, len(texts) - 1)


def long_subwords(text: str, bits: int, sizes: tuple[int, ...] = (3, 4, 5), step: int = SEGMENT) -> Iterator[np.ndarray]:
    """The buckets that :func:`subwords` gives for one text, a part of ``step`` characters at a time.

    The characters that an n-gram reaches over the end of a part, the hash of a
    word that is not yet over and the last whole word are carried along, so the
    parts together are the whole text's, also where a word is longer than a part.
    """
    shift = U(64 - bits)
    begun, length, last = 0, 0, np.empty(0, U)  # of the open word: its hash so far and its length
    for low in range(-1, len(text) + 1, step):
        points = code_points((" " if low < 0 else "") + text[max(low, 0) : low + step + max(sizes) - 1] + " ").astype(U)
        points = points[: min(step + max(sizes) - 1, len(text) + 1 - low)]
        space = _SPACE[points.astype(np.int64)]
        points[space] = U(32)
        for at, bucket in _grams(points, space, shift, sizes):
            yield bucket[at < step].astype(np.int64)
        own, gap = points[:step], space[:step]
        edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
        starts, stops = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        up, down = _power_tables(len(own))
        total = np.concatenate((np.zeros(1, U), np.cumsum((own + U(1)) * up[: len(own)])))
        raw = (total[stops] - total[starts]) * down[starts] if len(starts) else np.empty(0, U)
        if length and len(starts) and starts[0] == 0:
            raw[0] = U((begun + int(raw[0]) * pow(_BASE, length, 2**64)) % 2**64)
            length += int(stops[0])
        elif length:
            raw, length = np.concatenate((np.array([begun], U), raw)), 0
        if len(stops) and stops[-1] == len(own):
            begun, length, raw = int(raw[-1]), length if starts[-1] == 0 and length else int(stops[-1] - starts[-1]), raw[:-1]
        else:
            length = 0
        words = mix(raw + U(1))
        yield (words >> shift).astype(np.int64)
        both = np.concatenate((last, words))
        yield (_pairs(both) >> shift).astype(np.int64)
        last = both[-1:]
