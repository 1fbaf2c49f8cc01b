"""Secret scans: base patterns, and a character convolutional network.

Base findings are spans of three patterns (``assign``, ``access``, ``hex``) and
always stay.  The network looks at every candidate, a token of ``ASSIGN_LEAST``
characters or more that touches no base finding, together with the characters
around it, and adds those at or above its threshold as kind ``model``.

It is learned from all documents, with no sample of them.  Base findings are
positives; all other candidates, and other runs of twelve characters without a
space, are unlabelled and may be secrets too.  Equal tokens of a label (equal to
the network, which sees the two ends of a long one) are learned once, in the
surroundings that sort first.  The tokens are dealt to parts of some ten thousand;
a round trains a copy of the network in every part, on all of its tokens, and
takes the mean of the copies' weights.  Where findings are few, each is in
several parts, so that every part has some.
Half of the unlabelled tokens are judged by a network trained against the other
half: those that score as the wanted share of positives with masked keywords do
are left out, and the rest is the background, all of which is learned.
Tokens whose shape (digits, small letters, capitals, others in a row) recurs and
is that of no positive stay in it however they score: numbers and words in
capitals are to be learned as clean.
That the token itself must tell, half of the positives take the surroundings of
an unlabelled token, which masks their keywords.  A quarter of the tokens is held
back.  The scores are calibrated by a logistic fit on them (of the unlabelled
ones on counts of their logits in steps of 1/32), and the threshold is the
highest at which another positive like those held back, all with masked
keywords, is found with the wanted recall.  Nothing
else bounds it, so what the background was taught cannot lower that recall.
Logits are compared, which do not saturate.  With too few positives held back to
tell (fewer than 19 for a recall of 0.95) nothing is added.

Defined cases: a null text is scanned as an empty one; texts without
candidates have no spans; texts of any length are scanned whole, their
candidates scored some thousands at a time; repeated rows get equal spans; an
empty table gives no rows; offsets are code points, ends exclusive; with no
positive or no negative in the sample nothing is added to the base findings.
``scan`` replaces a column named spans, ``redact`` the text; all others stay.
"""

from __future__ import annotations

import hashlib
import itertools
import pickle
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, stored
from .vectors import slices

# The base patterns, their least lengths, and their kinds in order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_LEAST = 8
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # runs of 16 characters at least
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "model")

#: What any base finding matches (and a little more: capitals are folded beyond ASCII), for a quick look at whole batches.
_BASE = rf"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{{{ASSIGN_LEAST}}})|AKIA[A-Z0-9]{{12}}|[0-9a-f]{{32}}"""
_TOKEN = re.compile(rf"[A-Za-z0-9+/_=-]{{{ASSIGN_LEAST},}}")
#: Characters of a run without a space that is learned beside the candidates.
_RUN_LEAST = 12


@dataclass(frozen=True)
class SecretConfig:
    #: Different other tokens from which on their shape is a common one.
    recurs: int = 8
    #: Tokens of a part, and the least number of positives there, which are dealt to several parts if need be.
    part: int = 65_536
    positives: int = 64
    #: Characters of a candidate, and of its context on either side, that the network sees.
    inside: int = 40
    around: int = 24
    filters: int = 24
    width: int = 5
    #: Trainings of the networks that judge, each without what the last ones left out, and rounds of the last network, all over all tokens; the least number of steps of a training in a part.
    judging: int = 3
    rounds: int = 2
    steps: int = 300
    #: Other tokens and positives of a step.
    others: int = 24
    sure: int = 8
    rate: float = 0.05
    recall: float = 0.95
    seed: int = 23


Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the base findings, leftmost and not overlapping within a kind."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def base_of(texts: pa.Array) -> list[list[Span]]:
    """The base findings in each text."""
    maybe = pc.fill_null(pc.match_substring_regex(texts, _BASE), False)
    rows = np.flatnonzero(maybe.to_numpy(zero_copy_only=False))
    out: list[list[Span]] = [[] for _ in range(len(texts))]
    for i, text in zip(rows.tolist(), texts.take(pa.array(rows)).to_pylist(), strict=True):
        out[i] = base_spans(text)
    return out


def candidates(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Tokens that touch no base finding; ``base`` is sorted by start."""
    out, k, last = [], 0, 0
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        while k < len(base) and base[k][0] < end:
            last = max(last, base[k][1])
            k += 1
        if last <= start:
            out.append((start, end))
    return out


_CLASSES = 99  # 95 printable ASCII characters, other, white space, edge, long


def encoded(text: str, start: int, end: int, config: SecretConfig) -> np.ndarray:
    """Codes of the context and the candidate (its two ends, if it is long)."""
    half = config.inside // 2
    before = text[max(0, start - config.around) : start]
    after = text[end : end + config.around]
    inside = text[start:end] if end - start <= config.inside else text[start : start + half] + text[end - half : end]

    def codes(s: str, size: int, right: bool) -> list[int]:
        got = [97 if c.isspace() else ord(c) - 32 if " " < c <= "~" else 96 for c in s]
        pad = [98] * (size - len(got))
        return pad + got if right else got + pad

    return np.array(codes(before, config.around, True) + codes(inside, config.inside, False) + codes(after, config.around, False), np.uint8)


#: The codes of the code points of the first plane; of the others it is that of the last.
_CODES = np.array([97 if chr(c).isspace() else c - 32 if 32 < c < 127 else 96 for c in range(1 << 16)], np.uint8)


#: Of each code: 0 for a digit, 1 for a small letter, 2 for a capital, 3 for all others but the edge.
_KINDS_END = 98
_KINDS = np.full(_KINDS_END, 3, np.uint8)
for _kind, _of in enumerate((range(0x30, 0x3A), range(0x61, 0x7B), range(0x41, 0x5B))):
    _KINDS[[c - 32 for c in _of]] = _kind


def _codes(text: str) -> np.ndarray:
    return _CODES[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), len(_CODES) - 1)]


#: Of each code: whether tokens have it, and whether it is neither white space nor an edge.
_IN_TOKEN = np.array([c < 95 and _TOKEN.fullmatch(chr(c + 32) * ASSIGN_LEAST) is not None for c in range(_CLASSES)], bool)
_IN_RUN = np.arange(_CLASSES) < 97


class Joined:
    """The codes of many texts in one row, edges between them, so that what surrounds any token of a text is a slice."""

    def __init__(self, texts: list[str], base: list[list[Span]], config: SecretConfig):
        self.config, edges = config, max(config.around, config.inside)
        sizes = np.array([len(t) for t in texts], np.int64)
        #: Where each text begins.
        self.first = np.cumsum(np.concatenate(([0], sizes[:-1]))) + edges * (1 + np.arange(len(texts))) if texts else np.zeros(0, np.int64)
        self.codes = np.full(int(sizes.sum()) + edges * (len(texts) + 1), 98, np.uint8)
        for text, at in zip(texts, self.first.tolist(), strict=True):
            self.codes[at : at + len(text)] = _codes(text)
        spans = np.array([(at + s, at + e) for at, own in zip(self.first.tolist(), base, strict=True) for s, e, _ in own], np.int64).reshape(-1, 2)
        #: Starts of the base findings, and the last end of all up to each.
        self.starts, self.ends = spans[:, 0], np.maximum.accumulate(np.concatenate(([0], spans[:, 1])))

    def tokens(self, kind: np.ndarray = _IN_TOKEN, least: int = ASSIGN_LEAST) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of ``least`` or more codes of a kind that touch no base finding."""
        turns = np.flatnonzero(np.diff(kind[self.codes])) + 1
        start, end = turns[::2], turns[1::2]
        some = end - start >= least
        start, end = start[some], end[some]
        free = self.ends[np.searchsorted(self.starts, end)] <= start
        return start[free], end[free]

    def texts_of(self, start: np.ndarray) -> np.ndarray:
        """The number of the text that each token is in."""
        return np.searchsorted(self.first, start, "right") - 1

    def inside(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Codes of the tokens, edges after a short one, the two ends of a long one."""
        size, half = self.config.inside, self.config.inside // 2
        rows = np.lib.stride_tricks.sliding_window_view(self.codes, size)
        out = rows[start]
        out[np.arange(size) >= (end - start)[:, None]] = 98
        long = np.flatnonzero(end - start > size)
        out[long, half:] = 98
        out[long, half : 2 * half] = rows[end[long] - half][:, :half]
        return out

    def rows(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """As ``encoded``, of many tokens."""
        beside = np.lib.stride_tricks.sliding_window_view(self.codes, self.config.around)
        return np.concatenate((beside[start - self.config.around], self.inside(start, end), beside[end]), 1)


def encoded_rows(codes: np.ndarray, at: np.ndarray, config: SecretConfig) -> np.ndarray:
    """As ``encoded``, of many candidates: rows of the text's start and end and the candidate's in ``codes``."""
    low, high, start, end = (c[:, None] for c in at.T)
    half, step = config.inside // 2, np.arange(config.inside)
    before = start - config.around + np.arange(config.around)
    inside = np.where((end - start <= config.inside) | (step < half), start + step, end - 2 * half + step)
    after = end + np.arange(config.around)
    places = np.concatenate((before, inside, after), 1)
    known = np.concatenate((before >= low, inside < end, after < high), 1)
    return np.where(known, codes[np.where(known, places, 0)], np.uint8(98))


def _shapes(rows: np.ndarray) -> list[bytes]:
    """Of each encoded token the kinds of its characters (digits, small letters, capitals, others), each run of one kind as one."""
    kinds = np.append(_KINDS, np.full(_CLASSES - _KINDS_END, 255, np.uint8))[rows]
    begins = kinds != 255
    begins[:, 1:] &= kinds[:, 1:] != kinds[:, :-1]
    data, ends = kinds[begins].tobytes(), np.cumsum(begins.sum(1)).tolist()
    return [data[i:j] for i, j in itertools.pairwise([0, *ends])]


def _pairs(each: np.ndarray) -> list[np.ndarray]:
    """What two characters in a row add at places 0 and 1, 2 and 3, ..., and at the end maybe what one does."""
    return [(each[j][:, None] + each[j + 1]).reshape(_CLASSES * _CLASSES, -1) if j + 1 < len(each) else each[j] for j in range(0, len(each), 2)]


def _sums(pairs: list[np.ndarray], z: np.ndarray, width: int) -> np.ndarray:
    """What the characters of every window of ``z`` (places, rows) add up to: places, rows, filters."""
    n, two = len(z) - width + 1, z[:-1] * _CLASSES + z[1:]
    out = pairs[0].take((two if width > 1 else z)[:n], 0)
    for k in range(1, len(pairs)):
        j = 2 * k
        out += pairs[k].take((two if j + 1 < width else z)[j : j + n], 0)
    return out


class _Room:
    """What the steps over ``rows`` of ``places`` share: room for the windows, and constants."""

    def __init__(self, config: SecretConfig, rows: int, places: int):
        n, w, filters = places - config.width + 1, config.width, config.filters
        self.hidden, self.added = np.empty((2, n, rows, filters), np.float32)
        #: The last bits of a value, and the places there, which count down.
        self.last = np.int32((1 << n.bit_length()) - 1)
        self.down = np.repeat(np.arange(n, 0, -1, dtype=np.int32), rows * filters).reshape(n, rows, filters)
        self.row = np.arange(rows)[:, None] + np.arange(w)[:, None, None] * rows
        self.place = np.tile(np.arange(filters), 2) + np.arange(w)[:, None, None] * filters


class CharCNN:
    """One convolution over character vectors, maxima over the candidate and its context, one logit."""

    def __init__(self, config: SecretConfig, dim: int = 8):
        self.config, self.dim = config, dim
        self._begin()
        self.scale, self.offset, self.threshold = 1.0, 0.0, np.inf  # of the logits; above any: nothing is added
        #: Of the tokens held back: the share found of the positives, and the share of the others that is at or above the threshold.
        self.found, self.flagged = 0.0, 0.0

    def _begin(self) -> None:
        config, dim, rng = self.config, self.dim, np.random.default_rng(self.config.seed)
        self.table = rng.normal(0, 0.3, (_CLASSES, dim)).astype(np.float32)
        self.kernel = rng.normal(0, 0.3, (config.width * dim, config.filters)).astype(np.float32)
        self.shift = np.zeros(config.filters, np.float32)
        self.out = rng.normal(0, 0.3, 2 * config.filters).astype(np.float32)
        self.bias = np.float32(0)
        self.tables = self.pairs = None  # what logits() makes of the weights

    def _forward(self, x: np.ndarray):
        """As :meth:`_steps`, of rows of codes."""
        return self._steps(np.ascontiguousarray(x.T).astype(np.intp), self._flat(self._each()), _Room(self.config, *x.shape))

    @staticmethod
    def _flat(each: np.ndarray) -> np.ndarray:
        """A row for each character: what it adds to each filter at each place of the kernel."""
        return np.ascontiguousarray(each.swapaxes(0, 1)).reshape(_CLASSES, -1)

    def _steps(self, z: np.ndarray, flat: np.ndarray, room: _Room):
        """Of codes by places the place and the value of each filter's maximum in the candidate and in its context, the bins of what it is made of, and the logits.

        A place's number, counting down, lies in the last bits of its value, so
        one pass finds the greatest value and its place; the value itself is
        then added up anew.  Of values that differ by less than 1/65536 of
        themselves any may be taken.
        """
        (a, b), hidden, w = self._bounds, room.hidden, self.config.width
        n = len(hidden)
        each = np.ascontiguousarray(flat.reshape(_CLASSES, w, -1).swapaxes(0, 1))
        each[0].take(z[:n], 0, hidden, "clip")
        for j in range(1, w):
            each[j].take(z[j : j + n], 0, room.added, "clip")
            np.add(hidden, room.added, hidden)
        bits = hidden.view(np.int32)
        np.bitwise_and(bits, ~room.last, bits)
        np.bitwise_or(bits, room.down, bits)
        both = np.concatenate((hidden[a:b].max(0), np.maximum(hidden[:a].max(0), hidden[b:].max(0))), 1)
        at = n - (both.view(np.int32) & room.last).astype(np.intp)
        bins = (z * flat.shape[1]).ravel().take(at * z.shape[1] + room.row) + room.place
        top = np.maximum(flat.ravel().take(bins).sum(0) + np.concatenate((self.shift, self.shift)), 0)
        return at, top, bins, top @ self.out + self.bias

    def _look(self) -> None:
        """Makes the tables that logits are looked up in."""
        if self.tables is None:
            self.tables = self._each()
            self.pairs = _pairs(self.tables)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "tables": None, "pairs": None}

    @property
    def _bounds(self) -> tuple[int, int]:
        """The windows of the kernel that lie in the candidate."""
        return self.config.around, self.config.around + self.config.inside - self.config.width + 1

    def _each(self) -> np.ndarray:
        """What a character adds at each place of the kernel."""
        return self.table @ self.kernel.reshape(self.config.width, self.dim, -1)

    def _tops(self, x: np.ndarray) -> np.ndarray:
        """The greatest value of each filter over the windows of ``x``, without the shift."""
        return _sums(self.pairs, np.ascontiguousarray(x.T).astype(np.intp), self.config.width).max(0)

    def _inner(self, inside: np.ndarray) -> np.ndarray:
        """What the candidates themselves, without their context, add to the logits."""
        self._look()
        size, out = (inside != 98).sum(1), np.empty(len(inside), np.float32)
        order = np.argsort(size, kind="stable")
        for i in range(0, len(order), 64):
            rows = order[i : i + 64]
            # all windows behind the end are equal: one is looked at
            top = self._tops(inside[rows, : size[rows[-1]] + self.config.width])
            out[rows] = np.maximum(top + self.shift, 0) @ self.out[: self.config.filters]
        return out

    def _outer(self, x: np.ndarray) -> np.ndarray:
        """What the context adds to the logits."""
        self._look()
        (a, b), out = self._bounds, np.empty(len(x), np.float32)
        for i in range(0, len(x), 64):
            top = np.maximum(self._tops(x[i : i + 64, : a + self.config.width - 1]), self._tops(x[i : i + 64, b:]))
            out[i : i + 64] = np.maximum(top + self.shift, 0) @ self.out[self.config.filters :]
        return out

    def logits(self, x: np.ndarray) -> np.ndarray:
        a = self.config.around
        return self._inner(x[:, a : a + self.config.inside]) + self._outer(x) + self.bias

    def reach(self, inside: np.ndarray, whole: Callable[[np.ndarray], np.ndarray], bound: float) -> np.ndarray:
        """Which logits are at or above ``bound``; ``whole`` gives the codes with the context of rows of ``inside``.

        The context is looked at only where the most that any could add would do.
        """
        out, own = np.zeros(len(inside), bool), self._inner(inside) + self.bias
        most = np.maximum(self.tables.max(1).sum(0) + self.shift, 0) @ np.maximum(self.out[self.config.filters :], 0)
        rows = np.flatnonzero(own + most * 1.001 + 0.001 >= bound)
        out[rows] = own[rows] + self._outer(whole(rows)) >= bound
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.scale * self.logits(x) + self.offset)))

    def _weights(self) -> list[np.ndarray]:
        return [self.table, self.kernel, self.shift, self.out, self.bias]

    def _with(self, weights: list[np.ndarray]) -> CharCNN:
        """This network with other weights."""
        other = CharCNN(self.config, self.dim)
        other.table, other.kernel, other.shift, other.out, other.bias = (np.array(w, np.float32) for w in weights)
        return other

    def _descend(self, positive: np.ndarray, other: np.ndarray, begin: float, end: float, rng: np.random.Generator) -> None:
        """Stochastic gradient descent, over all rows at least once; both labels weigh the same.  The rate falls from the share 1 - ``begin`` to 1 - ``end``."""
        config, filters, w = self.config, self.config.filters, self.config.width
        steps = max(round(config.steps * (end - begin)), -(-len(other) // config.others), -(-len(positive) // config.sure))

        def order(n: int, size: int) -> np.ndarray:
            return np.concatenate([rng.permutation(n) for _ in range(-(-steps * size // n))])

        sure, rest = order(len(positive), config.sure), order(len(other), config.others)
        # codes of each step, by places
        rows = lambda x, order, size: x[order[: steps * size]].reshape(steps, size, -1)
        codes = np.ascontiguousarray(np.concatenate((rows(positive, sure, config.sure), rows(other, rest, config.others)), 1).swapaxes(1, 2))
        y = np.repeat(np.float32([1, 0]), [config.sure, config.others])
        mass = np.repeat(np.float32([0.5 / config.sure, 0.5 / config.others]), [config.sure, config.others])
        room = _Room(config, len(y), codes.shape[1])
        # a row for each dimension, as of each character in _flat
        kernel = np.ascontiguousarray(self.kernel.reshape(w, self.dim, filters).swapaxes(0, 1)).reshape(self.dim, -1)
        for step in range(steps):
            rate = np.float32(4 * config.rate * (1 - begin - (end - begin) * step / steps))
            _, top, bins, logit = self._steps(codes[step].astype(np.intp), self.table @ kernel, room)
            error = (1 / (1 + np.exp(np.minimum(np.maximum(-logit, -60), 60))) - y) * mass
            back = error[:, None] * self.out * (top > 0)
            flat = np.bincount(bins.ravel(), np.concatenate([back.ravel()] * w), _CLASSES * w * filters).astype(np.float32).reshape(_CLASSES, -1)
            to_kernel, to_table = self.table.T @ flat, flat @ kernel.T
            self.out = self.out - rate * (error @ top)
            self.bias = np.float32(self.bias - rate * error.sum())
            kernel -= rate * to_kernel
            self.shift = self.shift - rate * (back[:, :filters] + back[:, filters:]).sum(0)
            self.table = self.table - rate * to_table
        self.kernel = np.ascontiguousarray(kernel.reshape(self.dim, w, filters).swapaxes(0, 1)).reshape(self.kernel.shape)
        self.tables = None

    def fit(self, x: np.ndarray, y: np.ndarray) -> CharCNN:
        """Learns from encoded tokens and their labels, as one part."""
        config = self.config
        inner = x[:, config.around : config.around + config.inside]
        h = np.array([zlib.crc32(row.tobytes()) for row in inner], np.int64)
        held = h < np.where(y == 1, *[_held_below(int((y == k).sum()), np.sort(h[y == k])) for k in (1, 0)])
        shapes = _shapes(inner)
        times = Counter(itertools.compress(shapes, ~held & (y == 0)))
        sure = set(itertools.compress(shapes, ~held & (y == 1)))
        common = np.array([times[k] >= config.recurs and k not in sure for k in shapes], bool)
        part = _Part(0, x, y.astype(np.int8), h, held, common, np.ones(len(y), bool))
        return self.learn(lambda do: [do(part)])

    def learn(self, each: Callable[[Callable[[_Part], object]], list]) -> CharCNN:
        """Training, then calibration and threshold; ``each`` gives what a function makes of every part, in the order of parts."""
        config = self.config
        counts = np.sum([[0, 0, 0, 0], *each(lambda part: np.bincount(2 * part.held[part.first] + part.y[part.first], minlength=4))], 0)
        if counts.min() < 1:
            return self
        # each half is judged, beside its positives, by what was trained on the other one
        judges, bounds = None, None
        for turn in range(config.judging):  # after the first turn, without what the other judge left out
            some = lambda part, k: part.clean(judges, bounds, part.half == k)  # noqa: E731, B023
            got = each(lambda part: [part.trained(self, some(part, k), (0, 1), (turn, k)) for k in (0, 1)])  # noqa: B023
            judges = [self._mean(own, self) for own in zip(*got, strict=True)]
            tops = zip(*each(lambda part: [part.of_positives(judges[1 - k], ~part.held & (part.half == k)) for k in (0, 1)]), strict=True)  # noqa: B023
            bounds = [float(np.sort(top)[max(0, self._below(len(top)) - 1)]) if len(top) else np.inf for top in map(np.concatenate, tops)]
        for turn in range(config.rounds):
            span = turn / config.rounds, (turn + 1) / config.rounds
            mean = self._mean(each(lambda part: part.trained(self, part.clean(judges, bounds), span, (turn, 2))), self)  # noqa: B023
            self.table, self.kernel, self.shift, self.out, self.bias = mean._weights()
            self.tables = None
        best = np.sort(np.concatenate(each(lambda part: part.of_positives(self, part.held))))
        k = self._below(len(best))
        bound = best[k - 1] if k else np.inf
        flagged, bins = (np.sum(x, 0) for x in zip(*each(lambda part: part.of_others(self, bound)), strict=True))
        self._calibrate(best, bins)
        if k < 1:  # too few to tell: nothing is added
            return self
        self.threshold = float(bound)
        self.found, self.flagged = float((best >= bound).mean()), float(flagged / bins.sum())
        return self

    def _below(self, n: int) -> int:
        """The k for which, of ``n`` like positives, another one is at or above the k-th lowest with the wanted recall, 1 - k / (n + 1) at least."""
        return int((1 - self.config.recall) * (n + 1))

    def _mean(self, got: list[tuple[list[np.ndarray], int] | None], otherwise: CharCNN) -> CharCNN:
        """The network with the mean of the parts' weights, each counting as its rows."""
        got = [x for x in got if x is not None]
        whole = sum(n for _, n in got)
        return self._with([sum(w.astype(np.float64) * n for w, n in zip(ws, [n for _, n in got], strict=True)) / whole for ws in zip(*[w for w, _ in got], strict=True)]) if got else otherwise

    def _calibrate(self, positive: np.ndarray, bins: np.ndarray) -> None:
        """The logistic fit of label on logit; ``bins``: see :meth:`_Part.of_others`."""
        rows = np.flatnonzero(bins)
        z = np.concatenate((positive.astype(np.float64), (rows - _BINS // 2) / _A_LOGIT))
        target = np.repeat([1.0, 0.0], [len(positive), len(rows)])
        mass = np.concatenate((np.full(len(positive), 0.5 / len(positive)), 0.5 * bins[rows] / bins.sum()))
        for _ in range(400):
            gap = mass * (1 / (1 + np.exp(-np.clip(self.scale * z + self.offset, -30, 30))) - target)
            self.scale -= 0.1 * float((gap * z).sum())
            self.offset -= 0.1 * float(gap.sum())


#: Bins of logits, and how many there are to 1.
_BINS, _A_LOGIT = 4097, 32
#: Hashes of tokens are below this; up to so many tokens exactly a quarter is held back.
_HASHES, _FEW = 1 << 32, 1000


def _held_below(n: int, lowest: np.ndarray) -> int:
    """The hash below which tokens are held back: a quarter of ``n``, of which ``lowest`` holds the lowest hashes (a quarter at least, if they are few), sorted."""
    return _HASHES // 4 if n >= _FEW else int(lowest[-(-n // 4) - 1]) + 1 if n else 0


@dataclass
class _Part:
    """Tokens that are trained on at once: codes, label, hash, whether held back, of a common shape, and no copy of a token of an earlier part."""

    number: int
    x: np.ndarray
    y: np.ndarray
    h: np.ndarray
    held: np.ndarray
    common: np.ndarray
    first: np.ndarray

    @property
    def half(self) -> np.ndarray:
        return self.h % 2

    def _masked(self, config: SecretConfig) -> np.ndarray:
        """The keyword is masked by the surroundings of another token of the same side."""
        a, b = config.around, config.around + config.inside
        rng, out = np.random.default_rng([config.seed, self.number]), self.x.copy()
        for side in (~self.held, self.held):
            rows, donors = np.flatnonzero(side & (self.y == 1)), np.flatnonzero(side & (self.y == 0))
            if len(donors):
                donors = rng.choice(donors, len(rows))
                out[rows, :a], out[rows, b:] = self.x[donors, :a], self.x[donors, b:]
        return out

    def trained(self, model: CharCNN, some: np.ndarray, span: tuple[float, float], turn: tuple[int, int]) -> tuple[list[np.ndarray], int] | None:
        """The weights after a round over ``some`` of the tokens that are not held back, and their number."""
        config = model.config
        positive, other = (np.flatnonzero(some & ~self.held & (self.y == k)) for k in (1, 0))
        if not len(positive) or not len(other):
            return None
        rng = np.random.default_rng([config.seed, self.number, *turn])
        sure = np.where((rng.random(len(positive)) < 0.5)[:, None], self._masked(config)[positive], self.x[positive])
        copy = model._with(model._weights())
        copy._descend(sure, self.x[other], *span, rng)
        return copy._weights(), len(positive) + len(other)

    def clean(self, judges: list[CharCNN] | None, bounds: list[float] | None, of: np.ndarray | bool = True) -> np.ndarray:
        """Of some tokens the positives, and the others that are below the bound of their half or have a common shape; without judges all."""
        if judges is None:
            return np.ones(len(self.y), bool) & of
        out = ((self.y == 1) | self.common) & of
        for k in (0, 1):
            rows = np.flatnonzero(~out & ~self.held & (self.half == k) & of)
            a = judges[1 - k].config.around
            out[rows] = ~judges[1 - k].reach(self.x[rows, a : a + judges[1 - k].config.inside], lambda some, rows=rows: self.x[rows[some]], bounds[k])
        return out

    def of_positives(self, model: CharCNN, some: np.ndarray) -> np.ndarray:
        """Logits of ``some`` of the positives, all masked."""
        return model.logits(self._masked(model.config)[some & self.first & (self.y == 1)])

    def of_others(self, model: CharCNN, bound: float) -> tuple[int, np.ndarray]:
        """Of the other tokens held back: how many are at or above ``bound``, and the counts of their logits in bins."""
        z = model.logits(self.x[self.held & (self.y == 0)])
        return int((z >= bound).sum()), np.bincount(np.clip(np.rint(z.astype(np.float64) * _A_LOGIT) + _BINS // 2, 0, _BINS - 1).astype(np.int64), minlength=_BINS)


def labelled_findings(docs: DataFrame, config: SecretConfig = SecretConfig()) -> DataFrame:
    """y, inside and near (before, after): the findings (1) and other tokens (0) of all ``docs``, each once.

    ``inside`` is what the network sees of a token; of its surroundings those
    are taken that sort first.
    """
    inner, around, half = config.inside, config.around, config.inside // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, str], tuple[str, str]] = {}

        def flushed() -> pa.RecordBatch:
            columns = [*zip(*[(y, inside, *near) for (y, inside), near in seen.items()], strict=True)] or [()] * 4
            seen.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.string()] * 3), strict=True)], ["y", "inside", "before", "after"])

        def add(text: str, s: int, e: int, label: int) -> None:
            token = label, text[s:e] if e - s <= config.inside else text[s : s + half] + text[e - half : e]
            near = text[s - around : s] if s > around else text[:s], text[e : e + around]
            if token not in seen or near < seen[token]:
                seen[token] = near

        for batch in batches:
            for part in slices(batch, "text"):
                texts, base = part["text"].to_pylist(), base_of(part["text"])
                for text, own in zip(texts, base, strict=True):
                    for s, e, kind in own:  # of an assignment the value without the keyword and quotes
                        add(text, ASSIGN.match(text, s).start(2) if kind == "assign" else s, e, 1)
                whole = Joined(texts, base, config)
                start, end = whole.tokens()
                begin, stop = whole.tokens(_IN_RUN, _RUN_LEAST)
                if len(start):  # a run that is a token is not added twice
                    at = np.minimum(np.searchsorted(start, begin), len(start) - 1)
                    new = (start[at] != begin) | (end[at] != stop)
                    start, end = np.concatenate((start, begin[new])), np.concatenate((end, stop[new]))
                else:
                    start, end = begin, stop
                at = whole.texts_of(start)
                low = whole.first[at]
                # add() in place of a call, for most of the time went into calls
                for i, s, e in zip(at.tolist(), (start - low).tolist(), (end - low).tolist(), strict=True):
                    text = texts[i]
                    token = 0, text[s:e] if e - s <= inner else text[s : s + half] + text[e - half : e]
                    near = text[s - around : s] if s > around else text[:s], text[e : e + around]
                    known = seen.get(token)
                    if known is None:
                        seen[token] = near
                        if len(seen) >= 100_000:  # what was flushed is put together below
                            yield flushed()
                    elif near < known:
                        seen[token] = near
        yield flushed()

    found = docs.where("text is not null").select("text").mapInArrow(run, "y int, inside string, before string, after string")
    return found.groupBy("y", "inside").agg(F.min(F.struct("before", "after")).alias("near"))


def coded(findings: DataFrame, config: SecretConfig = SecretConfig()) -> DataFrame:
    """y, h (a hash), shape (a hash) and x (codes) of :func:`labelled_findings`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = config.around, config.around + config.inside
        for batch in batches:
            y, inside = (batch[c].to_pylist() for c in ("y", "inside"))
            before, after = (pc.struct_field(batch["near"], c).to_pylist() for c in ("before", "after"))
            size = np.array([(*map(len, x),) for x in zip(before, inside, after, strict=True)], np.int64).reshape(-1, 3)
            ends = np.cumsum(size.ravel()).reshape(-1, 3)
            at = np.stack((ends[:, 0] - size[:, 0], ends[:, 2], ends[:, 0], ends[:, 1]), 1)
            x = encoded_rows(_codes("".join(itertools.chain.from_iterable(zip(before, inside, after, strict=True)))), at, config) if len(at) else np.zeros((0, a + b), np.uint8)
            data = x[:, a:b].tobytes()
            h = [zlib.crc32(data[i : i + b - a]) for i in range(0, len(data), b - a)]
            shapes = _shapes(x[:, a:b])
            known = {k: int.from_bytes(hashlib.blake2b(k, digest_size=8).digest(), "little", signed=True) for k in set(shapes)}
            shape = [known[k] for k in shapes]
            codes = pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1]), len(x), [None, pa.py_buffer(x.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(h, pa.int64()), pa.array(shape, pa.int64()), codes], ["y", "h", "shape", "x"])

    return findings.mapInArrow(run, "y int, h long, shape long, x binary")


_PART = "part long, n long, y binary, h binary, held binary, common binary, first binary, x binary"


def parts(tokens: DataFrame, config: SecretConfig = SecretConfig()) -> DataFrame:
    """The tokens of :func:`coded` dealt to parts, a row each."""
    sizes = dict(tokens.groupBy("y").count().collect())
    of = lambda y: tokens.where(F.col("y") == y)
    lowest = lambda y: np.array([r["h"] for r in of(y).orderBy("h").limit(-(-sizes[y] // 4)).select("h").collect()]) if 0 < sizes.get(y, 0) < _FEW else np.zeros(0)
    below = [_held_below(sizes.get(y, 0), lowest(y)) for y in (0, 1)]
    held = F.col("h") < F.when(F.col("y") == 1, below[1]).otherwise(below[0])
    n = max(1, round(sizes.get(0, 0) / config.part))
    copies = min(n, -(-config.positives * n // max(1, sizes.get(1, 0))))
    learned = tokens.where(~held).groupBy("shape").agg(F.count_if(F.col("y") == 0).alias("times"), F.max("y").alias("sure"))
    shapes = learned.where((F.col("times") >= config.recurs) & (F.col("sure") == 0)).select("shape", F.lit(True).alias("common"))
    rows = tokens.join(F.broadcast(shapes), "shape", "left").select("y", "h", held.alias("held"), F.coalesce("common", F.lit(False)).alias("common"), "x")
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), F.when(F.col("y") == 1, copies - 1).otherwise(0))).alias("copy"))
    rows = rows.select(F.pmod(F.xxhash64("x") + F.col("copy"), F.lit(n)).alias("part"), "y", "h", "held", "common", (F.col("copy") == 0).alias("first"), "x")

    def packed(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by([(c, "ascending") for c in ("y", "h", "x")])
        whole = [table[c].cast(t).to_numpy().astype(kind).tobytes() for c, t, kind in (("y", pa.int32(), np.int8), ("h", pa.int64(), np.int64), *[(c, pa.int8(), bool) for c in ("held", "common", "first")])]
        columns = [[table["part"][0].as_py()], [len(table)], *[[c] for c in whole], [b"".join(table["x"].to_pylist())]]
        return pa.table([pa.array(c, pa.int64() if k < 2 else pa.binary()) for k, c in enumerate(columns)], [c.split()[0] for c in _PART.split(", ")])

    return rows.groupBy("part").applyInArrow(packed, _PART)


def _each(rows: DataFrame) -> Callable[[Callable[[_Part], object]], list]:
    """What a function makes of every part, by Spark; the results are small (weights, counts, a number for each finding)."""
    kinds = {"y": np.int8, "h": np.int64, "held": bool, "common": bool, "first": bool}

    def each(do: Callable[[_Part], object]) -> list:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    own = {c: np.frombuffer(r[c], kind) for c, kind in kinds.items()}
                    got = do(_Part(r["part"], np.frombuffer(r["x"], np.uint8).reshape(r["n"], -1), **own))
                    yield pa.RecordBatch.from_arrays([pa.array([r["part"]], pa.int64()), pa.array([pickle.dumps(got)], pa.binary())], ["part", "got"])

        return [pickle.loads(r["got"]) for r in sorted(rows.mapInArrow(run, "part long, got binary").collect())]

    return each


def _find(texts: pa.Array, model: CharCNN) -> list[list[Span]]:
    """The findings in each text of a batch, by start and kind."""
    out = base_of(texts)
    if model.threshold < np.inf:
        whole = Joined([t or "" for t in texts.to_pylist()], out, model.config)
        start, end = whole.tokens()
        for i in range(0, len(start), 4096):
            s, e = start[i : i + 4096], end[i : i + 4096]
            good = np.flatnonzero(model.reach(whole.inside(s, e), lambda some, s=s, e=e: whole.rows(s[some], e[some]), model.threshold))
            at = whole.texts_of(s[good])
            low = whole.first[at]
            for k, a, b in zip(at.tolist(), (s[good] - low).tolist(), (e[good] - low).tolist(), strict=True):
                out[k].append((a, b, "model"))
    return [sorted(x, key=lambda z: (z[0], KINDS.index(z[2]))) for x in out]


def scan(docs: DataFrame, model: CharCNN, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The columns ``keep`` (all, if not given) with ``spans`` of ``text``: start, stop, kind, sorted."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                spans = [[{"start": s, "stop": e, "kind": k} for s, e, k in x] for x in _find(part["text"], shipped.value)]
                yield pa.RecordBatch.from_arrays([*[part[c] for c in names], pa.array(spans, kind)], [*names, "spans"])

    schema = docs.select(*names).withColumn("spans", F.array().cast("array<struct<start:int,stop:int,kind:string>>")).schema
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(run, schema)


def _masked(text: str, spans: list[Span], mask: str) -> str:
    out, at = [], 0
    for s, e, _ in spans:
        if e > at:
            out += [text[at:s], mask] if s >= at else []
            at = e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: CharCNN, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every finding in ``text`` replaced by ``mask`` (findings that overlap by one)."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part["text"].to_pylist()
                for i, spans in enumerate(_find(part["text"], shipped.value)):
                    if spans:
                        texts[i] = _masked(texts[i], spans, mask)
                yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(texts, part["text"].type))

    return docs.mapInArrow(run, docs.schema)


def fit(docs: DataFrame, config: SecretConfig = SecretConfig()) -> CharCNN:
    tokens = stored(coded(labelled_findings(docs, config), config), "tokens")
    dealt = stored(parts(tokens, config), "parts")
    discard(tokens)
    model = CharCNN(config).learn(_each(dealt))
    discard(dealt)
    return model
