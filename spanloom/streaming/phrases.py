"""Phrases of a token stream that comes out of order.

Tokens wait in state until the watermark passes them, so a phrase sees its
tokens in the order of time whatever micro-batch brought them.  The session
needs the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import text as T

#: Times are microseconds.
_TOKEN = "start long, pos long, spacing boolean, stop long, speaker string, piece string"
_OPEN = "inside boolean, lead string, spoke string, ended long, start long, stop long, speaker string, n long, pieces array<string>"
_OUT = "source string, start long, stop long, speaker string, n long, pieces array<string>"
_FIELDS = ("start", "pos", "spacing", "stop", "speaker", "piece")


class _Walk:
    """The open phrase of a source, and those that its tokens closed."""

    def __init__(self, gap: int, state: tuple | None):
        self.gap, self.done = gap, []
        self.inside, self.lead, self.spoke, self.ended, *self.now = state or (False, None, None, None, None, None, None, 0, [])

    def state(self) -> tuple:
        return self.inside, self.lead, self.spoke, self.ended, *self.now

    def close(self) -> None:
        if self.now[4]:
            self.done.append(tuple(self.now))
        self.now = [None, None, None, 0, []]

    def end(self) -> None:
        """A silence: the next token begins anew, whoever speaks."""
        self.close()
        self.inside, self.lead, self.spoke = False, None, None

    def take(self, start, _, spacing, stop, speaker, piece) -> None:
        if spacing:
            if stop is not None and stop - start >= self.gap:
                self.end()
            return
        if self.ended is not None and start - self.ended >= self.gap:
            self.end()
        if not self.inside:
            self.inside, self.lead = True, speaker
        elif self.lead is not None and None not in (speaker, self.spoke) and speaker != self.spoke:
            self.close()
        first = self.now[3] == 0
        self.ended = start if stop is None else stop
        self.now = [start if first else self.now[0], self.ended, speaker if first else self.now[2], self.now[3] + 1, [*self.now[4], *([piece] if piece is not None else [])]]
        self.spoke = speaker if speaker is not None else self.spoke


class _Phrases(StatefulProcessor):
    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _TOKEN)
        self.open = handle.getValueState("open", _OPEN)
        self.next = handle.getValueState("next", "at long")

    def _wake(self, at: int | None) -> None:
        """One timer for each source: when its earliest token, or the end of its phrase, is passed."""
        if self.next.exists():
            (before,) = self.next.get()
            if at is not None and before <= at:
                return
            self.handle.deleteTimer(before)
        if at is None:
            self.next.clear()
        else:
            self.next.update((at,))
            self.handle.registerTimer(at)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        earliest = None
        for frame in rows:
            plain = frame[list(_FIELDS)].astype(object).where(frame[list(_FIELDS)].notna(), None)
            tokens = [(int(a), int(b), bool(c), None if d is None else int(d), e, f) for a, b, c, d, e, f in plain.itertuples(index=False)]
            self.waiting.appendList(tokens)
            low = min(t[0] for t in tokens)
            earliest = low if earliest is None else min(earliest, low)
        if earliest is not None:
            self._wake(-(-earliest // 1000))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self.next.clear()
        tokens = sorted((tuple(t) for t in self.waiting.get()), key=lambda t: t[:2]) if self.waiting.exists() else []
        rest = [t for t in tokens if t[0] > passed]
        walk = _Walk(self.gap, tuple(self.open.get()) if self.open.exists() else None)
        for token in tokens[: len(tokens) - len(rest)]:
            walk.take(*token)
        if walk.inside and walk.ended + self.gap <= passed:
            walk.end()  # whatever comes starts later than that
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        if walk.inside:
            self.open.update(walk.state())
        else:
            self.open.clear()
        ends = [-(-t // 1000) for t in [*(t[0] for t in rest[:1]), *([walk.ended + self.gap] if walk.inside else [])]]
        self._wake(min(ends, default=None))
        yield pd.DataFrame([(key[0], *x) for x in walk.done], columns=["source", "start", "stop", "speaker", "n", "pieces"]) if walk.done else pd.DataFrame()

    def close(self) -> None:
        pass


def stream_phrases(tokens: DataFrame, gap_seconds: float, late: str) -> DataFrame:
    """source, start, stop, speaker, n and text of the phrases of a stream; see operators.sessions.phrases for the rules.

    ``tokens``: source, pos, type, text, start and stop (timestamps), speaker.
    They may come in any order within ``late``; tokens of a source are taken by
    start, then pos.  A phrase is sent once: when the watermark has passed a
    token that begins the next one, or its own end by the gap.  State holds the
    tokens that the watermark has not passed and one open phrase for each
    source.  A token without a start is skipped; one that comes too late is
    dropped.
    """
    spacing = F.coalesce("type", F.lit("word")) == "spacing"
    micros = lambda c: F.unix_micros(c).alias(c)
    rows = tokens.where("start is not null").withWatermark("start", late)
    rows = rows.select(F.col("source").cast("string").alias("source"), F.col("start").alias("at"), micros("start"), F.col("pos").cast("long").alias("pos"), spacing.alias("spacing"), micros("stop"), F.col("speaker").cast("string").alias("speaker"), T.piece(F.col("type"), F.col("text")).alias("piece"))
    found = rows.groupBy("source").transformWithStateInPandas(statefulProcessor=_Phrases(round(gap_seconds * 1_000_000)), outputStructType=_OUT, outputMode="Append", timeMode="EventTime")
    said = T.attach_punctuation(F.array_join("pieces", " "))
    return found.select("source", F.timestamp_micros("start").alias("start"), F.timestamp_micros("stop").alias("stop"), "speaker", "n", said.alias("text"))
