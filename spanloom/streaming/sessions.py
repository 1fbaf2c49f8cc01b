"""Sessions of a token stream.

``gap_sessions`` is built from a session window; ``speaker_sessions`` adds the
rule on speakers, which no window has, with state for each source.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def gap_sessions(events: DataFrame, key: str, time: str, gap_seconds: int, late: str | None = None) -> DataFrame:
    """``key``, start, stop and n of runs of events less than ``gap_seconds`` apart.

    A session window merges events exactly its gap apart, where a phrase is
    split, so the window is a microsecond shorter.  ``time`` is a timestamp
    with a zone.  ``late``: the watermark of a stream.
    """
    rows = events.withWatermark(time, late) if late else events
    window = F.session_window(time, f"{gap_seconds - 1} seconds 999999 microseconds")
    return rows.groupBy(window, key).agg(F.min(time).alias("start"), F.max(time).alias("stop"), F.count("*").alias("n")).select(key, "start", "stop", "n")


SESSION = "source string, start timestamp, stop timestamp, speaker string, n long"
_STATE = "start timestamp, stop timestamp, speaker string, n long"


def speaker_sessions(tokens: DataFrame, gap_seconds: float, late: str) -> DataFrame:
    """Sessions of ``tokens`` (source string, at timestamp, speaker string), split at gaps and changes of speaker.

    The speaker of a session is that of its first token; without one it is not
    split by speaker.  A session is sent when a later one begins, or when the
    watermark passes its end by the gap.  Tokens of a source within one
    micro-batch are ordered by time; across batches they should come in order: one
    that is older than the open session joins it and widens it.
    """
    gap = pd.Timedelta(seconds=gap_seconds)

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = list(state.get) if state.exists else None
        done = []
        if state.hasTimedOut:
            done.append(now)
            state.remove()
        else:
            rows = pd.concat(list(frames)).sort_values("at", kind="stable")
            for at, speaker in zip(rows["at"], rows["speaker"], strict=True):
                speaker = None if pd.isna(speaker) else speaker
                if now and (at - now[1] >= gap or (now[2] is not None and speaker is not None and speaker != now[2])):
                    done.append(now)
                    now = None
                now = [min(now[0], at), max(now[1], at), now[2], now[3] + 1] if now else [at, at, speaker, 1]
            state.update(tuple(now))
            state.setTimeoutTimestamp(max(int((now[1] + gap).timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame([(key[0], *x) for x in done], columns=["source", "start", "stop", "speaker", "n"])

    rows = tokens.select(F.col("source").cast("string").alias("source"), "at", "speaker").withWatermark("at", late)
    return rows.groupBy("source").applyInPandasWithState(run, SESSION, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
