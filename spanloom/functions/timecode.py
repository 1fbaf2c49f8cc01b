"""Times and durations as text.

``format_number`` with a pattern rounds the exact binary value half to even,
as C's printf does; ``format_string`` does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(number: Column, digits: int, whole: int = 1) -> Column:
    """``digits`` decimals, and at least ``whole`` digits before them."""
    return F.call_function("format_number", number.cast("double"), F.lit("0" * whole + "." + "0" * digits))


def clock(seconds: Column) -> Column:
    """Six places: ``002.52``."""
    return fixed(seconds, 2, 3)


def duration(seconds: Column) -> Column:
    """``43.0s``, or ``1m 27.4s``; 59.97 is ``60.0s``."""
    minutes = F.floor(seconds / 60)
    rest = fixed(seconds - minutes * 60, 1, 2)
    return F.when(seconds < 60, F.concat(fixed(seconds, 1), F.lit("s"))).otherwise(F.concat(minutes.cast("string"), F.lit("m "), rest, F.lit("s")))


def subtitle_clock(milliseconds: Column) -> Column:
    """``HH:MM:SS,mmm`` of whole milliseconds; hours may have more digits."""
    ms = milliseconds.cast("long")
    part = lambda unit, of: F.floor(ms / unit) % of
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000), part(60_000, 60), part(1000, 60), ms % 1000)


def to_milliseconds(seconds: Column) -> Column:
    """Rounded half to even."""
    return F.rint(seconds * 1000).cast("long")
