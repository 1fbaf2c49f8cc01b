"""Text of tokens, phrases and cues."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All Unicode white space, and the four separator controls that count as space too.
_SPACE = r"(?U)[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(F.regexp_replace(text, f"{_SPACE[:4]}^{_SPACE[4:]}+", ""), f"{_SPACE}+$", "")


def collapse(text: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(text, f"{_SPACE}+", " ")


def piece(kind: Column, text: Column) -> Column:
    """A token as it stands in a phrase: stripped, audio events in parentheses, null if blank."""
    bare = F.nullif(strip(F.coalesce(text, F.lit(""))), F.lit(""))
    return F.when((kind == "audio_event") & ~bare.startswith("("), F.concat(F.lit("("), bare, F.lit(")"))).otherwise(bare)


def attach_punctuation(text: Column) -> Column:
    """No space before a comma, full stop, question or exclamation mark."""
    for mark in ",.?!":
        text = F.replace(text, F.lit(f" {mark}"), F.lit(mark))
    return text


def caption(text: Column) -> Column:
    """Upper case on one line, without a trailing comma, semicolon or colon."""
    return F.upper(F.rtrim(strip(collapse(text)), F.lit(",;:")))


def ends_in_break(text: Column) -> Column:
    return F.substring(text, -1, 1).isin(*".,!?;:")


def speaker_tag(speaker: Column) -> Column:
    """`` S0`` for ``speaker_0``; empty for none."""
    return F.coalesce(F.concat(F.lit(" S"), F.regexp_replace(speaker, "^speaker_", "")), F.lit(""))


def escape_path(path: Column) -> Column:
    """Colons and quotes escaped as filter arguments need it."""
    return F.replace(F.replace(path, F.lit(":"), F.lit("\\:")), F.lit("'"), F.lit("\\'"))


def resolve_path(path: Column, base: Column) -> Column:
    """Absolute paths as they are, others below ``base``, with ``.`` and ``..`` taken out of those."""
    steps = F.filter(F.split(F.concat(base, F.lit("/"), path), "/"), lambda x: ~x.isin("", "."))
    none = F.array().cast("array<string>")
    up = lambda kept: F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
    plain = F.aggregate(steps, none, lambda kept, x: F.when(x == "..", up(kept)).otherwise(F.concat(kept, F.array(x))))
    below = F.concat(F.when(base.startswith("/"), F.lit("/")).otherwise(F.lit("")), F.array_join(plain, "/"))
    return F.when(path.startswith("/"), path).otherwise(below)


def shorten(text: Column, characters: int) -> Column:
    """The first ``characters``, with three dots where more followed."""
    return F.when(F.length(text) > characters, F.concat(F.substring(text, 1, characters), F.lit("..."))).otherwise(text)


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def embedded_object(text: Column) -> Column:
    """From the last opening to the last closing brace; null if there is none."""
    opens = F.length(text) - F.instr(F.reverse(text), "{")
    closes = F.length(text) - F.instr(F.reverse(text), "}")
    whole = text.contains("{") & text.contains("}") & (closes > opens)
    return F.when(whole, F.substring(text, opens + 1, closes - opens + 1))
