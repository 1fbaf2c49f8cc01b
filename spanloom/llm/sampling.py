"""Bounded, repeatable samples of labelled rows, and bitmaps of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: str | Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")), F.lit(modulus))


def first_by_hash(ids: DataFrame, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows, those whose keys hash lowest (top-k, no full sort)."""
    return ids.orderBy(F.xxhash64(key), key).limit(rows)


def one_text(rows: DataFrame, *by: str) -> DataFrame:
    """One row for each ``by``: of several texts the one that hashes lowest.  Combined before the shuffle."""
    return rows.groupBy(*by).agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def maybe_in(rows: DataFrame, ids: DataFrame, key: str, bits: int = 23) -> DataFrame:
    """``rows`` with a boolean ``maybe``: whether ``key`` may be in ``ids`` (never false if it is).

    A bitmap of ``2**bits`` bits, so at most ``2**(bits-6)`` rows of 64 bits (2
    MB), whatever the number of ids: it may be broadcast.  It spares most rows
    that an exact join afterwards would not find.  A null key is in no ``ids``.
    """
    spot = F.pmod(F.xxhash64(key), F.lit(1 << bits))
    word, bit = F.shiftright(spot, 6), F.pmod(spot, F.lit(64)).cast("int")
    held = ids.where(F.col(key).isNotNull()).select(word.alias("word"), bit.alias("bit"))
    bitmap = held.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    whole = rows.select(F.struct("*").alias("row"), F.col(key).isNotNull().alias("known"), word.alias("word"), bit.alias("bit"))
    found = F.coalesce(F.col("known") & F.expr("shiftrightunsigned(mask, bit) & 1L = 1L"), F.lit(False))
    return whole.join(F.broadcast(bitmap), "word", "left").select("row.*", found.alias("maybe"))
