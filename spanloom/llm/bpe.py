"""Byte-level BPE encoding and decoding with the ``tokenizers`` library.

The vocabulary is a rank file (``base64(token) rank`` on each line).  Bytes are
written as the printable characters of byte-level BPE, the merges are those
pairs of tokens whose concatenation is a token, in the order of its rank, and
a text is cut by the pre-tokenising pattern before any merge.

Pieces repeat, so each worker keeps the ids of the pieces it has met in two
dictionaries of bounded size: when one is full it becomes the older one, whose
pieces move on when they are met again.  A piece in neither goes through the
model of ``tokenizers``.  Decoding writes the printable characters of the tokens one
after another and maps each back to its byte, so a character whose bytes lie in
several tokens comes back whole.  Offsets are in characters of the text: a token
that holds only some bytes of a character covers that character.

Defined cases: a null text is encoded as an empty one, and null ids are decoded
as none; empty texts give no ids; texts of any length are encoded whole, one at
a time, in slices of rows of bounded size; repeated rows give equal results;
an empty table gives no rows; an incomplete character becomes U+FFFD only in
``decode_text``.  Columns that this module adds replace those of the same name.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import slices


def byte_characters() -> list[str]:
    """The printable character of each byte; fixed by the format.

    Bytes that print as themselves keep their code; the rest take U+0100 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class ByteBPE:
    """Encoder and decoder for one rank file and pattern."""

    #: Bounds of a dictionary of pieces: how many (beyond those of one text), and how long a piece.
    kept, kept_length = 80_000, 64

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as f:
            ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, f) if a}
        self.characters = byte_characters()
        #: The byte of each printable character.
        self.bytes = np.zeros(0x200, np.uint8)
        self.bytes[list(map(ord, self.characters))] = np.arange(256)
        #: Each token in printable characters, and its number of bytes.
        self.shown = [self._printable(ranks.get(i, b"")) for i in range(max(ranks) + 1)]
        self.lengths = np.array(list(map(len, self.shown)), np.int32)
        self.split = regex.compile(pattern).findall
        self.ids: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _printable(self, raw: bytes) -> str:
        return raw.decode("latin-1").translate(self.characters)

    @cached_property
    def model(self):
        """The merging model; a worker that only decodes never builds it."""
        from tokenizers import models

        vocab = {token: rank for rank, token in enumerate(self.shown) if token}
        merges = sorted((rank, -cut, token[:cut], token[cut:]) for token, rank in vocab.items() for cut in range(1, len(token)) if token[:cut] in vocab and token[cut:] in vocab)
        return models.BPE(vocab=vocab, merges=[(a, b) for _, _, a, b in merges], ignore_merges=True, cache_capacity=0)

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        merge = self.model.tokenize
        return {piece: array("I", [t.id for t in merge(self._printable(piece.encode("utf-8", "surrogatepass")))]).tobytes() for piece in new}

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        found = self.split(text)
        ids = self.ids
        try:
            return b"".join(map(ids.__getitem__, found))
        except KeyError:
            pass
        new = [piece for piece in dict.fromkeys(found) if piece not in ids]
        got = {piece: self.before[piece] for piece in new if piece in self.before}
        got |= self._learn([piece for piece in new if piece not in got])
        out = b"".join([got[piece] if piece in got else ids[piece] for piece in found])
        ids.update((piece, x) for piece, x in got.items() if len(piece) <= self.kept_length)
        if len(ids) > self.kept:
            self.before, self.ids = ids, {}
        return out

    def offsets(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one character of each token, by the byte-to-character map."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        ends = np.cumsum(self.lengths[ids])
        if not len(ends):
            return ends, ends
        character = np.cumsum((raw & 0xC0) != 0x80, dtype=np.int32) - 1
        return character[ends - self.lengths[ids]], character[ends - 1] + 1

    def decode(self, ids: bytes) -> bytes:
        """The bytes of ids written as by :meth:`encode`: printable characters through the inverse byte table."""
        shown = "".join(map(self.shown.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return self.bytes[np.frombuffer(shown.encode("utf-16-le"), "<u2")].tobytes()

    def decoded_parts(self, ids: bytes, size: int = 1 << 20) -> Iterator[bytes]:
        """As :meth:`decode`, in parts of bounded size; the bytes of a character may lie in two."""
        return (self.decode(ids[at : at + size]) for at in range(0, len(ids), size))

    def decode_text(self, ids: bytes) -> str:
        return self.decode(ids).decode("utf-8", "replace")


@lru_cache(maxsize=1)
def _loaded(path: str, pattern: str) -> ByteBPE:
    return ByteBPE(path, pattern)


#: Arrow and Spark types of the columns that can be added.
_KINDS = {
    "ids": (pa.list_(pa.int32()), "array<int>"),
    "starts": (pa.list_(pa.int32()), "array<int>"),
    "ends": (pa.list_(pa.int32()), "array<int>"),
    "decoded": (pa.binary(), "binary"),
    "n_tokens": (pa.int64(), "long"),
    "n_split": (pa.int64(), "long"),
    "ids_sha256": (pa.string(), "string"),
    "decoded_sha256": (pa.string(), "string"),
    "intact": (pa.bool_(), "boolean"),
}


def _mapped(rows: DataFrame, names: list[str], read: str, added: tuple[str, ...], path: str, pattern: str, one) -> DataFrame:
    """``names`` of ``rows`` with the columns ``added``: what ``one(bpe, value)`` gives for each value of ``read``."""
    names = [c for c in names if c not in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(path, pattern)
        for batch in batches:
            for part in slices(batch, read):
                made = list(zip(*(one(bpe, x) for x in part[read]), strict=True))
                yield pa.RecordBatch.from_arrays([*[part[c] for c in names], *[pa.array(x, _KINDS[c][0]) for c, x in zip(added, made, strict=True)]], [*names, *added])

    schema = rows.select(*names).withColumns({c: F.lit(None).cast(_KINDS[c][1]) for c in added}).schema
    return rows.select(*dict.fromkeys([*names, read])).mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", offsets: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int) and, if asked, ``starts`` and ``ends``."""

    def one(bpe: ByteBPE, x: pa.Scalar) -> tuple:
        t = x.as_py() or ""
        ids = np.frombuffer(bpe.encode(t), "<i4")
        return (ids, *bpe.offsets(t, ids)) if offsets else (ids,)

    return _mapped(docs, docs.columns, text, ("ids", "starts", "ends") if offsets else ("ids",), path, pattern, one)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of the tokens in ``ids`` (null: none)."""

    def one(bpe: ByteBPE, x: pa.Scalar) -> tuple:
        return (bpe.decode(np.asarray(x.values, "<u4").tobytes()) if x.is_valid else b"",)

    return _mapped(encoded, encoded.columns, ids, ("decoded",), path, pattern, one)


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode, then decode, in one pass: n_tokens, ids, and whether the decoded bytes are those of the text (``intact``)."""

    def one(bpe: ByteBPE, x: pa.Scalar) -> tuple:
        t = x.as_py() or ""
        ids, raw, at, same = bpe.encode(t), memoryview(t.encode("utf-8", "surrogatepass")), 0, True
        for part in bpe.decoded_parts(ids):
            same &= raw[at : at + len(part)] == part
            at += len(part)
        return len(ids) // 4, np.frombuffer(ids, "<i4"), same and at == len(raw)

    return _mapped(docs, list(keep), text, ("n_tokens", "ids", "intact"), path, pattern, one)


def round_trip_digests(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Encode, then decode, in one pass: n_tokens, the digests of ids and decoded bytes, and n_split.

    ``n_split`` is the number of tokens that begin or end inside a character:
    those whose first character is also the last one of the token before, and
    the tokens before those.  The ids of a text never leave its worker, so
    nothing but digests is moved.
    """

    def one(bpe: ByteBPE, x: pa.Scalar) -> tuple:
        t = x.as_py() or ""
        ids, back = bpe.encode(t), hashlib.sha256()
        for part in bpe.decoded_parts(ids):
            back.update(part)
        split = 0
        if not t.isascii():
            starts, ends = bpe.offsets(t, np.frombuffer(ids, "<i4"))
            shared = np.concatenate(([False], starts[1:] < ends[:-1], [False]))
            split = int((shared[1:] | shared[:-1]).sum())
        return len(ids) // 4, hashlib.sha256(ids).hexdigest(), back.hexdigest(), split

    return _mapped(docs, list(keep), text, ("n_tokens", "ids_sha256", "decoded_sha256", "n_split"), path, pattern, one)
