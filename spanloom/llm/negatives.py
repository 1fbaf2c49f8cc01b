"""Hard negatives by a two-dimensional block matrix multiply.

Anchors and rows are sorted by label and cut into blocks; a block's ids, labels
and components are packed into panels.  Neighbouring blocks make a band.  Each
band of anchors meets each band of rows in one cell, which is one group of a
cogrouped exchange, so only panels are moved.  A cell multiplies block by block
and chunk of dimensions by chunk, adds the partial tiles where they are made and
reduces each full tile at once to the best of each anchor, so no tile and no pair
of rows leaves its cell.  What an anchor has found so far in a cell is the least
that later tiles must surpass.

Two rounds share the work: cells that may have a label in common give the
positives, then those that may differ in label give the negatives, whose windows
the positives set; positives of one score share a window.  A cell with one and
the same label on both sides is met once only.

Components become whole numbers, so scores are exact: a tile is a product of
floats of 32 or 64 bits while the norms show that all sums stay below 2^24 or
2^53, else of 64-bit integers.  Panels hold the narrowest kind of integer.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component take no part, nor do those with a component beyond 2^17 (their scores
could leave 64 bits); a shorter vector counts as filled up with zeros; of rows
that share an id one takes part, that of the least label and then the least
vector; an anchor without positives gives no rows; an empty table gives none;
other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import stored


#: Bytes of components, at 4 each, of a band of rows or a panel.
ROOM = 1 << 26


@dataclass(frozen=True)
class NegativesConfig:
    positives: int = 5
    negatives: int = 10
    #: The window of a negative's score, as percent of the positive's.
    low: int = 30
    high: int = 90
    #: Components are multiplied by this and rounded down.
    scale: int = 256
    #: Rows of a block of anchors and of rows, and dimensions of a chunk.
    anchor_block: int = 256
    row_block: int = 2048
    chunk: int = 32
    #: Blocks of a band of anchors and of rows; fewer rows where vectors are long.
    anchor_band: int = 8
    row_band: int = 16


def whole_vectors(rows: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and values (whole numbers) of the rows of ``rows`` (vec_id, label, embedding) that take part, one for each vec_id."""
    bound = F.lit(float(1 << 17))
    fine = F.forall("embedding", lambda x: F.coalesce((x >= -bound) & (x <= bound), F.lit(False)))
    found = rows.where("vec_id is not null and label is not null and embedding is not null").where(fine)
    values = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("int"))
    own = found.select(F.col("vec_id").cast("long").alias("vec_id"), F.struct(F.col("label").cast("long").alias("label"), values.alias("values")).alias("row"))
    return own.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.values")


def _blocks(rows: DataFrame, n: int, size: int) -> DataFrame:
    """``rows`` sorted by label and cut into blocks of about ``size``, numbered in a column ``block``."""
    return stored(rows.repartitionByRange(max(1, -(-n // size)), "label", "vec_id").withColumn("block", F.spark_partition_id()), "negatives-blocks")


def _panels(blocks: DataFrame, dims: int, size: int) -> DataFrame:
    """block, part, low, high (labels), ids, labels, kind and data of each panel; a block that came out large has several parts."""
    most = max(1, min(2 * size, ROOM // (4 * dims)))

    def run(table: pa.Table) -> pa.Table:
        block = table["block"][0].as_py()
        table = table.sort_by([("label", "ascending"), ("vec_id", "ascending")])
        ids, labels = (table[c].to_numpy().astype(np.int64) for c in ("vec_id", "label"))
        values = table["values"].combine_chunks()
        length = np.diff(values.offsets.to_numpy())
        ends = np.cumsum(length)
        flat = values.values.to_numpy()[values.offsets[0].as_py() : values.offsets[-1].as_py()]
        out = []
        for part, at in enumerate(range(0, len(ids), most)):
            rows = slice(at, at + most)
            long, first = length[rows], ends[at] - length[at]
            own = flat[first : ends[rows][-1]]
            matrix = np.zeros((len(long), dims), np.int32)
            matrix[np.repeat(np.arange(len(long)), long), np.arange(len(own)) - np.repeat(np.cumsum(long) - long, long)] = own
            out.append((block, part, int(labels[rows][0]), int(labels[rows][-1]), ids[rows].tobytes(), labels[rows].tobytes(), *_narrow(matrix)))
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.binary())
        return pa.table({name: pa.array([r[k] for r in out], kind) for k, (name, kind) in enumerate(zip(("block", "part", "low", "high", "ids", "labels", "kind", "data"), kinds, strict=True))})

    return blocks.groupBy("block").applyInArrow(run, "block int, part int, low long, high long, ids binary, labels binary, kind string, data binary")


def _narrow(values: np.ndarray) -> tuple[str, bytes]:
    """The values in the narrowest kind of integer that holds them."""
    for kind in ("<i1", "<i2", "<i4"):
        limit = np.iinfo(kind)
        if values.min(initial=0) >= limit.min and values.max(initial=0) <= limit.max:
            return kind, values.astype(kind).tobytes()
    return "<i8", values.astype("<i8").tobytes()


def _gathered(panels: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels and components of all panels."""
    ids, labels = (np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in panels[c]]) for c in ("ids", "labels"))
    data = [np.frombuffer(x.as_buffer(), kind).reshape(-1, dims) for kind, x in zip(panels["kind"].to_pylist(), panels["data"], strict=True)]
    return ids, labels, np.concatenate(data)


def _kind(a: np.ndarray, b: np.ndarray) -> type:
    """The quickest type in which every sum on the way to a score is exact: none is above the product of the norms."""
    most = np.sqrt(np.prod([np.einsum("ij,ij->i", x, x).max(initial=0) for x in (a.astype(np.float64), b.astype(np.float64))]))
    return np.float32 if most < 0.99 * 2**24 else np.float64 if most < 0.99 * 2**53 else np.int64


def _tile(a: np.ndarray, b: np.ndarray, chunk: int) -> np.ndarray:
    """The scores of two blocks: the partial tiles of all chunks of dimensions, added."""
    tile = a[:, :chunk] @ b[:, :chunk].T
    for d in range(chunk, a.shape[1], chunk):
        tile += a[:, d : d + chunk] @ b[:, d : d + chunk].T
    return tile


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    kind = _kind(a, b)
    return _tile(a.astype(kind), b.astype(kind), a.shape[1]).astype(np.int64)


def _least(kind: type) -> float:
    """Below every score."""
    return -np.inf if np.issubdtype(kind, np.floating) else np.iinfo(kind).min


class _Best:
    """The ``most`` highest scores in each row of tiles, above ``over`` and up to ``high``.

    The columns of all tiles come by rising id, so of equal scores those that
    came first stay, and a later one has to be higher than the last that stays.
    """

    def __init__(self, most: int, over: np.ndarray, high: np.ndarray):
        self.most, self.over, self.high = most, over.copy(), high
        self.rows, self.ids, self.scores = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, over.dtype)

    def add(self, tile: np.ndarray, ids: np.ndarray) -> None:
        inside = (tile > self.over[:, None]) & (tile <= self.high[:, None])
        at = np.flatnonzero(inside)
        if len(at) > 4 * self.most * len(tile) and tile.shape[1] > self.most:
            at = self._cut(tile, inside)
        if len(at):
            rows, columns = np.divmod(at, tile.shape[1])
            self.rows, self.ids = np.concatenate((self.rows, rows)), np.concatenate((self.ids, ids[columns]))
            self.scores = np.concatenate((self.scores, tile.ravel()[at]))
        if len(self.rows) > 8 * self.most * len(tile):
            self._settle()

    def _cut(self, tile: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Where a tile's own best are; a row with fewer keeps all."""
        held = np.where(inside, tile, _least(tile.dtype)).astype(tile.dtype, copy=False)
        last = np.partition(held, -self.most, axis=1)[:, -self.most]
        equal = np.flatnonzero((held == last[:, None]) & inside)
        row = equal // tile.shape[1]
        equal = equal[np.arange(len(row)) - np.searchsorted(row, row) < self.most]
        self.over = np.maximum(self.over, last)
        return np.concatenate((np.flatnonzero(held > last[:, None]), equal))

    def _settle(self) -> None:
        order = np.lexsort((self.ids, -self.scores, self.rows))
        rows = self.rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        last = order[rank == self.most - 1]
        self.over[self.rows[last]] = np.maximum(self.over[self.rows[last]], self.scores[last])
        order = order[rank < self.most]
        self.rows, self.ids, self.scores = self.rows[order], self.ids[order], self.scores[order]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, id and score of each that stays."""
        self._settle()
        return self.rows, self.ids, self.scores.astype(np.int64)


def _runs(labels: np.ndarray) -> list[tuple[int, int, int]]:
    """Each label of sorted ones, with its first place and the one after its last."""
    found, first = np.unique(labels, return_index=True)
    return list(zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(labels)], strict=True))


def _steps(first: int, last: int, size: int) -> list[slice]:
    return [slice(at, min(last, at + size)) for at in range(first, last, size)]


def _sorted_by(keys: tuple[np.ndarray, ...], *columns: np.ndarray) -> list[np.ndarray]:
    order = np.lexsort(keys)
    return [c[order] for c in columns]


def _best_positives(config: NegativesConfig, dims: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if len(anchors) and len(rows):
            (a_ids, a_labels, a), (ids, labels, b) = _gathered(anchors, dims), _gathered(rows, dims)
            kind = _kind(a, b)
            a_ids, a_labels, a = _sorted_by((a_ids, a_labels), a_ids, a_labels, a.astype(kind))
            ids, labels, b = _sorted_by((ids, labels), ids, labels, b.astype(kind))
            none = _least(kind)
            for label, first, last in _runs(a_labels):
                from_, upto = np.searchsorted(labels, label), np.searchsorted(labels, label, "right")
                for block in _steps(first, last, config.anchor_block) if from_ < upto else ():
                    own = a_ids[block]
                    best = _Best(config.positives, np.full(len(own), none, kind), np.full(len(own), np.inf if none == -np.inf else np.iinfo(kind).max, kind))
                    for part in _steps(from_, upto, config.row_block):
                        tile = _tile(a[block], b[part], config.chunk)
                        at = np.minimum(np.searchsorted(ids[part], own), len(ids[part]) - 1)
                        same = np.flatnonzero(ids[part][at] == own)
                        tile[same, at[same]] = none
                        best.add(tile, ids[part])
                    k, found, scores = best.found()
                    out.append((own[k], found, scores))
        return _table(out, ("anchor_id", "positive_id", "positive_score"))

    return run


WINDOW = np.dtype([("anchor_id", "<i8"), ("positive_score", "<i8")])


def _windows(packed: list[bytes | None], ids: np.ndarray, kind: type, config: NegativesConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the anchors with these ids, by slot and anchor: the positive's score, the number that scores must be above, and the highest; empty if none."""
    wanted = np.sort(np.frombuffer(b"".join(x or b"" for x in packed), WINDOW), order=WINDOW.names)
    scores = wanted["positive_score"].tolist()
    slot = np.arange(len(wanted)) - np.searchsorted(wanted["anchor_id"], wanted["anchor_id"])
    by_id = np.argsort(ids)
    at = by_id[np.searchsorted(ids[by_id], wanted["anchor_id"])] if len(wanted) else slot
    n = int(slot.max(initial=-1)) + 1
    positive, over, high = np.zeros((n, len(ids)), np.int64), np.zeros((n, len(ids)), kind), np.full((n, len(ids)), _least(kind), kind)
    # whole numbers s with low * positive <= 100 s <= high * positive
    positive[slot, at] = scores
    over[slot, at] = np.array([-(-config.low * s // 100) - 1 for s in scores], kind)
    high[slot, at] = np.array([config.high * s // 100 for s in scores], kind)
    return positive, over, high


def _best_negatives(config: NegativesConfig, dims: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        out = []
        if len(anchors) and len(rows):
            (a_ids, a_labels, a), (ids, labels, b) = _gathered(anchors, dims), _gathered(rows, dims)
            kind = _kind(a, b)
            a_ids, a_labels, a = _sorted_by((a_ids, a_labels), a_ids, a_labels, a.astype(kind))
            ids, labels, b = _sorted_by((ids,), ids, labels, b.astype(kind))
            positive, over, high = _windows(anchors["windows"].to_pylist(), a_ids, kind, config)
            parts = []
            for part in _steps(0, len(ids), config.row_block):
                order = np.argsort(labels[part], kind="stable")
                parts.append((part, order, labels[part][order]))
            for block in _steps(0, len(a_ids), config.anchor_block):
                slots = np.flatnonzero((over[:, block] < high[:, block]).any(axis=1)).tolist()
                best = [_Best(config.negatives, over[s, block], high[s, block]) for s in slots]
                runs = _runs(a_labels[block])
                for part, order, own in parts if best else ():
                    if len(runs) == 1 and own[0] == own[-1] == runs[0][0]:
                        continue
                    tile = _tile(a[block], b[part], config.chunk)
                    for label, first, last in runs:
                        tile[first:last, order[np.searchsorted(own, label) : np.searchsorted(own, label, "right")]] = _least(kind)
                    for x in best:
                        x.add(tile, ids[part])
                for s, x in zip(slots, best, strict=True):
                    k, found, scores = x.found()
                    out.append((a_ids[block][k], positive[s, block][k], found, scores))
        return _table(out, ("anchor_id", "positive_score", "negative_id", "negative_score"))

    return run


def _table(parts: list[tuple[np.ndarray, ...]], names: tuple[str, ...]) -> pa.Table:
    return pa.table({name: np.concatenate([np.empty(0, np.int64), *(p[k] for p in parts)]) for k, name in enumerate(names)})


def _banded(panels: DataFrame, n: int) -> DataFrame:
    """``panels`` with a column ``band``, of ``n`` at most, each of neighbouring blocks."""
    last = panels.agg(F.max("block")).first()[0]
    return panels.withColumn("band", F.floor(F.col("block").cast("long") * n / ((last or 0) + 1)).cast("int"))


def _cells(anchors: DataFrame, rows: DataFrame, meet: Column, run: Callable[[pa.Table, pa.Table], pa.Table], schema: str, n: int) -> DataFrame:
    """``run`` of every cell: of the pairs of bands for which ``meet``, as ``n`` tasks."""
    bands = lambda panels, mark: panels.groupBy(f"{mark}band").agg(F.min(f"{mark}low").alias(f"{mark}low"), F.max(f"{mark}high").alias(f"{mark}high"))
    cells = F.broadcast(bands(anchors, "a_").crossJoin(bands(rows, "")).where(meet).select("a_band", "band"))
    # tasks by number, as a cell's work goes by its pairs and not by the bytes that it reads
    cell = (F.col("a_band") * F.lit(1 << 32) + F.col("band")).alias("cell")
    left, right = (side.join(cells, own).select("*", cell).drop("a_band", "band").repartition(n, "cell").groupBy("cell") for side, own in ((anchors, "a_band"), (rows, "band")))
    return left.cogroup(right).applyInArrow(run, schema)


def hard_negatives(rows: DataFrame, anchor: Column, config: NegativesConfig = NegativesConfig()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows``: vec_id, label, embedding; ``anchor``: which of them (a condition
    on vec_id) are anchors.  An anchor's positives are its nearest rows of the
    same label by inner product, ties to the smaller id; for each, the nearest
    rows of other labels whose scores lie in the window follow by rank.
    """
    whole = stored(whole_vectors(rows, config.scale), "negatives-rows")
    size = whole.agg(F.count("*"), F.count_if(anchor), F.coalesce(F.max(F.size("values")), F.lit(0))).first()
    n, n_anchors, dims = size[0], size[1], max(1, size[2])
    size = max(1, min(config.row_band, ROOM // (4 * dims * config.row_block))) * config.row_block
    n_bands, n_a_bands = max(1, -(-n // size)), max(1, -(-n_anchors // (config.anchor_band * config.anchor_block)))
    panels = stored(_panels(_blocks(whole, n, config.row_block), dims, config.row_block), "negatives-panels")
    own = stored(_panels(_blocks(whole.where(anchor), n_anchors, config.anchor_block), dims, config.anchor_block), "negatives-anchors")
    panels, own = _banded(panels, n_bands), _banded(own, n_a_bands)
    own = own.select("ids", "labels", "kind", "data", *[F.col(c).alias(f"a_{c}") for c in ("block", "part", "band", "low", "high")])

    alike = (F.col("low") <= F.col("a_high")) & (F.col("a_low") <= F.col("high"))
    near = _cells(own, panels, alike, _best_positives(config, dims), "anchor_id long, positive_id long, positive_score long", n_bands * n_a_bands)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = stored(near.withColumn("k", F.row_number().over(order)).where(F.col("k") <= config.positives).drop("k"), "negatives-positives")

    def pack(table: pa.Table) -> pa.Table:
        made = np.empty(len(table), WINDOW)
        for c in WINDOW.names:
            made[c] = table[c].to_numpy()
        return pa.table({"a_block": table["a_block"].slice(0, 1), "a_part": table["a_part"].slice(0, 1), "windows": pa.array([made.tobytes()], pa.binary())})

    holders = own.select("a_block", "a_part", "ids").mapInArrow(_anchors_of, "a_block int, a_part int, anchor_id long")
    scores = positives.select("anchor_id", "positive_score").distinct()
    windows = scores.join(holders, "anchor_id").groupBy("a_block", "a_part").applyInArrow(pack, "a_block int, a_part int, windows binary")
    windowed = own.join(windows, ["a_block", "a_part"])
    differ = ~((F.col("low") == F.col("high")) & (F.col("a_low") == F.col("a_high")) & (F.col("low") == F.col("a_low")))
    far = _cells(windowed, panels, differ, _best_negatives(config, dims), "anchor_id long, positive_score long, negative_id long, negative_score long", n_bands * n_a_bands)
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = far.withColumn("rank", rank).where(F.col("rank") <= config.negatives)
    return positives.join(ranked, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, part, ids in zip(*(batch[c].to_pylist() for c in ("a_block", "a_part", "ids")), strict=True):
            got = np.frombuffer(ids, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(got), pa.int32()), pa.array([part] * len(got), pa.int32()), pa.array(got)], ["a_block", "a_part", "anchor_id"])
