"""Hard negatives by tiled integer products: Strassen multiplication, then mergeable heaps.

Vectors become integers and are packed into tiles of rows. Anchors, a stated query set, are dealt
into tiles of their own, and every anchor tile meets every tile of rows: each row tile belongs
to one lane, the anchor tiles are copied to all lanes, and the two join by lane. No row of
the table is copied. A pair of tiles is multiplied by Strassen's recursion on 64-bit integers
with zero padding; sums wrap modulo 2^64 on the way and come out exact, as the scores fit.

Two rounds of products follow each other, for the positives must be known before windows can be
cut. Each keeps, per anchor (and positive), a heap of its best few (score, id); heaps of the
same anchor tile are merged in the task while it lasts, and across tasks by rank. The size of
a heap does not depend on the data, so no group grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.common import map_arrow, stored

TILE = 1024
TILE_BYTES = 8 << 20
# Below this size of a dimension tiles are multiplied directly.
LEAF = 48
POSITIVES, NEGATIVES = 5, 10
# A negative scores between these percentages of its positive.
LOW, HIGH = 30, 90
SCALE = 256
TILE_LAYOUT = "tile long, n int, ids binary, labels binary, width int, vectors binary"
WORST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` of 64-bit integers by seven products of halves, padded with zeros to even
    sizes; exact modulo 2^64 at every step."""
    m, k = a.shape
    n = b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    h, i, j = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    if (m | k | n) & 1:
        a = np.pad(a, ((0, 2 * h - m), (0, 2 * i - k)))
        b = np.pad(b, ((0, 2 * i - k), (0, 2 * j - n)))
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), np.int64)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def _narrow(values: np.ndarray) -> bytes:
    """The values in the narrowest of 2, 4 and 8 bytes that holds them all."""
    for kind in (np.int16, np.int32):
        info = np.iinfo(kind)
        if not len(values) or info.min <= values.min() and values.max() <= info.max:
            return values.astype(kind).tobytes()
    return values.tobytes()


def _wide(data: bytes, n: int, width: int) -> np.ndarray:
    kind = f"<i{len(data) // (n * width)}" if n * width else "<i8"
    return np.frombuffer(data, kind).astype(np.int64).reshape(n, width)


def _tile(ids: np.ndarray, labels: np.ndarray, vectors: list[np.ndarray]) -> list:
    """The columns of one tile but its number: rows by id, rows that repeat in full once,
    vectors padded with zeros to the longest."""
    width = max((len(v) for v in vectors), default=0)
    matrix = np.zeros((len(ids), width), np.int64)
    for row, vector in zip(matrix, vectors):
        row[: len(vector)] = vector
    order = np.argsort(ids, kind="stable")
    ids, labels, matrix = ids[order], labels[order], matrix[order]
    if len(np.unique(ids)) < len(ids):
        whole = np.column_stack([ids, labels, matrix])
        first = np.sort(np.unique(whole, axis=0, return_index=True)[1])
        ids, labels, matrix = ids[first], labels[first], matrix[first]
    return [len(ids), ids.tobytes(), labels.tobytes(), width, _narrow(matrix.ravel())]


def _lists(column: pa.Array) -> list[np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    return np.split(flat, np.cumsum(sizes)[:-1]) if len(sizes) else []


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows as they come, in tiles bounded by rows and bytes."""
    schema = pa.schema(
        [("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
         ("width", pa.int32()), ("vectors", pa.binary())]
    )
    ids, labels, vectors, size = [], [], [], 0

    def flushed() -> pa.RecordBatch:
        values = _tile(np.array(ids, np.int64), np.array(labels, np.int64), vectors)
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], schema=schema)

    for batch in batches:
        for i, label, vector in zip(
            batch.column(0).to_pylist(), batch.column(1).to_pylist(), _lists(batch.column(2))
        ):
            if ids and (len(ids) >= TILE or size + 8 * len(vector) > TILE_BYTES):
                yield flushed()
                ids, labels, vectors, size = [], [], [], 0
            ids.append(i)
            labels.append(label)
            vectors.append(vector)
            size += 8 * len(vector)
    if ids:
        yield flushed()


def _pack_group(key: tuple, rows: pa.Table) -> pa.Table:
    values = _tile(rows["id"].to_numpy(), rows["label"].to_numpy(), _lists(rows["vector"]))
    names = ["tile", "n", "ids", "labels", "width", "vectors"]
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
    columns = [pa.array([v], t) for v, t in zip([key[0].as_py(), *values], kinds)]
    return pa.Table.from_arrays(columns, names=names)


def _scores(left: dict, right: dict) -> np.ndarray:
    """All products of the rows of two tiles."""
    a, b = (_wide(t["vectors"], t["n"], t["width"]) for t in (left, right))
    width = max(a.shape[1], b.shape[1])
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    most = [max(int(x.max()), -int(x.min())) if x.size else 0 for x in (a, b)]
    if most[0] * most[1] * width >= 1 << 62:
        raise ValueError("scores of these vectors do not fit in 64 bits")
    return strassen(a, np.ascontiguousarray(b.T))


def _best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the columns of its k best allowed scores, best first, ties by column; and
    which of them exist."""
    n = scores.shape[1]
    k = min(k, n)
    if k == 0:
        return np.zeros((len(scores), 0), np.int64), np.zeros((len(scores), 0), bool)
    if n * int(np.abs(scores).max(initial=0)) < 1 << 61:
        # One number per cell that orders by score, then by column.
        keys = np.where(allowed, scores * n - np.arange(n), WORST)
        top = np.argpartition(-(keys + 1), k - 1, axis=1)[:, :k] if k < n else np.arange(n)[None].repeat(len(keys), 0)
        found = np.take_along_axis(keys, top, axis=1)
        top = np.take_along_axis(top, np.argsort(-(found + 1), axis=1), axis=1)
    else:
        order = np.argsort(np.where(allowed, -scores, np.iinfo(np.int64).max), axis=1, kind="stable")
        top = order[:, :k]
    return top, np.take_along_axis(allowed, top, axis=1)


class _Heaps:
    """The best k (score, id) of each slot, merged as tiles go by; equal pairs count once."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot = np.empty(0, np.int64)
        self.score = np.empty(0, np.int64)
        self.id = np.empty(0, np.int64)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (
            np.concatenate(pair)
            for pair in ((self.slot, slot), (self.score, score), (self.id, ids))
        )
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        new = np.ones(len(slot), bool)
        new[1:] = (slot[1:] != slot[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        slot, score, ids = slot[new], score[new], ids[new]
        first = np.searchsorted(slot, slot)
        keep = np.arange(len(slot)) - first < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]


def _products(kind: str, k: int, low: int, high: int):
    """For rows that hold an anchor tile and a tile of rows: the heaps of each anchor tile as
    ``tile``, ``slot``, ``anchor_id``, ``positive_id``, ``positive_score``, ``score``, ``id``."""
    names = ["tile", "slot", "anchor_id", "positive_id", "positive_score", "score", "id"]

    def anchors_of(row: dict) -> dict:
        return {"n": row["a_n"], "width": row["a_width"], "vectors": row["a_vectors"]}

    def windows_of(row: dict, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if kind == "positives":
            return np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        return tuple(np.frombuffer(row[c], np.int64) for c in ("w_row", "w_id", "w_score"))

    def emit(tile: int, head: tuple, heaps: _Heaps) -> pa.RecordBatch:
        anchor, _, positive, score = head
        at = heaps.slot
        columns = [np.full(len(at), tile), at, anchor[at], positive[at], score[at], heaps.score, heaps.id]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, head, heaps = None, None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids, labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels"))
                a_ids, a_labels = (np.frombuffer(row[c], np.int64) for c in ("a_ids", "a_labels"))
                at, positive, p_score = windows_of(row, row["a_n"])
                if tile != row["a_tile"]:
                    if tile is not None:
                        yield emit(tile, head, heaps)
                    tile = row["a_tile"]
                    heaps = _Heaps(len(at), k)
                    head = (a_ids[at], at, positive, p_score)
                scores = _scores(anchors_of(row), row)
                same = a_labels[:, None] == labels[None, :]
                if kind == "positives":
                    allowed = same & (a_ids[:, None] != ids[None, :])
                    steps = [(np.arange(len(at)), scores, allowed)]
                else:
                    steps = []
                    # One positive per anchor at a time, so that no array outgrows the tile pair.
                    turn = np.arange(len(at)) - np.searchsorted(at, at)
                    for t in range(int(turn.max(initial=-1)) + 1):
                        slots = np.flatnonzero(turn == t)
                        bound = p_score[slots].astype(object)
                        least = np.array([-(-low * int(p) // 100) for p in bound], np.int64)
                        most = np.array([high * int(p) // 100 for p in bound], np.int64)
                        part = scores[at[slots]]
                        inside = (part >= least[:, None]) & (part <= most[:, None])
                        steps.append((slots, part, inside & ~same[at[slots]]))
                for slots, part, allowed in steps:
                    top, real = _best(part, allowed, k)
                    slot = np.repeat(slots, real.sum(axis=1))
                    heaps.add(slot, np.take_along_axis(part, top, axis=1)[real], ids[top[real]])
        if tile is not None:
            yield emit(tile, head, heaps)

    return run


def _pack_windows(key: tuple, rows: pa.Table) -> pa.Table:
    """The positives of one anchor tile, by the anchor's place in it."""
    rows = rows.sort_by([("slot", "ascending"), ("rank", "ascending")])
    columns = [pa.array([rows[c].to_numpy().tobytes()], pa.binary()) for c in ("slot", "id", "score")]
    tile = pa.array([key[0].as_py()], pa.int64())
    return pa.Table.from_arrays([tile, *columns], names=["a_tile", "w_row", "w_id", "w_score"])


def _merged(heaps: DataFrame, k: int) -> DataFrame:
    """The best k of each slot over all tasks, with ``rank``; equal entries count once."""
    best = Window.partitionBy("tile", "slot").orderBy(F.desc("score"), "id")
    ranked = heaps.withColumn("rank", F.dense_rank().over(best)).where(F.col("rank") <= k)
    return ranked.dropDuplicates(["tile", "slot", "rank"])


def mine_hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | str = "label",
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
) -> DataFrame:
    """Per anchor and positive the first ``n_negatives`` rows of other labels whose score lies
    between ``low`` and ``high`` percent of the positive's: ``anchor_id``, ``positive_id``,
    ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Components become ``floor(scale * x)``, a score is the integer inner product with the
    anchor; higher scores come first, ties by smaller id. An anchor's positives are its first
    ``n_positives`` rows of the same label with another id. Vectors of unequal length are
    compared as if padded with zeros; empty ones score zero.

    Rows with a null id, label, vector or component, or one that is not finite, take no part.
    Rows that repeat in full count once; rows of one id with different vectors or labels count
    each, also as anchors. Without anchors, positives or rows the result is empty. Other columns
    are not read. Scores beyond 64 bits are an error. Labels are whole numbers.
    """
    # Whether a row is an anchor, and its label, may depend on columns that go now.
    whole = rows.select(
        F.col(id_col).cast("long").alias("id"),
        (label if isinstance(label, Column) else F.col(label)).cast("long").alias("label"),
        F.col(vector_col).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    whole = whole.where("id is not null and label is not null and vector is not null").where(finite)
    whole = whole.withColumn(
        "vector", F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    )

    packed = map_arrow(
        whole.select("id", "label", "vector"), _pack, TILE_LAYOUT.replace("tile long, ", "")
    )
    tiles = stored(packed.withColumn("tile", F.monotonically_increasing_id()), "vector-tiles")
    anchors = whole.where("anchor").select("id", "label", "vector").distinct()
    anchors = stored(anchors, "anchors")
    n_tiles = max(1, -(-anchors.count() // TILE))
    # Dealt by a hash, tiles are about full, and no larger than a few times that.
    dealt = F.pmod(F.xxhash64("id", "label", "vector"), F.lit(n_tiles))
    asked = anchors.withColumn("tile", dealt).groupBy("tile").applyInArrow(_pack_group, TILE_LAYOUT)
    asked = stored(asked.select(*(F.col(c).alias(f"a_{c}") for c in asked.columns)), "anchor-tiles")

    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lanes = max(1, min(width, tiles.count()))
    lane = F.pmod(F.xxhash64("tile"), F.lit(lanes)).cast("int").alias("lane")
    tiles = tiles.withColumn("lane", lane)
    every = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))

    def meet(asked: DataFrame) -> DataFrame:
        # Merged and never broadcast: Spark takes the copies for as small as the table they are made
        # from, and would gather lanes times its size on the driver. In a lane the tiles of anchors
        # come one after the other, so that the heaps of one are merged over all its tiles of rows.
        return asked.withColumn("lane", every).hint("merge").join(tiles, "lane")

    layout = "tile long, slot long, anchor_id long, positive_id long, positive_score long, score long, id long"

    found = map_arrow(meet(asked), _products("positives", n_positives, low, high), layout)
    positives = stored(_merged(found, n_positives), "positives")
    windows = positives.groupBy("tile").applyInArrow(
        _pack_windows, "a_tile long, w_row binary, w_id binary, w_score binary"
    )
    asked = stored(asked.join(windows, "a_tile"), "anchor-windows")

    found = map_arrow(meet(asked), _products("negatives", n_negatives, low, high), layout)
    return _merged(found, n_negatives).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
