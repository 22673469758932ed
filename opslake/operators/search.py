"""Top-k cosine similarity of query vectors against an index, exact or by LSH buckets.

The index is scanned where it lies: each task scores its rows against all queries of a block
with one matrix product and passes on at most k rows per query, so what is shuffled grows
with tasks x queries x k and never with the index. A query block is sent to the tasks only
up to a fixed size; larger query sets are several blocks and as many scans.

Scores are rounded to nine places, so that equal vectors tie exactly; ties go to the lower key.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.feature import (
    BucketedRandomProjectionLSH,
    BucketedRandomProjectionLSHModel,
    Normalizer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from opslake.operators.embedding import EMBEDDING, TextEmbedder
from opslake.session import scratch_path
from opslake.sources.numbering import numbered

# Tasks receive these functions with the job, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_ID = "query_id"
SCORE = "score"
RANK = "rank"
BUCKETS = "buckets"
SCORE_PLACES = 9
# Bounds of one query block: 2,048 vectors and 64 MB of doubles.
BLOCK_QUERIES = 2048
BLOCK_BYTES = 64 << 20
# Scores held at once by a task (32 MB of doubles).
SCORE_CELLS = 4 << 20
_SLOT, _NUMBER = "__slot", "__number"


def _matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows as float64; all vectors must have one width."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    widths = set(pc.unique(pc.list_value_length(vectors)).to_pylist())
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths: {sorted(widths)}")
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1)


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


@dataclass
class QueryBlock:
    """Unit query vectors, and their LSH buckets for an approximate search."""

    vectors: np.ndarray
    buckets: np.ndarray | None = None


def _candidates(
    batch: pa.RecordBatch | pa.Table, block: QueryBlock, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query slot, row, score) of each query's top k rows of a batch sorted by key."""
    stored = _unit(_matrix(batch.column(EMBEDDING)))
    if stored.shape[1] != block.vectors.shape[1]:
        raise ValueError(
            f"vectors of different widths: {stored.shape[1]} stored, {block.vectors.shape[1]} asked"
        )
    scores = np.round(stored @ block.vectors.T, SCORE_PLACES)
    if block.buckets is not None:
        shared = np.zeros(scores.shape, dtype=bool)
        of_rows = _matrix(batch.column(BUCKETS))
        for t in range(block.buckets.shape[1]):
            shared |= of_rows[:, t, None] == block.buckets[None, :, t]
        scores = np.where(shared, scores, -np.inf)
    rows = scores.shape[0]
    if rows > k:
        floor = np.partition(scores, rows - k, axis=0)[rows - k]
        above, level = scores > floor, scores == floor
        room = k - above.sum(axis=0)
        if (level.sum(axis=0) > room).any():  # many rows tie for the last places: lowest keys win
            level &= np.cumsum(level, axis=0, dtype=np.int32) <= room
        picked = above | level
    else:
        picked = np.ones(scores.shape, dtype=bool)
    picked &= scores > -np.inf
    row, slot = np.nonzero(picked)
    return slot, row, scores[row, slot]


def _keep_top(table: pa.Table, k: int, key: str) -> pa.Table:
    order = pc.sort_indices(
        table, sort_keys=[(_SLOT, "ascending"), (SCORE, "descending"), (key, "ascending")]
    )
    table = table.take(order)
    slots = table.column(_SLOT).to_numpy()
    rank = np.arange(len(slots)) - np.searchsorted(slots, slots, side="left")
    return table.filter(pa.array(rank < k))


def _slices(
    batches: Iterable[pa.RecordBatch | pa.Table], step: int
) -> Iterator[pa.RecordBatch | pa.Table]:
    """The rows that have a vector, at most ``step`` at a time."""
    for batch in batches:
        valid = batch.filter(pc.is_valid(batch.column(EMBEDDING)))
        for start in range(0, valid.num_rows, step):
            yield valid.slice(start, step)


def _local_top(
    batches: Iterable[pa.RecordBatch | pa.Table],
    block: QueryBlock,
    k: int,
    key: str,
    columns: Sequence[str],
) -> pa.Table | None:
    """The best k rows per query among ``batches``, holding one batch at a time."""
    best: pa.Table | None = None
    step = max(256, SCORE_CELLS // len(block.vectors))
    for batch in _slices(batches, step):
        batch = batch.take(pc.sort_indices(batch.column(key)))
        slot, row, score = _candidates(batch, block, k)
        picked = batch.select(list(columns)).take(pa.array(row))
        arrays = [pa.array(slot.astype(np.int64)), pa.array(score)]
        found = pa.table(
            arrays + [picked.column(c) for c in columns], names=[_SLOT, SCORE, *columns]
        )
        best = _keep_top(found if best is None else pa.concat_tables([best, found]), k, key)
    return best


def _columns_of(index: DataFrame, key: str, columns: Sequence[str]) -> list[str]:
    return list(dict.fromkeys([key, *columns]))


def _rank(found: DataFrame, k: int, key: str, columns: Sequence[str]) -> DataFrame:
    best = Window.partitionBy(QUERY_ID).orderBy(F.col(SCORE).desc(), F.col(key).asc())
    return (
        found.withColumn(RANK, F.row_number().over(best))
        .filter(F.col(RANK) <= k)
        .select(QUERY_ID, RANK, *columns, SCORE)
    )


def _result_schema(index: DataFrame, queries: DataFrame, columns: Sequence[str]) -> StructType:
    return StructType(
        [queries.schema[QUERY_ID]]
        + [index.schema[c] for c in columns]
        + [StructField(SCORE, DoubleType())]
    )


def _with_ids(top: pa.Table, ids: pa.Array, columns: Sequence[str]) -> pa.Table:
    return pa.table(
        [ids.take(top.column(_SLOT).combine_chunks())]
        + [top.column(c) for c in columns]
        + [top.column(SCORE)],
        names=[QUERY_ID, *columns, SCORE],
    )


def _scan(
    index: DataFrame,
    queries: DataFrame,
    rows: pa.Table,
    k: int,
    key: str,
    columns: list[str],
) -> DataFrame:
    """The best rows of every task, from one pass over the index with a block of queries."""
    ids = rows.column(QUERY_ID).combine_chunks()
    buckets = BUCKETS in rows.column_names
    vectors = _unit(_matrix(rows.column(EMBEDDING)))
    codes = _matrix(rows.column(BUCKETS)) if buckets else None
    sent = index.sparkSession.sparkContext.broadcast((vectors, codes))
    needed = list(dict.fromkeys([*columns, EMBEDDING] + ([BUCKETS] if buckets else [])))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = _local_top(batches, QueryBlock(*sent.value), k, key, columns)
        if top is not None:
            yield from _with_ids(top, ids, columns).combine_chunks().to_batches()

    return index.select(*needed).mapInArrow(scan, _result_schema(index, queries, columns))


def _query_blocks(queries: DataFrame, block_queries: int) -> Iterator[pa.Table]:
    """The queries in blocks of bounded rows and bytes, each brought to the driver by itself.

    They are numbered and written by block once, so a block is read from its own folder, and
    equal queries don't crowd into one.
    """
    first = queries.head()
    if first is None:
        return
    fit = max(1, min(block_queries, BLOCK_BYTES // (8 * max(1, len(first[EMBEDDING])))))
    rows, total = numbered(queries, _NUMBER, "queries")
    if total <= fit:
        yield rows.drop(_NUMBER).toArrow()
        return
    path = scratch_path(queries.sparkSession, "query-blocks")
    placed = rows.withColumn(_SLOT, F.expr(f"{_NUMBER} div {fit}")).drop(_NUMBER)
    placed.repartition(_SLOT).write.partitionBy(_SLOT).parquet(path)
    for number in range(math.ceil(total / fit)):
        block = queries.sparkSession.read.schema(queries.schema).parquet(f"{path}/{_SLOT}={number}")
        yield block.toArrow()


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 5,
    columns: Sequence[str] = (),
    key: str = "part_id",
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """The k most similar index rows of every query: query_id, rank, key, columns, score.

    ``index`` has ``key`` and ``embedding``; ``queries`` has ``query_id`` and ``embedding``.
    Every block of queries is one scan of the index where it lies; no index row is shuffled.
    """
    shown = _columns_of(index, key, columns)
    asked = queries.select(QUERY_ID, EMBEDDING).filter(F.col(EMBEDDING).isNotNull())
    blocks = _query_blocks(asked, block_queries)
    found = [_scan(index, asked, rows, k, key, shown) for rows in blocks]
    if not found:
        found = [index.sparkSession.createDataFrame([], _result_schema(index, asked, shown))]
    return _rank(reduce(DataFrame.unionByName, found), k, key, shown)


def search_text(
    index: DataFrame,
    queries: DataFrame,
    embedder: TextEmbedder,
    text: str = "query_text",
    k: int = 5,
    columns: Sequence[str] = (),
    key: str = "part_id",
) -> DataFrame:
    """``search`` for texts: the queries are embedded with the index's own model first."""
    return search(index, embedder.transform(queries, text), k, columns, key)


def _unit_vectors(df: DataFrame, column: str) -> DataFrame:
    """The rows that have a vector, with it scaled to unit length as an ML vector."""
    raw = df.filter(F.col(EMBEDDING).isNotNull()).withColumn("__raw", array_to_vector(EMBEDDING))
    return Normalizer(inputCol="__raw", outputCol=column).transform(raw).drop("__raw")


class LshBuckets:
    """Random-projection buckets of unit vectors: near ones share at least one with high odds."""

    _VECTOR, _HASHES = "__vector", "__hashes"

    def __init__(self, model: BucketedRandomProjectionLSHModel) -> None:
        self.model = model

    @classmethod
    def fit(
        cls, index: DataFrame, bucket_length: float = 0.5, tables: int = 6, seed: int = 42
    ) -> LshBuckets:
        lsh = BucketedRandomProjectionLSH(
            inputCol=cls._VECTOR,
            outputCol=cls._HASHES,
            bucketLength=bucket_length,
            numHashTables=tables,
            seed=seed,
        )
        return cls(lsh.fit(_unit_vectors(index, cls._VECTOR)))  # reads one row, for the width

    def assign(self, df: DataFrame) -> DataFrame:
        """``df`` with ``buckets``: one code per hash table, distinct between tables."""
        tables = self.model.getNumHashTables()
        hashed = self.model.transform(_unit_vectors(df, self._VECTOR))
        codes = F.array(
            *[
                (vector_to_array(F.col(self._HASHES)[t])[0] * tables + t).cast("bigint")
                for t in range(tables)
            ]
        )
        return hashed.withColumn(BUCKETS, codes).drop(self._VECTOR, self._HASHES)


def search_approx(
    index: DataFrame,
    queries: DataFrame,
    lsh: LshBuckets,
    k: int = 5,
    columns: Sequence[str] = (),
    key: str = "part_id",
) -> DataFrame:
    """``search`` over the rows that share a bucket with the query.

    ``index`` carries ``buckets`` (``LshBuckets.assign``), best stored with it. Rows that share
    none with any query of a block are dropped in the scan, before any score is computed. A
    query with fewer than k candidates is answered by the exact search. Queries without an id
    are left out. How much of the index the buckets drop depends on the data: where
    neighbours are hardly closer than other rows, it is little.
    """
    shown = _columns_of(index, key, columns)
    queries = queries.filter(F.col(QUERY_ID).isNotNull())
    asked = lsh.assign(queries.select(QUERY_ID, EMBEDDING)).select(QUERY_ID, EMBEDDING, BUCKETS)
    parts = []
    for rows in _query_blocks(asked, BLOCK_QUERIES):
        probed = pc.unique(pc.list_flatten(rows.column(BUCKETS))).to_pylist()
        near = index.filter(F.arrays_overlap(BUCKETS, F.array(*[F.lit(c) for c in probed])))
        parts.append(_scan(near, asked, rows, k, key, shown))
    if not parts:
        return search(index, queries, k, columns, key)
    found = _rank(reduce(DataFrame.unionByName, parts), k, key, shown)
    path = scratch_path(index.sparkSession, "lsh-found")
    found.write.parquet(path)
    found = index.sparkSession.read.schema(found.schema).parquet(path)
    answered = found.groupBy(QUERY_ID).count().filter(F.col("count") >= k).select(QUERY_ID)
    rest = queries.join(answered, QUERY_ID, "left_anti")
    exact = search(index, rest, k, columns, key)
    return found.join(answered, QUERY_ID, "left_semi").select(*exact.columns).unionByName(exact)
