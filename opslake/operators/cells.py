"""Approximate top-k search over an index that is partitioned by cells.

Vectors of unit length are assigned to the nearest of a number of centres, which k-means fits on
a bounded sample. The index is written with a folder per cell; a search reads the folders of the
cells nearest to its queries and scores their rows exactly. How many cells a query probes
follows from the recall that is measured against the exact search when the index is built.
"""

from __future__ import annotations

import json
import math
import sys
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslake.operators import search
from opslake.operators.embedding import EMBEDDING
from opslake.operators.search import QUERY_ID, RANK
from opslake.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELL = "cell"
# Bounds of what is fitted and measured on.
SAMPLE_ROWS, SAMPLE_QUERIES = 50_000, 200
RECALL = 0.9
# More cells than this cost more to assign rows to, and to list, than their searches save.
MAX_CELLS = 1024


def _sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About so many rows and no more, by a hash of the key."""
    share = min(1.0, 1.2 * rows / max(1, total))
    drawn = F.pmod(F.xxhash64(key, F.lit("cells")), F.lit(1_000_000)) < int(share * 1_000_000)
    return df.where(drawn).limit(rows)


def _nearest(vectors: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each unit vector, nearest first."""
    if len(vectors) and vectors.shape[1] != centres.shape[1]:
        raise ValueError(f"vectors of different widths: {centres.shape[1]} stored, {vectors.shape[1]} asked")
    step, found = 1024, [np.empty((0, min(n, len(centres))), dtype=np.int64)]
    for start in range(0, len(vectors), step):
        scores = vectors[start : start + step] @ centres.T
        if n == 1:
            found.append(scores.argmax(axis=1)[:, None])
        else:
            found.append(np.argsort(-scores, axis=1, kind="stable")[:, :n])
    return np.concatenate(found)


class CellIndex:
    """An index under ``path``: rows by cell, the centres, and the number of cells to probe."""

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key
        row = spark.read.parquet(f"{self.path}/model").head()
        self.centres = np.array(json.loads(row["centres"]))
        self.probes, self.recall = row["probes"], row["recall"]
        self.schema = StructType.fromJson(json.loads(row["schema"])).add(CELL, "integer")
        self._rows: DataFrame | None = None

    @classmethod
    def build(
        cls,
        index: DataFrame,
        path: str,
        key: str,
        cells: int | None = None,
        recall: float = RECALL,
        k: int = 5,
        seed: int = 42,
    ) -> CellIndex:
        """Write the rows of ``index`` that have a vector into a new folder under ``path``.

        ``cells`` is the square root of the number of rows, at most ``MAX_CELLS``, unless given. The probe count is the
        smallest power of two (or all cells) that reaches ``recall`` at ``k`` over a sample of the
        rows as queries. Centres come from at most ``SAMPLE_ROWS`` rows; every row is indexed.
        """
        spark = index.sparkSession
        path = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
        # Fitting and measuring read the rows many times, so they are written first.
        given = scratch_path(spark, "cell-rows")
        index.where(F.col(EMBEDDING).isNotNull()).write.parquet(given)
        rows = spark.read.schema(index.schema).parquet(given)
        total = rows.count()
        cells = max(1, min(cells or min(math.isqrt(total), MAX_CELLS), max(1, total)))
        pointing = rows.where(F.exists(EMBEDDING, lambda x: x != 0))
        unit = search._unit_vectors(_sample(pointing, key, SAMPLE_ROWS, total), "features")
        width = len(rows.head()[EMBEDDING]) if total else 1
        centres = np.zeros((1, width))  # of vectors without a direction
        if not unit.isEmpty():
            model = KMeans(k=cells, seed=seed, maxIter=10, distanceMeasure="cosine").fit(unit.select("features"))
            centres = search._unit(np.array(model.clusterCenters()))
        sent = spark.sparkContext.broadcast(centres)  # cells x width numbers

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    vectors = search._unit(search._matrix(batch.column(EMBEDDING)))
                    cell = _nearest(vectors, sent.value, 1)[:, 0].astype(np.int32)
                    yield batch.append_column(CELL, pa.array(cell))

        layout = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + f", {CELL} int"
        # Written before they are dealt by range, which reads its input twice.
        placed = scratch_path(spark, "cell-assigned")
        rows.mapInArrow(assign, layout).write.parquet(placed)
        assigned = spark.read.schema(layout).parquet(placed)
        # A large cell lies in several files, dealt by key.
        ordered = assigned.repartitionByRange(CELL, key).sortWithinPartitions(CELL, key)
        ordered.write.partitionBy(CELL).parquet(f"{path}/rows")
        model = (json.dumps(centres.tolist()), 1, 0.0, rows.schema.json())
        cls._write_model(spark, path, model)
        found = cls(spark, path, key)
        if total:
            found._calibrate(rows, total, recall, k, model)
        return found

    @staticmethod
    def _write_model(spark: SparkSession, path: str, model: tuple) -> None:
        row = spark.createDataFrame([model], "centres string, probes int, recall double, schema string")
        row.coalesce(1).write.mode("overwrite").parquet(f"{path}/model")

    def _calibrate(self, rows: DataFrame, total: int, recall: float, k: int, model: tuple) -> None:
        asked = _sample(rows, self.key, SAMPLE_QUERIES, total).select(
            F.col(self.key).alias(QUERY_ID), EMBEDDING
        )
        stored = scratch_path(self.spark, "cell-queries")
        asked.write.parquet(stored)
        asked = self.spark.read.parquet(stored)
        exact = {(r[QUERY_ID], r[self.key]) for r in search.search(rows, asked, k, key=self.key).collect()}
        probes = 1
        while True:
            probes = min(probes, len(self.centres))
            near = self.search(asked, k, probes=probes, complete=False).collect()
            reached = len(exact & {(r[QUERY_ID], r[self.key]) for r in near}) / max(1, len(exact))
            if reached >= recall or probes == len(self.centres):
                break
            probes *= 2
        self.probes, self.recall = probes, reached
        self._write_model(self.spark, self.path, (model[0], probes, reached, model[3]))

    def rows(self) -> DataFrame:
        """The indexed rows. The folder doesn't change, so its files are listed once."""
        if self._rows is None:
            self._rows = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        return self._rows

    def search(
        self,
        queries: DataFrame,
        k: int = 5,
        columns: Sequence[str] = (),
        probes: int | None = None,
        complete: bool = True,
    ) -> DataFrame:
        """The k best rows of the probed cells for every query: query_id, rank, key, columns, score.

        Only the folders of cells that some query of a block probes are read. A block is as many
        queries as fit its bytes, since a row only meets those that probe its cell. With ``complete`` a
        query whose cells hold fewer than k rows is answered by the exact search.
        """
        shown = search._columns_of(self.rows(), self.key, columns)
        asked = queries.select(QUERY_ID, EMBEDDING).filter(F.col(EMBEDDING).isNotNull())
        if self.rows().isEmpty():
            return search.search(self.rows(), asked, k, columns, self.key)
        parts = [
            self._scan(asked, block, k, shown, probes or self.probes)
            for block in search._query_blocks(asked, sys.maxsize)
        ]
        if not parts:
            return search.search(self.rows(), asked, k, columns, self.key)
        found = search._rank(reduce(DataFrame.unionByName, parts), k, self.key, shown)
        if not complete:
            return found
        stored = scratch_path(self.spark, "cell-found")
        found.write.parquet(stored)
        found = self.spark.read.schema(found.schema).parquet(stored)
        full = found.groupBy(QUERY_ID).agg(F.max(RANK).alias("n")).where(F.col("n") >= k)
        rest = asked.where(F.col(QUERY_ID).isNotNull()).join(full, QUERY_ID, "left_anti")
        exact = search.search(self.rows(), rest, k, columns, self.key)
        kept = found.join(full.select(QUERY_ID), QUERY_ID, "left_semi")
        return kept.select(*exact.columns).unionByName(exact)

    def _scan(self, asked: DataFrame, block: pa.Table, k: int, shown: list[str], probes: int) -> DataFrame:
        ids = block.column(QUERY_ID).combine_chunks()
        vectors = search._unit(search._matrix(block.column(EMBEDDING)))
        nearest = _nearest(vectors, self.centres, probes)
        order = np.argsort(nearest, axis=None, kind="stable")
        at, first = np.unique(nearest.ravel()[order], return_index=True)
        slots = np.split(order // max(1, nearest.shape[1]), first[1:])
        asking = {int(c): own for c, own in zip(at, slots)}
        rows = self.rows().where(F.col(CELL).isin(sorted(asking)))
        sent = self.spark.sparkContext.broadcast((vectors, asking))
        key = self.key

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            vectors, asking = sent.value
            best: dict[tuple[int, int], pa.Table] = {}
            for batch in batches:
                cells = batch.column(CELL).to_numpy()
                for cell in np.unique(cells).tolist():
                    own = batch.take(pa.array(np.flatnonzero(cells == cell)))
                    # No more queries at once than a block of the exact search has.
                    for start in range(0, len(asking[cell]), search.BLOCK_QUERIES):
                        slots = asking[cell][start : start + search.BLOCK_QUERIES]
                        top = search._local_top([own], search.QueryBlock(vectors[slots]), k, key, shown)
                        if top is not None:
                            before = best.get((cell, start))
                            top = top if before is None else pa.concat_tables([before, top])
                            best[cell, start] = search._keep_top(top, k, key)
            for (cell, start), top in best.items():
                own_ids = ids.take(pa.array(asking[cell][start : start + search.BLOCK_QUERIES]))
                yield from search._with_ids(top, own_ids, shown).combine_chunks().to_batches()

        needed = list(dict.fromkeys([*shown, EMBEDDING, CELL]))
        return rows.select(*needed).mapInArrow(scan, search._result_schema(rows, asked, shown))
