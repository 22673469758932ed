"""Lines repeated across documents, counted in levelled sorted runs of line hashes.

Documents arrive in batches. A batch brings the hashes of its lines, leaves out those that
the runs have settled as repeated (an anti-join), counts the rest and adds the counts as a
sorted run of level 0. Whenever a level holds ``fanout`` runs they are merged into one run
of the next level, so few runs exist and each count is rewritten only a logarithmic number
of times. A line key is settled once its counts reach the limit.

Only DataFrame functions are used. Keys are 128-bit hashes: two 64-bit hashes with different
seeds. A line found in every document is combined before each shuffle; where lines meet the
repeated keys, the adaptive skew join splits it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.llm.common import ROW, lower_ascii, stored, with_row

BLANKS = " \t\n\x0b\x0c\r"
HASH = ["h1", "h2"]
MIN_DOCS = 10
MIN_CHARS = 1
BATCHES = 4
FANOUT = 4
# Repeated keys, of 16 bytes each, that are sent to the tasks: 8 MB.
BROADCAST_KEYS = 500_000


def line_key(line: Column) -> Column:
    """What makes two lines equal: stripped of blanks at both ends, A-Z lower-cased."""
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def _hashes(line: Column, min_chars: int) -> Column:
    """The two hashes of a line's key; null for a shorter key."""
    key = line_key(line)
    both = F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))
    return F.when(F.char_length(key) >= min_chars, both)


class LineRuns:
    """Counts of line hashes as sorted runs by level, in the shared folder."""

    def __init__(self, spark: SparkSession, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.spark = spark
        self.min_docs = min_docs
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def _write(self, counts: DataFrame, level: int) -> None:
        run = stored(counts.sortWithinPartitions(*HASH), f"line-run-{level}")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        self.settled.append(run.where(F.col("docs") >= self.min_docs).select(*HASH))

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        together = reduce(DataFrame.unionByName, runs)
        return together.groupBy(*HASH).agg(F.sum("docs").alias("docs"))

    def add(self, keys: DataFrame) -> None:
        """Add a batch: ``h1`` and ``h2``, one row per document and distinct line."""
        if self.settled:
            known = reduce(DataFrame.unionByName, self.settled).distinct()
            keys = keys.join(known, HASH, "left_anti")
        self._write(keys.groupBy(*HASH).agg(F.count(F.lit(1)).alias("docs")), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._write(self._merged(runs), level + 1)
            level += 1

    def repeated(self) -> DataFrame:
        """The keys found in at least ``min_docs`` documents over all batches."""
        runs = [run for level in self.levels for run in level]
        if not runs:
            return self.spark.createDataFrame([], "h1 long, h2 long")
        last = self._merged(runs).where(F.col("docs") >= self.min_docs).select(*HASH)
        return reduce(DataFrame.unionByName, [*self.settled, last]).distinct()


def dedup_lines(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    min_docs: int = MIN_DOCS,
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_lines``, ``n_dropped`` and ``kept_text``.

    Every line whose key of at least ``min_chars`` characters is found in at least
    ``min_docs`` rows goes, in every row; a row that repeats a line counts once. Null and
    empty texts are one empty line, which stays. Rows count as documents of their own, also
    if ids repeat or are null. An empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    source = with_row(docs).select(ROW, id_col, F.coalesce(text_col, F.lit("")).alias("text"))
    lines = F.split("text", "\n")
    keys = F.transform(lines, lambda line: _hashes(line, min_chars))
    batch = F.pmod(F.xxhash64(ROW), F.lit(batches)).cast("int")
    keyed = stored(source.select(ROW, batch.alias("batch"), keys.alias("keys")), "line-keys")

    runs = LineRuns(spark, min_docs, fanout)
    for number in range(batches):
        part = keyed.where(F.col("batch") == number)
        found = part.select(F.explode(F.array_distinct("keys")).alias("key"))
        runs.add(found.where("key is not null").select("key.h1", "key.h2"))
    repeated = stored(runs.repeated(), "repeated-lines")
    if repeated.count() <= BROADCAST_KEYS:
        repeated = F.broadcast(repeated)  # else a shuffle join, which can split hot lines

    placed = keyed.select(ROW, F.posexplode("keys").alias("pos", "key"))
    placed = placed.where("key is not null").select(ROW, "pos", "key.h1", "key.h2")
    dropped = placed.join(repeated, HASH, "left_semi")
    dropped = dropped.groupBy(ROW).agg(F.collect_list("pos").alias("dropped"))

    whole = source.select(ROW, id_col, lines.alias("lines")).join(dropped, ROW, "left")
    size = F.size("lines")
    left = F.array_except(F.sequence(F.lit(0), size - 1), F.col("dropped"))
    kept = F.transform(left, lambda pos: F.get(F.col("lines"), pos))
    return whole.select(
        id_col,
        size.cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(F.when(F.col("dropped").isNull(), F.col("lines")).otherwise(kept), "\n").alias(
            "kept_text"
        ),
    )
