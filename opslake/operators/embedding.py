"""Text to fixed-width vectors, and the incrementally synced index of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.operators.diff import CHANGE, one_per_key, snapshot_diff
from opslake.operators.text_index import word_id, words_of
from opslake.session import scratch_path
from opslake.sources.segments import SegmentedTable

EMBEDDING = "embedding"


class TextEmbedder(Protocol):
    def transform(self, df: DataFrame, text: str, output: str = EMBEDDING) -> DataFrame:
        """``df`` with ``output`` as array<float>; NULL text gives a zero vector or NULL."""


class TfIdfEmbedder:
    """Hashed TF-IDF of a text's words, scaled to unit length.

    Lexical: texts are close when they share rare words. Fitting makes one pass that keeps
    ``width`` document counts; the model is ``width`` doubles, whatever the data's size.
    """

    _TEXT, _WORDS, _TF, _IDF, _UNIT = "__text", "__words", "__tf", "__idf", "__unit"

    def __init__(self, model: PipelineModel) -> None:
        self.model = model

    @classmethod
    def fit(cls, df: DataFrame, text: str, width: int = 512) -> TfIdfEmbedder:
        stages = [
            RegexTokenizer(
                inputCol=cls._TEXT, outputCol=cls._WORDS, pattern=r"\p{L}+", gaps=False
            ),
            HashingTF(inputCol=cls._WORDS, outputCol=cls._TF, numFeatures=width),
            IDF(inputCol=cls._TF, outputCol=cls._IDF),
            Normalizer(inputCol=cls._IDF, outputCol=cls._UNIT),
        ]
        texts = df.select(F.coalesce(F.col(text), F.lit("")).alias(cls._TEXT))
        return cls(Pipeline(stages=stages).fit(texts))

    @classmethod
    def load(cls, path: str) -> TfIdfEmbedder:
        return cls(PipelineModel.load(path))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    def transform(self, df: DataFrame, text: str, output: str = EMBEDDING) -> DataFrame:
        named = df.withColumn(self._TEXT, F.coalesce(F.col(text), F.lit("")))
        embedded = self.model.transform(named)
        return embedded.withColumn(output, vector_to_array(self._UNIT, "float32")).drop(
            self._TEXT, self._WORDS, self._TF, self._IDF, self._UNIT
        )


class ModelEmbedder:
    """A user's own model: ``encode`` maps a list of texts to an (n, width) array.

    It runs on Arrow batches inside the tasks and is only given texts that are not NULL.
    """

    def __init__(self, encode: Callable[[list[str]], np.ndarray]) -> None:
        self.encode = encode

    def transform(self, df: DataFrame, text: str, output: str = EMBEDDING) -> DataFrame:
        encode = self.encode

        @F.arrow_udf("array<float>")
        def embed(texts: pa.Array) -> pa.Array:
            present = texts.drop_null().to_pylist()
            if not present:
                return pa.nulls(len(texts), pa.list_(pa.float32()))
            rows = np.asarray(encode(present), dtype=np.float32)
            filled = pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), rows.shape[1])
            # The vector of each text is at its place among those that are there.
            place = np.cumsum(texts.is_valid().to_numpy(zero_copy_only=False)) - 1
            place = pa.array(place, mask=texts.is_null().to_numpy(zero_copy_only=False))
            return filled.take(place).cast(pa.list_(pa.float32()))

        return df.withColumn(output, embed(F.col(text)))


class HashedWordEmbedder:
    """Counts of a text's words by hash, scaled to unit length. Needs no fitting, and any SQL
    engine can compute it: a word's place is its id (``word_id``) modulo the width."""

    def __init__(self, width: int = 64, salt: str = "") -> None:
        self.width, self.salt = width, salt

    def transform(self, df: DataFrame, text: str, output: str = EMBEDDING) -> DataFrame:
        salted = F.transform(words_of(F.col(text)), lambda w: F.concat(w, F.lit(self.salt)))
        places = F.transform(salted, lambda w: F.pmod(word_id(w), F.lit(self.width)).cast("int"))
        every = F.sequence(F.lit(0), F.lit(self.width - 1))

        def counts(own: Column) -> Column:
            # What is left without a place tells how often it is there: no step per word and place.
            return F.transform(every, lambda i: (F.size(own) - F.size(F.array_remove(own, i))).cast("double"))

        def unit(found: Column) -> Column:
            norm = F.sqrt(F.aggregate(found, F.lit(0.0), lambda a, x: a + x * x))
            return _let(norm, lambda n: F.transform(found, lambda x: F.when(n > 0, x / n).otherwise(0.0)))

        vector = _let(places, lambda own: _let(counts(own), unit))
        return df.withColumn(output, vector.cast("array<float>"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it; as a
    column of its own it would be put in place of each name."""
    return F.transform(F.array(value), body)[0]


def _current(source: DataFrame, key: str, text: str, columns: Sequence[str] | None) -> DataFrame:
    kept = [c for c in (columns or source.columns) if c not in (key, text)]
    return one_per_key(source.filter(F.col(key).isNotNull()).select(key, text, *kept), key)


def _stored_changes(index: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """What differs between an index, without its vectors, and the source; written once."""
    path = scratch_path(current.sparkSession, "index-changes")
    snapshot_diff(index, current, key).write.parquet(path)
    return current.sparkSession.read.parquet(path)


def _fresh_rows(
    index: DataFrame, changes: DataFrame, embedder: TextEmbedder, key: str, text: str
) -> DataFrame:
    """The new and changed rows with their vectors: the old one where the text stayed."""
    upserts = changes.filter(F.col(CHANGE) != "delete").drop(CHANGE)
    replaced = index.join(upserts.select(key), key, "left_semi").select(
        key, F.col(text).alias("__old_text"), F.col(EMBEDDING).alias("__old_vector")
    )
    same_text = F.col("__old_vector").isNotNull() & F.col("__old_text").eqNullSafe(F.col(text))
    todo = (
        upserts.join(replaced, key, "left")
        .withColumn("__keep", same_text)
        .withColumn("__todo", F.when(~F.col("__keep"), F.col(text)))
    )
    embedded = embedder.transform(todo, "__todo", "__new_vector")
    vector = F.when(F.col("__keep"), F.col("__old_vector")).otherwise(F.col("__new_vector"))
    return embedded.select(*upserts.columns, vector.alias(EMBEDDING))


def sync_index(
    index: DataFrame | None,
    source: DataFrame,
    embedder: TextEmbedder,
    key: str,
    text: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The index brought up to date with ``source``.

    Rows whose text is new or changed are embedded, rows gone from the source are gone, and
    the others keep their vector; a row whose other columns changed keeps its vector too.
    Running it again embeds nothing and returns ``index`` itself. Rows without a key cannot be
    indexed; of rows that repeat a key the largest counts (``one_per_key``).

    The comparison moves keys, texts and columns but no vectors. Its result, which is as large
    as the change, is written to the scratch folder once; the index is then filtered by it,
    without a shuffle while the change is small enough for Spark to broadcast.
    """
    current = _current(source, key, text, columns)
    if index is None:
        return embedder.transform(current, text)
    known = index
    index = index.filter(F.col(EMBEDDING).isNotNull()).select(*current.columns, EMBEDDING)
    changes = _stored_changes(index.drop(EMBEDDING), current, key)
    if changes.isEmpty():
        return known
    fresh = _fresh_rows(index, changes, embedder, key, text)
    untouched = index.join(changes.select(key), key, "left_anti")
    return untouched.select(*fresh.columns).unionByName(fresh)


def sync_segments(
    index: SegmentedTable,
    source: DataFrame,
    embedder: TextEmbedder,
    text: str,
    columns: Sequence[str] | None = None,
) -> bool:
    """``sync_index`` for an index in segments: what changed is all that is written, as one more
    segment. Returns whether anything did. The first sync writes the base."""
    key = index.key
    current = _current(source, key, text, columns)
    if index.manifest() is None:
        index.rewrite(embedder.transform(current, text))
        return True
    changes = _stored_changes(index.read(current.columns), current, key)
    if changes.isEmpty():
        return False
    fresh = _fresh_rows(index.read([key, text, EMBEDDING]), changes, embedder, key, text)
    index.append(fresh, changes.filter(F.col(CHANGE) == "delete"))
    return True
