"""Benchmark passages in documents, found by Wu-Manber search over words.

The patterns are windows of consecutive benchmark words. Per pattern length a task builds a
shift table over blocks of two words: a block that ends a pattern has shift 0, any other
block of a pattern the distance to the nearest end, an unknown block the whole window. So
most places of a text are skipped. At shift 0 the bucket of the block lists the patterns
ending in it by the hash of their first words, and a direct comparison confirms.

Documents are searched where they are scanned, whole; nothing of them is shuffled as long as
the patterns fit one block of bounded size. More patterns make several blocks, each searched
against all documents, and the hits are merged per document.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import ROW, map_arrow, stored, with_row

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 10
# Benchmark text sent to the tasks at once: about 100 MB of tables in Python.
BLOCK_BYTES = 2 << 20

Words = tuple[bytes, ...]


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lower-cased (``bytes.lower`` does just that)."""
    return WORD.findall(text.encode().lower()) if text else []


def windows_of(words: list[bytes], width: int) -> set[Words]:
    """The distinct windows of an item; a shorter item is one window, an empty one none."""
    if not words:
        return set()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))}


class _Patterns:
    """Shift table and buckets for patterns of one length."""

    def __init__(self, length: int, patterns: Iterable[Words]):
        self.length = length
        self.block = min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[Words, int] = {}
        self.buckets: dict[Words, dict[int, list[Words]]] = defaultdict(lambda: defaultdict(list))
        for pattern in patterns:
            for end in range(self.block, length + 1):
                block = pattern[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.far), length - end)
            self.buckets[pattern[-self.block :]][hash(pattern[: self.block])].append(pattern)

    def search(self, words: list[bytes]) -> Iterator[tuple[int, Words]]:
        """Start and pattern of every occurrence."""
        length, block, far, shift = self.length, self.block, self.far, self.shift
        end, last = length, len(words)
        while end <= last:
            found = tuple(words[end - block : end])
            skip = shift.get(found, far)
            if skip:
                end += skip
                continue
            start = end - length
            for pattern in self.buckets[found].get(hash(tuple(words[start : start + block])), ()):
                if tuple(words[start:end]) == pattern:
                    yield start, pattern
            end += 1


class Searcher:
    """Hits of many windows of any lengths in one text."""

    def __init__(self, items_by_window: dict[Words, list]):
        self.items = items_by_window
        by_length = defaultdict(list)
        for window in items_by_window:
            by_length[len(window)].append(window)
        self.tables = [_Patterns(n, windows) for n, windows in sorted(by_length.items())]

    def hits(self, words: list[bytes]) -> tuple[list[list[int]], list]:
        """Merged [start, end) spans of hit words, in order, and the items found."""
        spans, found = [], set()
        for table in self.tables:
            for start, window in table.search(words):
                spans.append((start, start + table.length))
                found.update(self.items[window])
        merged: list[list[int]] = []
        for start, end in sorted(spans):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(end, merged[-1][1])
            else:
                merged.append([start, end])
        return merged, sorted(found)


def _search_block(docs: DataFrame, items: list[tuple], width: int) -> DataFrame:
    """All rows of ``docs`` (row id, id, text) against one block of items."""
    fields = dict(docs.dtypes)
    id_col = next(c for c in docs.columns if c not in (ROW, "text"))
    types = pa.list_(pa.list_(pa.int32())), pa.list_(pa.int64())
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_window: dict[Words, list] = defaultdict(list)
        for item, text in sent.value:
            for window in windows_of(words_of(text), width):
                by_window[window].append(item)
        searcher = Searcher(by_window)
        for batch in batches:
            words = [words_of(text.as_py()) for text in batch.column("text")]
            hits = [searcher.hits(w) for w in words]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(ROW),
                    batch.column(id_col),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array([h[0] for h in hits], types[0]),
                    pa.array([h[1] for h in hits], types[1]),
                ],
                names=[ROW, id_col, "n_words", "spans", "items"],
            )

    return map_arrow(
        docs,
        search,
        f"{ROW} long, {id_col} {fields[id_col]}, n_words long, spans array<array<int>>, items array<long>",
    )


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, each brought to the driver by itself."""
    sized = items.withColumn("size", F.octet_length("text"))
    total = sized.agg(F.sum("size")).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    for number in range(blocks):
        mine = F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == number
        yield [tuple(r) for r in sized.where(mine).select("item", "text").collect()]


def benchmark_hits(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``__row``, the id, ``n_words``, ``spans`` (merged
    [start, end) word positions inside any occurrence of a window) and ``items`` (distinct
    ids of items with occurring windows, ascending).

    Null and empty texts have no words and no hits. Items without an id or without words are
    left out; repeated items count once. Without benchmark items, every row has no hits.
    Other columns of both tables are left out.
    """
    texts = with_row(docs).select(ROW, id_col, F.col(text_col).alias("text"))
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")
    ).where("item is not null and text is not null")
    found = [_search_block(texts, block, width) for block in _blocks(items, block_bytes)]
    if len(found) == 1:
        return found[0]
    # Only rows with hits in some block are merged.
    hit = [stored(part, "benchmark-hits") for part in found]
    some = reduce(DataFrame.unionByName, [p.where("size(items) > 0") for p in hit])
    merged = some.groupBy(ROW).agg(
        F.flatten(F.collect_list("spans")).alias("more_spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("more_items"),
    )
    none = F.array()
    return hit[0].join(merged, ROW, "left").select(
        ROW,
        id_col,
        "n_words",
        merge_spans(F.coalesce("more_spans", none.cast("array<array<int>>"))).alias("spans"),
        F.coalesce("more_items", none.cast("array<long>")).alias("items"),
    )


def merge_spans(spans):
    """[start, end) spans as a Column, sorted and with touching ones joined."""
    empty = F.array().cast("array<array<int>>")
    return F.aggregate(
        F.array_sort(spans),
        empty,
        lambda out, span: F.when(
            (F.size(out) > 0) & (span[0] <= F.element_at(out, -1)[1]),
            F.concat(
                F.slice(out, 1, F.size(out) - 1),
                F.array(
                    F.array(
                        F.element_at(out, -1)[0], F.greatest(F.element_at(out, -1)[1], span[1])
                    )
                ),
            ),
        ).otherwise(F.concat(out, F.array(span))),
    )


def hit_words(spans):
    """Words covered by merged spans, as a Column."""
    zero = F.lit(0).cast("long")
    return F.aggregate(spans, zero, lambda n, span: n + (span[1] - span[0]).cast("long"))
