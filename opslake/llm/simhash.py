"""Near duplicates by SimHash, candidates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments, each padded to a word of the perfect
[23,12,7] Golay code. Of two fingerprints that differ in at most two bits, some segment is
equal and the segment after it, in cyclic order, differs in at most one bit: for all ways to
place two errors in three segments, one of the three (equal, next) pairs fits. The equal
segment is used as it is; the next one through the code: every word of 23 bits lies within
three bits of exactly one codeword, and the words around one place decode to few codewords
(one or six), so two words that differ in one bit share a codeword index. A probe side looks
up the single index of each fingerprint among the several indices of the others, and the
difference in bits is verified in the join.

Buckets that hold many fingerprints are split by the code of the third segment as well, with
all its indices on both sides: two words that differ in two bits have a neighbour in common.
So no link is lost and no bucket grows with a group of near copies. Equal fingerprints are
combined first; only distinct ones are compared, and a fingerprint has at most 2,080 others
within two bits, so links grow with their number, not with its square.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import ROW, map_arrow, stored, with_row
from opslake.llm.components import connected_components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
# Bit ranges of the segments: 22, 21 and 21 bits.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Buckets with more fingerprints are split by the third segment.
HOT_BUCKET = 256
CODE_BITS, CODE_DATA = 23, 12
# Generator polynomial of the binary Golay code: x^11+x^9+x^7+x^6+x^5+x+1.
GENERATOR = 0b101011100011


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of a text's word shingles, as an unsigned integer.

    Words are runs of anything but ASCII blanks, A-Z lower-cased. A text of fewer words is
    one shingle, one without words has fingerprint zero. A bit is 1 if more than half of the
    shingle hashes, repeats included, have it.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[min(shingle, len(words)) - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 8192):
        part = hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``__row``, the id and ``fp``, the fingerprint as a signed bigint, per row of ``docs``."""
    kind = dict(docs.dtypes)[id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py()) for t in batch.column(2)), np.uint64, batch.num_rows
            )
            columns = [batch.column(0), batch.column(1), pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[ROW, id_col, "fp"])

    texts = with_row(docs).select(ROW, id_col, F.col(text_col).cast("string"))
    return map_arrow(texts, run, f"{ROW} long, {id_col} {kind}, fp long")


def _syndrome_table() -> np.ndarray:
    """Error pattern of at most three bits for each of the 2,048 syndromes."""
    table = np.zeros(1 << (CODE_BITS - CODE_DATA), np.uint32)
    for weight in range(1, 4):
        for bits in combinations(range(CODE_BITS), weight):
            error = sum(1 << b for b in bits)
            table[_syndromes(np.array([error], np.uint32))[0]] = error
    return table


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each word modulo the generator."""
    rest = words.astype(np.uint32).copy()
    for bit in range(CODE_BITS - 1, CODE_BITS - CODE_DATA - 1, -1):
        has = (rest >> np.uint32(bit)) & np.uint32(1)
        rest ^= has * np.uint32(GENERATOR << (bit - (CODE_BITS - CODE_DATA)))
    return rest


def golay_index(words: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index (data bits) of the one codeword within three bits of each word."""
    nearest = words.astype(np.uint32) ^ table[_syndromes(words)]
    return nearest >> np.uint32(CODE_BITS - CODE_DATA)


def golay_indices(words: np.ndarray, table: np.ndarray) -> list[np.ndarray]:
    """Per word the distinct indices of the word and its 23 neighbours: one or six."""
    near = [words, *(words ^ np.uint32(1 << b) for b in range(CODE_BITS))]
    around = np.sort(np.stack([golay_index(w, table) for w in near], axis=1), axis=1)
    first = np.ones(around.shape, bool)
    first[:, 1:] = around[:, 1:] != around[:, :-1]
    return np.split(around[first], np.cumsum(first.sum(axis=1))[:-1])


def _segment(fps: np.ndarray, number: int) -> np.ndarray:
    start, bits = SEGMENTS[number % 3]
    return ((fps >> np.uint64(start)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def _keys(fps: np.ndarray, several: bool, fine: bool) -> Iterator[list[int]]:
    """Bucket keys of each fingerprint: (pair, equal segment, index of the next segment), and
    for ``fine`` keys the index of the third one. ``several``: all indices, else one."""
    table = _syndrome_table()
    columns = []
    for pair in range(3):
        base = (np.uint64(pair) << np.uint64(60)) | (
            _segment(fps, pair).astype(np.uint64) << np.uint64(24)
        )
        following, third = _segment(fps, pair + 1), _segment(fps, pair + 2)
        if several:
            near = golay_indices(following, table)
        else:
            near = [[x] for x in golay_index(following, table)]
        far = golay_indices(third, table) if fine else None
        columns.append((base, near, far))
    for i in range(len(fps)):
        keys = []
        for base, near, far in columns:
            for a in near[i]:
                key = int(base[i]) | int(a) << 12
                keys.extend(key | int(b) for b in far[i]) if far is not None else keys.append(key)
        yield keys


def bucket_keys(fps: DataFrame, several: bool, fine: bool = False) -> DataFrame:
    """``key`` and ``fp``, one row per bucket that a fingerprint belongs to or looks into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                values = part.column(0).to_numpy().view(np.uint64)
                keys = list(_keys(values, several, fine))
                counts = np.fromiter(map(len, keys), np.int64, len(keys))
                flat = np.fromiter((k for own in keys for k in own), np.uint64, int(counts.sum()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(flat.view(np.int64)),
                        pa.array(np.repeat(values, counts).view(np.int64)),
                    ],
                    names=["key", "fp"],
                )

    return map_arrow(fps.select("fp"), run, "key long, fp long")


def _meet(probe: DataFrame, build: DataFrame, bits: int) -> DataFrame:
    """Pairs of fingerprints in one bucket that differ in few bits, smaller one first."""
    probe, build = probe.withColumnRenamed("fp", "a"), build.withColumnRenamed("fp", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    pairs = probe.join(build, "key").where((F.col("a") != F.col("b")) & close)
    return pairs.select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))


def fingerprint_links(fps: DataFrame, hot_bucket: int = HOT_BUCKET) -> DataFrame:
    """All pairs (``src``, ``dst``) of distinct fingerprints within ``MAX_BITS`` bits."""
    distinct = stored(fps.select("fp").distinct(), "fingerprints")
    build = stored(bucket_keys(distinct, several=True), "bucket-keys")
    hot = stored(build.groupBy("key").count().where(F.col("count") > hot_bucket), "hot-buckets")
    probe = bucket_keys(distinct, several=False)
    if hot.isEmpty():
        return _meet(probe, build, MAX_BITS).distinct()
    # The members of large buckets meet again under finer keys, which lose no pair.
    hot = hot.select("key")
    members = build.join(hot, "key", "left_semi").select("fp").distinct()
    members = stored(members, "hot-members")
    cold = _meet(probe.join(hot, "key", "left_anti"), build.join(hot, "key", "left_anti"), MAX_BITS)
    fine = _meet(
        bucket_keys(members, several=False, fine=True),
        bucket_keys(members, several=True, fine=True),
        MAX_BITS,
    )
    return cold.unionByName(fine).distinct()


def simhash_groups(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    hot_bucket: int = HOT_BUCKET,
) -> DataFrame:
    """One row per row of ``docs``: ``__row``, the id, ``fp`` and ``component_id``, the
    smallest id reachable over links of at most two differing bits, itself included.

    Null, empty and blank texts share fingerprint zero, which links like any other. Equal
    fingerprints are one class; repeated rows are in it. A null id is never the smallest
    while another is there; a component of null ids only has component null. An empty table
    gives no rows; other columns are left out.
    """
    rows = stored(fingerprints(docs, text_col, id_col), "simhash")
    links = stored(fingerprint_links(rows, hot_bucket), "simhash-links")
    roots = connected_components(links)
    smallest = rows.groupBy("fp").agg(F.min(id_col).alias("id"))
    classes = smallest.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root")
    )
    classes = stored(classes, "simhash-classes")
    least = classes.groupBy("root").agg(F.min("id").alias("component_id"))
    labels = classes.join(least, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select(ROW, id_col, "fp", "component_id")
