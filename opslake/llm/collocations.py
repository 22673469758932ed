"""Phrase collocations by direct-address tiles, level by level.

Text is read once into blocks: positions of words as numbers, with a gap where a piece ends,
and the block's distinct words with their counts. Distinct words meet in shards, by a hash of the
word, where they are summed and the frequent ones ranked; a word's id is its rank in the shard
times the number of shards, plus the shard, so ids follow the frequency. Back in its blocks,
pairs of neighbours are counted: ids are ranked within the block by frequency, the square of ranks
is cut into tiles, pairs of a well-filled tile are counted with a dense ``bincount`` and those of
the other tiles as one sorted coordinate list. Distinct pairs meet in shards in their turn.
Frequent pairs are ranked again, by their own frequency, and neighbouring pairs that share a
word are the pairs of the next level: triples come from pairs, quadruples from triples. A phrase
is frequent only if both its parts are, so nothing frequent is missed.

A block has a bounded number of words, save for a longer text, which stays in one piece, and a
phrase is one entry of it however often it occurs. Shards follow the size of the text, so a
shard's entries fit in a task. What a block sends to a shard is one row of packed arrays; where
shards outnumber the entries of a block, that row has one entry and costs what a plain row does.
Blocks lie in buckets, so their positions are never shuffled.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.common import bucketed, discard, map_arrow, stored

# A phrase never spans one of these.
BREAKS = b".,;:!?\n\x0b\x0c\r"
MIN_COUNT = 30
MAX_WORDS = 4
# A phrase goes if a longer one around it has this percentage of its occurrences.
COVERED = 80
TOP = 2000
PARTS = 16
BLOCK_WORDS = 1 << 20
# Bytes of text that a shard stands for, and that a bucket of blocks holds at most.
SHARD_BYTES, BUCKET_BYTES = 8 << 20, 64 << 20
TILE = 512
# A tile with a pair for every so many of its cells is counted densely.
DENSE_SHARE = 16
NO_LANGUAGE = "und"
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + BREAKS + b"\t", bytes(range(97, 123)) + b"\n" * len(BREAKS) + b" "
)


def pieces_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, with a newline where a piece ends; blanks
    between words may give empty entries."""
    return (text or "").encode().translate(_FOLD).replace(b"\n", b" \n ").split(b" ")


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from zero up, byte plane by byte plane: high planes are left out or hardly
    differ, and compress well."""
    used = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :used]
    return bytes([used]) + np.ascontiguousarray(planes.T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view("<i8").ravel()


def _rising(values: np.ndarray) -> bytes:
    return _packed(np.diff(values, prepend=0))


def _risen(data: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(data))


# A block's positions (0: a gap, else 1 + slot), or its entries for a shard: their slots run from
# ``base``; ``keys`` has the words of a language, or the ids of the phrases by place.
BLOCK = "block long, positions binary, shard int, base int, lang string, keys array<binary>, n binary"
_BLOCK = pa.schema(
    [("block", pa.int64()), ("positions", pa.binary()), ("shard", pa.int32()), ("base", pa.int32()),
     ("lang", pa.string()), ("keys", pa.list_(pa.binary())), ("n", pa.binary())]
)


def _batch(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema)


class _Block:
    """Positions of the words of several texts, numbered per language."""

    def __init__(self):
        self.slots: dict[str, defaultdict] = {}
        self.parts: list[tuple[str, np.ndarray]] = []
        self.size = 0

    def add(self, lang: str, text: str | None) -> None:
        slots = self.slots.get(lang)
        if slots is None:
            slots = self.slots[lang] = defaultdict()
            slots.default_factory = slots.__len__
            slots[b""], slots[b"\n"]
        words = pieces_of(text)
        found = np.fromiter(map(slots.__getitem__, words), np.int32, len(words))
        found = found[found > 0] - 2
        self.parts.append((lang, found))
        self.size += len(found) + 1

    def rows(self, block: int, shards: int) -> Iterator[pa.RecordBatch]:
        """One row with the positions, then one for each language and shard."""
        places, base, out = {}, 0, []
        for lang, slots in self.slots.items():
            words = list(slots)[2:]
            own = np.fromiter((zlib.crc32(w) for w in words), np.int64, len(words)) % shards
            order = np.argsort(own, kind="stable")
            # The slot of each word: by shard, from the language's first one on. The last is the gap.
            place = np.full(len(words) + 1, -1, np.int64)
            place[order] = np.arange(base, base + len(words))
            places[lang] = place
            numbers, starts = np.unique(own[order], return_index=True)
            for shard, part in zip(numbers.tolist(), np.split(order, starts[1:]) if len(words) else []):
                joined = b"\n".join([words[i] for i in part.tolist()])
                out.append({"block": block, "shard": shard, "base": base, "lang": lang, "keys": [joined]})
                base += len(part)
        gap = np.array([-1])
        positions = np.concatenate([x for lang, found in self.parts for x in (places[lang][found], gap)])
        counts = np.bincount(positions[positions >= 0], minlength=base)
        for row in out:
            size = row["keys"][0].count(b"\n") + 1
            row["n"] = _packed(counts[row["base"] : row["base"] + size])
        yield _batch(_BLOCK, [{"block": block, "positions": _packed(positions + 1)}, *out])


def _read_blocks(block_words: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                block.add(lang.as_py(), text.as_py())
                if block.size >= block_words:
                    yield from block.rows(number, shards)
                    number, block = number + 1, _Block()
        if block.size:
            yield from block.rows(number, shards)

    return run


def count_pairs(
    a: np.ndarray, b: np.ndarray, ids: int, tile: int = TILE, dense_share: int = DENSE_SHARE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of the ids ``0 .. ids - 1`` with their counts, and for each given pair
    its place among them: first ids, second ids, counts, places.

    Tiles of ids that hold many pairs are counted by address, all others as a sorted list.
    """
    cells = tile * tile
    side = -(-ids // tile)
    number = (a // tile) * side + b // tile
    cell = (a % tile) * tile + b % tile
    place = np.empty(len(a), np.int64)
    found_key, found_n = [], []
    base = 0
    # With few tiles, numbers of 16 bits are sorted in linear time.
    kind = np.uint16 if side * side <= 1 << 16 else np.int64
    order = np.argsort(number.astype(kind), kind="stable")
    tiles, starts = np.unique(number[order], return_index=True)
    ends = np.append(starts[1:], len(a))
    filled = ends - starts >= cells // dense_share
    for at, start, end in zip(tiles[filled].tolist(), starts[filled], ends[filled]):
        own = order[start:end]
        counts = np.bincount(cell[own], minlength=cells)
        present = np.flatnonzero(counts)
        address = np.empty(cells, np.int64)
        address[present] = np.arange(base, base + len(present))
        place[own] = address[cell[own]]
        found_key.append(at * cells + present)
        found_n.append(counts[present])
        base += len(present)
    rest = order[np.repeat(~filled, ends - starts)]
    if len(rest):
        keys, places, counts = np.unique(
            number[rest] * cells + cell[rest], return_inverse=True, return_counts=True
        )
        place[rest] = places + base
        found_key.append(keys)
        found_n.append(counts)
    key = np.concatenate(found_key) if found_key else np.empty(0, np.int64)
    n = np.concatenate(found_n) if found_n else np.empty(0, np.int64)
    at, inside = key // cells, key % cells
    first = (at // side) * tile + inside // tile if ids else key
    second = (at % side) * tile + inside % tile if ids else key
    return first, second, n, place


def _frequent(words: int) -> tuple[str, pa.Schema]:
    """What a shard returns: for a block the slots, ids and counts of its frequent entries, or one
    frequent phrase, or (without ``w1``) a language's words."""
    ids = [f"w{i + 1}" for i in range(words)]
    layout = "of long, slots binary, keys array<binary>, counts binary, lang string, word string, "
    layout += "".join(f"{c} long, " for c in ids) + "f long"
    kinds = [("of", pa.int64()), ("slots", pa.binary()), ("keys", pa.list_(pa.binary())), ("counts", pa.binary())]
    kinds += [("lang", pa.string()), ("word", pa.string()), *((c, pa.int64()) for c in [*ids, "f"])]
    return layout, pa.schema(kinds)


def _sum_words(shards: int, min_count: int):
    """The frequent words of a shard."""
    schema = _frequent(1)[1]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        totals: dict[str, dict[bytes, int]] = {}
        chunks = []
        for row in rows.select(["block", "base", "lang", "keys", "n"]).to_pylist():
            words = row["keys"][0].split(b"\n")
            own = totals.setdefault(row["lang"], {})
            for word, n in zip(words, _unpacked(row["n"]).tolist()):
                own[word] = own.get(word, 0) + n
            chunks.append((row["block"], row["base"], row["lang"], words))
        found = [(-f, lang, w) for lang, own in totals.items() for w, f in own.items() if f >= min_count]
        ids: dict[str, dict[bytes, tuple[int, int]]] = {lang: {} for lang in totals}
        out = [{"lang": lang, "f": sum(own.values())} for lang, own in totals.items()]
        for rank, (f, lang, word) in enumerate(sorted(found)):
            number = rank * shards + key[0].as_py()
            ids[lang][word] = number, -f
            out.append({"lang": lang, "word": word.decode(), "w1": number, "f": -f})
        for block, base, lang, words in chunks:
            known = ids[lang]
            at = [i for i, w in enumerate(words) if w in known]
            if at:
                pairs = np.array([known[words[i]] for i in at], np.int64)
                keys = [_packed(pairs[:, 0])]
                slots = _rising(base + np.array(at))
                out.append({"of": block, "slots": slots, "keys": keys, "counts": _packed(pairs[:, 1])})
        return pa.Table.from_batches([_batch(schema, out)])

    return run


def _sum_phrases(words: int, min_count: int, last: bool):
    """The frequent phrases of a shard; nothing for the blocks after the ``last`` level."""
    schema = _frequent(words)[1]
    names = [f"w{i + 1}" for i in range(words)]

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        chunks = rows.select(["block", "base", "keys", "n"]).to_pylist()
        counts = [_unpacked(c["n"]) for c in chunks]
        n = np.concatenate(counts)
        keys = [
            np.concatenate([(_risen if i == 0 else _unpacked)(c["keys"][i]) for c in chunks])
            for i in range(words)
        ]
        order = np.lexsort(keys[::-1])
        new = np.ones(len(n), bool)
        new[1:] = reduce(np.logical_or, (np.diff(k[order]) != 0 for k in keys))
        starts = np.flatnonzero(new)
        totals = np.add.reduceat(n[order], starts)
        f = np.empty(len(n), np.int64)
        f[order] = np.repeat(totals, np.diff(np.append(starts, len(n))))
        first = order[starts[totals >= min_count]]
        phrases = {c: k[first] for c, k in zip(names, keys)}
        found = [_columns(schema, len(first), f=f[first], **phrases)]
        if not last:
            out, at = [], 0
            for chunk, own in zip(chunks, counts):
                inside = at + np.flatnonzero(f[at : at + len(own)] >= min_count)
                if len(inside):
                    packed = [_rising(keys[0][inside]), *(_packed(k[inside]) for k in keys[1:])]
                    slots = _rising(chunk["base"] + inside - at)
                    row = {"of": chunk["block"], "slots": slots, "keys": packed, "counts": _packed(f[inside])}
                    out.append(row)
                at += len(own)
            found.append(_batch(schema, out))
        return pa.Table.from_batches(found, schema=schema)

    return run


def _columns(schema: pa.Schema, size: int, **columns: np.ndarray) -> pa.RecordBatch:
    arrays = [
        pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type)
        for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _next_level(words: int, shards: int, last: bool):
    """For a block's positions and its frequent phrases of so many words: the phrases of one
    word more, as positions (unless it is the ``last`` level) and counted entries by shard."""

    def run(key: tuple, places: pa.Table, phrases: pa.Table) -> pa.Table:
        block = key[0].as_py()
        if not places.num_rows or not phrases.num_rows:
            return _BLOCK.empty_table()
        positions = _unpacked(places["positions"][0].as_py()) - 1
        parts = phrases.select(["slots", "keys", "counts"]).to_pylist()
        slots = np.concatenate([_risen(p["slots"]) for p in parts])
        f = np.concatenate([_unpacked(p["counts"]) for p in parts])
        rises = words > 1  # ids of single words are in no order
        keys = [
            np.concatenate([(_risen if rises and i == 0 else _unpacked)(p["keys"][i]) for p in parts])
            for i in range(words)
        ]
        # Places in the block's own order of frequency; ties by the words' ids.
        order = np.lexsort((*reversed(keys), -f))
        keys = [k[order] for k in keys]
        rank = np.full(int(max(positions.max(initial=-1), slots.max())) + 2, -1, np.int64)
        rank[slots[order]] = np.arange(len(order))
        ids = rank[positions]  # -1 finds the last entry, which is -1
        at = np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))
        first, second, counts, place = count_pairs(ids[at], ids[at + 1], len(order))
        longer = [*(k[first] for k in keys), keys[-1][second]]
        shard = _shard_of(longer, shards)
        order = np.lexsort((*reversed(longer), shard))
        longer, counts, shard = [k[order] for k in longer], counts[order], shard[order]
        out = []
        if not last:
            slot = np.empty(len(order), np.int64)
            slot[order] = np.arange(len(order))
            new = np.zeros(len(ids), np.int64)
            new[at] = slot[place] + 1
            out.append({"block": block, "positions": _packed(new)})
        numbers, starts = np.unique(shard, return_index=True)
        for number, a, b in zip(numbers.tolist(), starts.tolist(), [*starts[1:].tolist(), len(shard)]):
            packed = [_rising(longer[0][a:b]), *(_packed(k[a:b]) for k in longer[1:])]
            out.append({"block": block, "shard": number, "base": a, "keys": packed, "n": _packed(counts[a:b])})
        return pa.Table.from_batches([_batch(_BLOCK, out)])

    return run


def _shard_of(keys: list[np.ndarray], shards: int) -> np.ndarray:
    """A shard for each phrase, by its ids."""
    mixed = np.zeros(len(keys[0]), np.uint64)
    for k in keys:
        mixed = (mixed ^ k.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(shards)).astype(np.int64)


def count_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (``lang``, ``n``), and for 1, 2, ... words the phrases that occur
    ``min_count`` times or more: ``w1``, ``w2``, ... (ids of words) and ``f``; the first table also
    has ``lang`` and ``word``."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
        F.col(text_col).cast("string").alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))

    def placed(rows: DataFrame, k: int) -> DataFrame:
        return bucketed(rows, "block", f"phrase_blocks_{k}", min(buckets, 100_000), "zstd")

    def summed(blocks: DataFrame, k: int) -> DataFrame:
        entries = blocks.where("shard is not null").groupBy("shard")
        step = _sum_words(shards, min_count) if k == 1 else _sum_phrases(k, min_count, k == max_words)
        return stored(entries.applyInArrow(step, _frequent(k)[0]), f"frequent-{k}")

    blocks = placed(map_arrow(texts, _read_blocks(block_words, shards), BLOCK), 1)
    found = summed(blocks, 1)
    sizes = found.where("of is null and w1 is null").groupBy("lang").agg(F.sum("f").alias("n"))
    levels = [found.where("w1 is not null").select("w1", "lang", "word", "f")]
    for k in range(2, max_words + 1):
        places = blocks.where("positions is not null").select("block", "positions")
        own = found.where("of is not null").select("of", "slots", "keys", "counts")
        step = _next_level(k - 1, shards, k == max_words)
        longer = places.groupBy("block").cogroup(own.groupBy("of")).applyInArrow(step, BLOCK)
        before, blocks = blocks, placed(longer, k)
        discard(before)
        found = summed(blocks, k)
        keys = [f"w{i + 1}" for i in range(k)]
        levels.append(found.where("w1 is not null").select(*keys, "f"))
    discard(blocks)
    return sizes, levels


def _resolved(levels: list[DataFrame]) -> list[DataFrame]:
    """The phrases of two words and more with ``lang``, ``words``, ``f``, and the counts of
    all their beginnings (``pre``) and ends (``suf``), shortest first."""
    one = levels[0].select(
        "w1", "lang", F.array("word").alias("words"), F.array("f").alias("pre"), F.array("f").alias("suf")
    )
    out = [one]
    for k, level in enumerate(levels[1:], 2):
        before = out[-1]
        inner = [f"w{i}" for i in range(1, k)]
        head = before.select(*inner, "lang", "words", "pre")
        tail = before.select(
            *(F.col(c).alias(f"w{i}") for i, c in enumerate(inner, 2)),
            F.element_at("words", -1).alias("end"),
            "suf",
        )
        joined = level.join(head, inner).join(tail, [f"w{i}" for i in range(2, k + 1)])
        out.append(
            joined.select(
                *(f"w{i}" for i in range(1, k + 1)),
                "lang",
                F.concat("words", F.array("end")).alias("words"),
                F.concat("pre", F.array("f")).alias("pre"),
                F.concat("suf", F.array("f")).alias("suf"),
                "f",
            )
        )
    return out[1:]


def _not_covered(shorter: DataFrame, longer: DataFrame, k: int, covered: int) -> DataFrame:
    """The phrases of k words without those that a phrase of one word more covers. Longer
    ones need no look: they occur in one of these, which is as frequent or more."""
    keys = [f"w{i}" for i in range(1, k + 1)]
    ends = longer.select(*(F.col(f"w{i + 1}").alias(f"w{i}") for i in range(1, k + 1)), "f")
    around = longer.select(*keys, "f").unionByName(ends).groupBy(*keys).agg(F.max("f").alias("most"))
    big = "decimal(20,0)"
    covers = F.col("most").cast(big) * 100 >= F.col("f").cast(big) * covered
    joined = shorter.join(around, keys, "left")
    return joined.where(~F.coalesce(covers, F.lit(False))).drop("most")


# The lowest-scoring cut, ties to the shortest first part; whole numbers throughout.
_CUT = """array_min(transform(sequence(1, size(words) - 1), k -> named_struct(
  'score', (cast(f as decimal(20,0)) * cast(2000000 as decimal(7,0)))
    div (cast(pre[k - 1] as decimal(20,0)) + cast(suf[size(words) - k - 1] as decimal(20,0))),
  'k', k, 'l', pre[k - 1], 'r', suf[size(words) - k - 1])))"""


def mine_phrases(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    covered: int = COVERED,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """All collocations: ``lang``, ``phrase``, ``words``, ``cut`` (words before the weakest cut),
    ``a``, ``l``, ``r`` (occurrences of the phrase, its first and its second part), ``n`` (words of
    the language) and ``score``, ``floor(2000000 a / (l + r))`` at that cut.

    Words are runs of anything but blanks and tabs, A-Z lower-cased, within pieces that end at
    punctuation or a line break. Phrases of two to ``max_words`` words count with overlaps. One
    goes if a longer frequent phrase around it has ``covered`` percent of its occurrences.

    Null and blank texts have no words; a null language is ``und``. Repeated rows count each. An
    empty table gives no rows; other columns are not read.
    """
    if max_words < 2:
        raise ValueError("a phrase has two words or more")
    sizes, levels = count_phrases(docs, text_col, lang_col, min_count, max_words, block_words)
    resolved = [stored(level, f"resolved-{k}") for k, level in enumerate(_resolved(levels), 2)]
    kept = []
    for k, level in enumerate(resolved, 2):
        if k < max_words:
            level = _not_covered(level, resolved[k - 1], k, covered)
        kept.append(level.select("lang", "words", "pre", "suf", "f"))
    phrases = reduce(DataFrame.unionByName, kept).withColumn("best", F.expr(_CUT))
    return phrases.join(sizes, "lang").select(
        "lang",
        F.array_join("words", " ").alias("phrase"),
        "words",
        F.col("best.k").alias("cut"),
        F.col("f").alias("a"),
        F.col("best.l").alias("l"),
        F.col("best.r").alias("r"),
        "n",
        F.col("best.score").cast("long").alias("score"),
    )


def top_phrases(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases, by score, then occurrences, then the phrase in
    byte order, with ``rank`` from 1."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # First by parts of a language, so that what meets for one is bounded by parts x top.
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    some = Window.partitionBy("lang", "part").orderBy(*order)
    best = phrases.withColumn("part", part).withColumn("rank", F.row_number().over(some))
    best = best.where(F.col("rank") <= top).drop("part")
    ranked = Window.partitionBy("lang").orderBy(*order)
    return best.withColumn("rank", F.row_number().over(ranked).cast("long")).where(F.col("rank") <= top)
