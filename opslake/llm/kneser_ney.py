"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from files.

Counting takes two jobs. The first counts tokens by hash; the place of a hash in the sorted
array of all hashes is the token's id. The second counts pairs of ids. Both combine within
the task, then shuffle packed arrays by shard; the task of a shard writes sorted arrays to
the shared folder: hashes and counts of tokens, hashes and counts of pairs, totals and
numbers of followers of contexts, numbers of predecessors of tokens. Scoring tasks map these
files into memory and look up sorted batches of hashes, so no task and no driver holds the
model; what the driver gets is a few numbers per shard.

Shards follow the context's hash. A context that alone would exceed a shard is spread over
all shards by the pair's hash; its parts are added up from one row per shard.

A shard's content does not depend on the order of its input and is put in place by renaming,
so a repeated task rewrites what is there. Tokens are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import map_arrow
from opslake.session import scratch_path

# Text bytes that one shard stands for.
SHARD_BYTES = 16 << 20
MIN_SHARDS = 8
# Tokens combined at once by a task, text bytes split at once.
BLOCK_TOKENS = 3_000_000
PIECE_BYTES = 4 << 20
CACHE = 400_000
# Commonest tokens reported per shard, among which the hot contexts are found.
TOP = 16

U64 = np.uint64
# Neither can be a word: both hold a blank.
END = xxhash.xxh64_intdigest(b" end")


class _Hashes(dict):
    """Hash of a word, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= CACHE:
            self.clear()
        self[word] = value
        return value


def pieces(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with bounded text; a longer text is a slice of its own."""
    sizes = [len(t.as_buffer() or b"") if t.is_valid else 0 for t in batch.column(column)]
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > PIECE_BYTES:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield batch.slice(start)


def token_hashes(texts: pa.Array, cache: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens of the texts, each text with its end, and tokens per text.

    Words are runs of anything but ASCII blanks, A-Z lower-cased; null counts as empty.
    """
    parts, lengths = [], []
    for text in texts:
        value = text.as_py()
        words = value.encode().lower().split() if value else []
        hashes = np.empty(len(words) + 1, U64)
        hashes[:-1] = np.fromiter(map(cache.__getitem__, words), U64, len(words))
        hashes[-1] = END
        parts.append(hashes)
        lengths.append(len(hashes))
    return np.concatenate(parts) if parts else np.empty(0, U64), np.array(lengths, np.int64)


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hash of two ids."""
    x = left.astype(U64) * U64(0x9E3779B97F4A7C15) + right.astype(U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Discounts for counts 1, 2 and 3 or more from the numbers of counts 1 to 4; where
    these are too small to estimate from, one half."""
    if min(n) <= 0:
        return 0.5, 0.5, 0.5
    y = n[0] / (n[0] + 2 * n[1])
    found = (k + 1 - (k + 2) * y * n[k + 1] / n[k] for k in range(3))
    return tuple(d if 0 < d < k + 1 else 0.5 for k, d in enumerate(found))


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3).astype(np.int64)]


@dataclass
class Store:
    """Arrays by family and shard, in a folder of the shared store."""

    base: str
    opened: dict = field(default_factory=dict)

    def _fs(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(
            f"file://{self.base}" if self.base.startswith("/") else self.base
        )

    def write(self, family: str, shard: int, values: np.ndarray) -> None:
        store, base = self._fs()
        folder = f"{base.rstrip('/')}/{family}"
        store.create_dir(folder, recursive=True)
        draft = f"{folder}/.{shard}-{uuid.uuid4().hex}"
        with store.open_output_stream(draft, compression=None) as out:
            out.write(np.ascontiguousarray(values))
        store.move(draft, f"{folder}/{shard}")

    def read(self, family: str, shard: int, kind: type) -> np.ndarray:
        """The array, mapped into memory; empty where the shard has none."""
        key = family, shard
        if key not in self.opened:
            if len(self.opened) >= 4096:
                self.opened.clear()
            self.opened[key] = self._map(f"{family}/{shard}", kind)
        return self.opened[key]

    def _map(self, name: str, kind: type) -> np.ndarray:
        store, base = self._fs()
        path = f"{base.rstrip('/')}/{name}"
        found = store.get_file_info(path)
        if found.type == fs.FileType.NotFound or not found.size:
            return np.empty(0, kind)
        if isinstance(store, fs.LocalFileSystem):
            return np.memmap(path, kind, "r")
        # A store that can't be mapped: the shard is read when it is needed.
        with store.open_input_file(path) as file:
            return np.frombuffer(file.read_buffer(), kind)


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    if not len(sorted_values):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1])))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = _runs(keys)
    return keys[starts], np.add.reduceat(counts, starts) if len(starts) else counts


def _buffer(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """All arrays packed in a binary column, one after the other."""
    parts = [np.frombuffer(v.as_buffer(), kind) for v in column if v.is_valid and len(v.as_buffer())]
    return np.concatenate(parts) if parts else np.empty(0, kind)


def _packed(shards: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple[int, list[bytes]]]:
    """Columns sorted by shard, cut into one set of arrays per shard."""
    starts = _runs(shards)
    for start, end in zip(starts, [*starts[1:], len(shards)]):
        yield int(shards[start]), [c[start:end].tobytes() for c in columns]


STATS = "shard int, kind string, key long, a long, b long, c long, d long, e long, tokens binary, counts binary"
STATS_SCHEMA = pa.schema(
    [
        ("shard", pa.int32()),
        ("kind", pa.string()),
        *((n, pa.int64()) for n in ("key", "a", "b", "c", "d", "e")),
        ("tokens", pa.binary()),
        ("counts", pa.binary()),
    ]
)


def _count_tokens(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, held, size = _Hashes(), [], 0

        def flush() -> pa.RecordBatch:
            tokens, counts = np.unique(np.concatenate(held), return_counts=True)
            rows = list(_packed(tokens >> U64(64 - bits), [tokens, counts.astype(np.uint32)]))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1][0] for r in rows], pa.binary()),
                    pa.array([r[1][1] for r in rows], pa.binary()),
                ],
                names=["shard", "tokens", "counts"],
            )

        for batch in batches:
            for part in pieces(batch, "text"):
                found, _ = token_hashes(part.column("text"), cache)
                held.append(found)
                size += len(found)
                if size >= BLOCK_TOKENS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


def _merge_tokens(base: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = int(key[0].as_py())
        tokens = _buffer(table["tokens"], U64)
        counts = _buffer(table["counts"], np.uint32).astype(np.int64)
        tokens, counts = _summed(tokens, counts)
        store = Store(base)
        store.write("token", shard, tokens)
        store.write("token-count", shard, counts)
        top = np.argsort(-counts, kind="stable")[:TOP]
        rows = [{"kind": "shard", "a": len(tokens), "b": int(counts.sum())}]
        rows += [{"kind": "top", "key": int(i), "a": int(counts[i])} for i in top]
        return pa.Table.from_pylist([{"shard": shard, **r} for r in rows], schema=STATS_SCHEMA)

    return run


@dataclass
class Model:
    """What the tasks need besides the files."""

    base: str
    bits: int
    first_ids: np.ndarray
    train_tokens: int
    types: int
    hot: np.ndarray
    pair_discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)
    token_discounts: tuple[float, float, float] = (0.5, 0.5, 0.5)
    pairs: int = 0
    lower_rest: float = 1.0
    hot_stats: np.ndarray | None = None

    @property
    def start(self) -> int:
        """Id of the context before the first word."""
        return self.types

    @property
    def unknown(self) -> int:
        return self.types + 1

    @property
    def id_kind(self) -> type:
        return np.uint32 if self.types < 2**32 - 2 else np.uint64

    def shard_of(self, ids: np.ndarray) -> np.ndarray:
        return np.minimum(
            np.searchsorted(self.first_ids, ids, side="right") - 1, (1 << self.bits) - 1
        )

    def pair_shard(self, prev: np.ndarray, pair: np.ndarray) -> np.ndarray:
        shards = self.shard_of(prev)
        if len(self.hot):
            spread = np.isin(prev, self.hot)
            shards[spread] = (pair[spread] >> U64(64 - self.bits)).astype(shards.dtype)
        return shards

    def ids(self, hashes: np.ndarray, store: Store) -> np.ndarray:
        """Ids of token hashes; ``unknown`` for those not in training."""
        keys, back = np.unique(hashes, return_inverse=True)
        out = np.full(len(keys), self.unknown, np.int64)
        shards = (keys >> U64(64 - self.bits)).astype(np.int64)
        starts = _runs(shards)
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            shard = int(shards[start])
            known = store.read("token", shard, U64)
            at = np.searchsorted(known, keys[start:end])
            hit = np.flatnonzero(at < len(known))
            hit = hit[known[at[hit]] == keys[start:end][hit]]
            out[start:end][hit] = self.first_ids[shard] + at[hit]
        return out[back]

    def gather(self, family: str, ids: np.ndarray, kind: type, store: Store) -> np.ndarray:
        """Values of sorted ids from a family with one value per id; 0 without one."""
        out = np.zeros(len(ids), kind)
        shards = self.shard_of(ids)
        starts = _runs(shards)
        for start, end in zip(starts, [*starts[1:], len(ids)]):
            shard = int(shards[start])
            values = store.read(family, shard, kind)
            at = ids[start:end] - self.first_ids[shard]
            hit = np.flatnonzero(at < len(values))
            out[start:end][hit] = values[at[hit]]
        return out


def _bigrams(model: Model):
    """Pairs of a task as packed arrays per shard: contexts as runs, tokens, counts."""
    kind = model.id_kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, store = _Hashes(), Store(model.base)
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            prev, token = (np.concatenate(p) for p in zip(*held))
            pair, first, counts = np.unique(mix(prev, token), return_index=True, return_counts=True)
            prev, token = prev[first], token[first]
            shards = model.pair_shard(prev, pair)
            order = np.lexsort((token, prev, shards))
            shards, prev, token, counts = (x[order] for x in (shards, prev, token, counts))
            rows = []
            starts = _runs(shards)
            for start, end in zip(starts, [*starts[1:], len(shards)]):
                own = prev[start:end]
                runs = _runs(own)
                lengths = np.diff([*runs, len(own)])
                rows.append(
                    (
                        int(shards[start]),
                        own[runs].astype(kind).tobytes(),
                        lengths.astype(np.uint32).tobytes(),
                        token[start:end].astype(kind).tobytes(),
                        counts[start:end].astype(np.uint32).tobytes(),
                    )
                )
            kinds = (pa.int32(), *[pa.binary()] * 4)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                names=["shard", "prevs", "runs", "tokens", "counts"],
            )

        for batch in batches:
            for part in pieces(batch, "text"):
                hashes, lengths = token_hashes(part.column("text"), cache)
                ids = model.ids(hashes, store)
                prev = np.concatenate(([model.start], ids[:-1]))
                prev[np.cumsum(lengths[:-1])] = model.start
                held.append((prev, ids))
                size += len(ids)
                if size >= BLOCK_TOKENS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


def _merge_bigrams(model: Model):
    """Write pairs and contexts of a shard; pass on numbers of predecessors by token."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = int(key[0].as_py())
        runs = _buffer(table["runs"], np.uint32)
        prev = np.repeat(_buffer(table["prevs"], model.id_kind), runs).astype(np.int64)
        token = _buffer(table["tokens"], model.id_kind).astype(np.int64)
        counts = _buffer(table["counts"], np.uint32).astype(np.int64)
        pair = mix(prev, token)
        order = np.argsort(pair, kind="stable")
        pair, counts, prev, token = pair[order], counts[order], prev[order], token[order]
        starts = _runs(pair)
        pair, counts = pair[starts], np.add.reduceat(counts, starts)
        prev, token = prev[starts], token[starts]
        store = Store(model.base)
        store.write("pair", shard, pair)
        store.write("pair-count", shard, counts.astype(np.float32))
        rows = [
            {"kind": "pairs", "key": 0, "e": len(pair)}
            | {n: int((counts == k).sum()) for k, n in enumerate("abcd", 1)}
        ]
        # Contexts: total, and followers seen once, twice and more often.
        order = np.argsort(prev, kind="stable")
        own, seen = prev[order], counts[order]
        heads = _runs(own)
        ids = own[heads]
        if len(ids):
            parts = [seen, seen == 1, seen == 2, seen >= 3]
            stats = np.stack([np.add.reduceat(p.astype(np.int64), heads) for p in parts], axis=1)
        else:
            stats = np.zeros((0, 4), np.int64)
        spread = np.isin(ids, model.hot)
        rows += [
            {"kind": "hot", "key": int(i), "a": int(s[0]), "b": int(s[1]), "c": int(s[2]), "d": int(s[3])}
            for i, s in zip(ids[spread], stats[spread])
        ]
        low = int(model.first_ids[shard])
        high = int(model.first_ids[shard + 1]) + (shard == (1 << model.bits) - 1)
        dense = np.zeros((high - low, 4), np.int64)
        dense[ids[~spread] - low] = stats[~spread]
        for number, name in enumerate(("total", "once", "twice", "more")):
            store.write(f"context-{name}", shard, dense[:, number])
        rows = [{"shard": -1 - shard, **r} for r in rows]
        # Distinct predecessors of each token in this shard; pairs are distinct already.
        order = np.argsort(token, kind="stable")
        tokens, n = _summed(token[order], np.ones(len(token), np.int64))
        packed = _packed(
            model.shard_of(tokens), [tokens.astype(model.id_kind), n.astype(np.uint32)]
        )
        rows += [
            {"shard": s, "kind": "before", "tokens": own[0], "counts": own[1]} for s, own in packed
        ]
        return pa.Table.from_pylist(rows, schema=STATS_SCHEMA)

    return run


def _merge_before(model: Model):
    """Write numbers of predecessors; numbers of pairs and hot contexts pass through."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = int(key[0].as_py())
        if shard < 0:
            return table
        tokens = _buffer(table["tokens"], model.id_kind).astype(np.int64)
        tokens, n = _summed(tokens, _buffer(table["counts"], np.uint32).astype(np.int64))
        low, high = int(model.first_ids[shard]), int(model.first_ids[shard + 1])
        dense = np.zeros(high - low, np.int64)
        dense[tokens - low] = n
        Store(model.base).write("before", shard, dense)
        row = {"shard": shard, "kind": "tokens", "key": 0}
        row |= {c: int((n == k).sum()) for k, c in enumerate("abcd", 1)}
        row["e"] = int((n >= 3).sum())
        return pa.Table.from_pylist([row], schema=STATS_SCHEMA)

    return run


def train(training: DataFrame, text_col: str = "text") -> Model:
    """Count all rows of ``training`` and write the model to the shared folder.

    Null texts count as empty: their end alone is a token. Without rows the model knows
    nothing and every token gets the uniform probability of an unknown one.
    """
    spark = training.sparkSession
    texts = training.select(F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(MIN_SHARDS, size / SHARD_BYTES)
    bits = math.ceil(math.log2(shards))
    shards = 1 << bits
    base = scratch_path(spark, "language-model")

    counted = map_arrow(texts, _count_tokens(bits), "shard int, tokens binary, counts binary")
    rows = counted.groupBy("shard").applyInArrow(_merge_tokens(base), STATS).collect()
    sizes = np.zeros(shards, np.int64)
    for r in rows:
        if r["kind"] == "shard":
            sizes[r["shard"]] = r["a"]
    first_ids = np.concatenate(([0], np.cumsum(sizes)))
    total = sum(r["b"] for r in rows if r["kind"] == "shard")
    share = 2 * total / shards
    hot = [first_ids[r["shard"]] + r["key"] for r in rows if r["kind"] == "top" and r["a"] > share]
    # The context before the first word may be as common as the end.
    hot.append(int(first_ids[-1]))
    model = Model(base, bits, first_ids, total, int(first_ids[-1]), np.array(sorted(hot), np.int64))

    pairs = map_arrow(
        texts, _bigrams(model), "shard int, prevs binary, runs binary, tokens binary, counts binary"
    )
    merged = pairs.groupBy("shard").applyInArrow(_merge_bigrams(model), STATS)
    merged = merged.groupBy("shard").applyInArrow(_merge_before(model), STATS)
    sums = merged.groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in "abcde"]).collect()
    by_kind = {(r["kind"], r["key"]): r for r in sums}
    empty = dict.fromkeys("abcde", 0)
    seen, before = by_kind.get(("pairs", 0), empty), by_kind.get(("tokens", 0), empty)
    model.pairs = seen["e"]
    model.pair_discounts = discounts([seen[c] for c in "abcd"])
    model.token_discounts = discounts([before[c] for c in "abcd"])
    if model.pairs:
        d = model.token_discounts
        model.lower_rest = (d[0] * before["a"] + d[1] * before["b"] + d[2] * before["e"]) / model.pairs
    stats = [by_kind.get(("hot", int(i)), empty) for i in model.hot]
    model.hot_stats = np.array([[r[c] for c in "abcd"] for r in stats], np.int64).reshape(-1, 4)
    return model


class Scorer:
    """Scores of texts, from the files of a model."""

    def __init__(self, model: Model):
        self.model, self.store = model, Store(model.base)

    def lower(self, ids: np.ndarray) -> np.ndarray:
        """Probability of sorted ids by their numbers of predecessors."""
        m = self.model
        uniform = 1.0 / (m.types + 1)
        if not m.pairs:
            return np.full(len(ids), uniform)
        before = m.gather("before", ids, np.int64, self.store).astype(float)
        own = np.maximum(before - _discount(before, m.token_discounts), 0) / m.pairs
        return own + m.lower_rest * uniform

    def contexts(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Total count and mass left for the lower order, of sorted context ids."""
        m = self.model
        stats = [
            m.gather(f"context-{n}", ids, np.int64, self.store)
            for n in ("total", "once", "twice", "more")
        ]
        if len(m.hot):
            at = np.minimum(np.searchsorted(m.hot, ids), len(m.hot) - 1)
            spread = m.hot[at] == ids
            for number in range(4):
                stats[number][spread] = m.hot_stats[at[spread], number]
        total = stats[0].astype(float)
        d = m.pair_discounts
        left = d[0] * stats[1] + d[1] * stats[2] + d[2] * stats[3]
        return total, np.divide(left, total, out=np.ones(len(ids)), where=total > 0)

    def pair_counts(self, prev: np.ndarray, token: np.ndarray) -> np.ndarray:
        m = self.model
        pair, first, back = np.unique(mix(prev, token), return_index=True, return_inverse=True)
        shards = m.pair_shard(prev[first], pair)
        out = np.zeros(len(pair))
        order = np.argsort(shards, kind="stable")
        starts = _runs(shards[order])
        for start, end in zip(starts, [*starts[1:], len(pair)]):
            own = order[start:end]
            shard = int(shards[own[0]])
            known = self.store.read("pair", shard, U64)
            at = np.searchsorted(known, pair[own])
            hit = np.flatnonzero(at < len(known))
            hit = hit[known[at[hit]] == pair[own][hit]]
            out[own[hit]] = self.store.read("pair-count", shard, np.float32)[at[hit]]
        return out[back]

    def score(self, texts: pa.Array, cache: _Hashes) -> tuple[np.ndarray, ...]:
        """Tokens, known tokens, base score and score of each text."""
        m = self.model
        hashes, lengths = token_hashes(texts, cache)
        ids = m.ids(hashes, self.store)
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        prev = np.concatenate(([m.start], ids[:-1]))
        prev[starts] = m.start
        unique, back = np.unique(ids, return_inverse=True)
        counts = m.gather("token-count", unique, np.int64, self.store)
        base = np.log10((counts + 1) / (m.train_tokens + m.types + 1))[back]
        lower = self.lower(unique)[back]
        heads, at = np.unique(prev, return_inverse=True)
        total, left = self.contexts(heads)
        total, left = total[at], left[at]
        seen = self.pair_counts(prev, ids)
        over = np.maximum(seen - _discount(seen, m.pair_discounts), 0)
        upper = np.divide(over, total, out=np.zeros(len(ids)), where=total > 0)
        logs = np.log10(upper + left * lower)
        known = (ids != m.unknown).astype(np.int64)
        return lengths, *(np.add.reduceat(x, starts) for x in (known, base, logs))


def score_documents(
    docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Per row of ``docs`` the kept columns, ``n_tokens``, ``n_known``, ``base_score`` (add-one
    unigram) and ``score`` (the model), both log10 probabilities of the whole text.

    A null, empty or blank text is its end alone. Repeated rows score alike; an empty table
    gives no rows. Divide the score by -n_tokens for the log10 perplexity.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, cache = Scorer(model), _Hashes()
        for batch in batches:
            for part in pieces(batch, "__text"):
                n, known, base, score = scorer.score(part.column("__text"), cache)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), *map(pa.array, (n, known, base, score))],
                    names=[*keep, "n_tokens", "n_known", "base_score", "score"],
                )

    texts = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in texts.drop("__text").dtypes)
    out = f"{kinds}, n_tokens long, n_known long, base_score double, score double"
    return map_arrow(texts, run, out)
