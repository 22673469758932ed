"""Byte-level BPE over a global shuffle of distinct words.

A task splits its texts into pre-tokens and numbers the distinct ones of a block of bounded
size; the block keeps every text as the positions' word numbers and sends each distinct word
once to the word's shard. There the words of all blocks meet, each distinct word is encoded
once, and its ids go back to the blocks that asked. A block joins them to its positions and
so puts every text together in order. Decoding joins ids to the bytes of the tokens.

What is shuffled are packed, compressed arrays: the words of a block and shard, and their
ids. The word numbers of texts are written bucketed by block, so they are joined where they
lie. A frequent word counts once per block, however often it
occurs, so no shard and no block grows with it.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from opslake.llm.common import bucketed, map_arrow
from opslake.llm.kneser_ney import pieces

# Bounds of a block: distinct words, and bytes of text.
BLOCK_WORDS = 200_000
BLOCK_BYTES = 16 << 20
# Text bytes that one shard of words stands for.
SHARD_BYTES = 32 << 20
MIN_SHARDS = 8


def read_ranks(path: str) -> bytes:
    """A rank file, read on the driver; vocabularies are of fixed size."""
    with open(path, "rb") as file:
        return file.read()


def _ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, content.splitlines())}


class Splitter:
    """Matches of the split pattern; ASCII texts take an equal, faster pattern."""

    def __init__(self, pattern: str):
        self.any = regex.compile(pattern)
        plain = pattern.replace(r"[^\s\p{L}\p{N}]", r"[^\sA-Za-z0-9]")
        plain = plain.replace(r"\p{L}", "[A-Za-z]").replace(r"\p{N}", "[0-9]")
        self.ascii = re.compile(plain, re.ASCII) if r"\p" not in plain else self.any

    def __call__(self, text: str) -> list[str]:
        return (self.ascii if text.isascii() else self.any).findall(text)


class _Numbers(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: str) -> int:
        value = self[word] = len(self)
        return value


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pack_numbers(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte by byte of their places, which compresses better."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpack(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _pack_words(words: Sequence[bytes]) -> bytes:
    lengths = np.array([len(w) for w in words], np.uint32)
    return _pack(np.uint32(len(words)).tobytes() + lengths.tobytes() + b"".join(words))


def _unpack_words(data: bytes) -> list[bytes]:
    raw = _unpack(data)
    count = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = np.cumsum(np.frombuffer(raw, np.uint32, count, 4), dtype=np.int64) + 4 + 4 * count
    starts = [4 + 4 * count, *ends[:-1].tolist()]
    return [raw[a:b] for a, b in zip(starts, ends.tolist())]


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start+1, ... of every (start, length), one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _split_blocks(pattern: str, shards: int, keep: Sequence[str], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, numbers, size, made = Splitter(pattern), _Numbers(), 0, 0
        task = TaskContext.get().partitionId() << 24

        def row(**values) -> dict:
            return {"block": task + made, **values}

        def close() -> Iterator[pa.RecordBatch]:
            by_shard: dict[int, list[tuple[bytes, int]]] = {}
            for word, number in numbers.items():
                data = word.encode()
                by_shard.setdefault(xxhash.xxh64_intdigest(data) % shards, []).append((data, number))
            for shard, words in by_shard.items():
                words.sort()
                own = row(
                    shard=shard,
                    words=_pack_words([w for w, _ in words]),
                    numbers=_pack_numbers(np.array([n for _, n in words], np.uint32)),
                )
                yield pa.RecordBatch.from_pylist([own], schema=schema)

        for batch in batches:
            for part in pieces(batch, "__text"):
                texts = part.column("__text").to_pylist()
                codes = [
                    np.fromiter(map(numbers.__getitem__, split(t)), np.uint32) if t else
                    np.empty(0, np.uint32)
                    for t in texts
                ]
                lengths = np.array([len(c) for c in codes], np.uint32)
                own = row(
                    lengths=lengths.tobytes(),
                    codes=_pack_numbers(np.concatenate(codes)),
                    **{c: part.column(c).to_pylist() for c in keep},
                )
                yield pa.RecordBatch.from_pylist([own], schema=schema)
                size += sum(map(len, filter(None, texts)))
                if size >= BLOCK_BYTES or len(numbers) >= BLOCK_WORDS:
                    yield from close()
                    numbers, size, made = _Numbers(), 0, made + 1
        yield from close()

    return run


def _encode_shard(ranks, pattern: str):
    """Encode every distinct word of a shard once, for all blocks."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        coder = tiktoken.Encoding(
            "own", pat_str=pattern, mergeable_ranks=_ranks(ranks.value), special_tokens={}
        )
        known: dict[bytes, np.ndarray] = {}
        ids, lengths = [], []
        for packed in table["words"]:
            found = []
            for word in _unpack_words(packed.as_py()):
                own = known.get(word)
                if own is None:
                    own = known[word] = np.array(coder._encode_single_piece(word), np.uint32)
                found.append(own)
            lengths.append(_pack_numbers(np.array([len(f) for f in found], np.uint32)))
            ids.append(_pack_numbers(np.concatenate(found)))
        return pa.table(
            {
                "block": table["block"],
                "numbers": table["numbers"],
                "sizes": pa.array(lengths, pa.binary()),
                "ids": pa.array(ids, pa.binary()),
            }
        )

    return run


def _decoder(ranks) -> Callable[[bytes], bytes]:
    """Joins ids to the bytes of their tokens."""
    token_bytes = {number: token for token, number in _ranks(ranks.value).items()}
    return lambda ids: b"".join(map(token_bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _assemble(keep: Sequence[str], schema: pa.Schema, ranks):
    """Join the ids of a block's words to the positions of its texts; with ``ranks``, join the
    ids of the texts to the bytes of their tokens as well."""

    def run(key: tuple, texts: pa.Table, words: pa.Table) -> Iterator[pa.RecordBatch]:
        numbers, sizes, ids = (
            np.concatenate(
                [_unpack_numbers(v.as_py()) for v in words[c]]
                or [np.empty(0, np.uint32)]
            )
            for c in ("numbers", "sizes", "ids")
        )
        size = np.zeros(len(numbers), np.int64)
        start = np.zeros(len(numbers), np.int64)
        size[numbers] = sizes
        start[numbers] = np.cumsum(sizes, dtype=np.int64) - sizes
        decoded = _decoder(ranks) if ranks is not None else None
        out = []
        for row in texts.to_batches():
            for i in range(row.num_rows):
                lengths = np.frombuffer(row.column("lengths")[i].as_py(), np.uint32)
                codes = _unpack_numbers(row.column("codes")[i].as_py())
                flat = ids[_ragged(start[codes], size[codes])]
                # Tokens before each text: of the words up to its end, less those before.
                words_before = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
                tokens = np.concatenate(([0], np.cumsum(size[codes])))[words_before]
                data = [
                    flat[a:b].astype("<u4").tobytes() for a, b in zip(tokens[:-1], tokens[1:])
                ]
                columns = [
                    *(row.column(c)[i].values for c in keep),
                    pa.array(np.diff(tokens), pa.int64()),
                    pa.array(data, pa.binary()),
                ]
                if decoded is not None:
                    columns.append(pa.array(map(decoded, data), pa.binary()))
                out.append(pa.RecordBatch.from_arrays(columns, schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    return run


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text_col: str = "text",
    keep: Sequence[str] = ("doc_id",),
    with_decoded: bool = False,
) -> DataFrame:
    """Per row of ``docs`` the kept columns, ``n_tokens`` and ``ids``: the token ids as
    little-endian unsigned 32-bit integers, as if each match of the pattern were encoded by
    itself, without special tokens. ``with_decoded`` adds ``decoded``, as ``decode`` does.

    Null and empty texts have no tokens. Repeated rows are encoded alike, each for itself;
    an empty table gives no rows. A text is never split over blocks.
    """
    spark = docs.sparkSession
    texts = docs.select(*keep, F.col(text_col).cast("string").alias("__text"))
    kinds = dict(texts.dtypes)
    size = texts.agg(F.sum(F.octet_length("__text"))).first()[0] or 0
    shards = max(MIN_SHARDS, -(-size // SHARD_BYTES))
    lists = ", ".join(f"`{c}` array<{kinds[c]}>" for c in keep)
    layout = (
        f"block long, lengths binary, codes binary, {lists}, "
        "shard int, words binary, numbers binary"
    )
    arrow = to_arrow_schema(StructType.fromDDL(layout))
    split = map_arrow(texts, _split_blocks(pattern, shards, keep, arrow), layout)
    blocks = bucketed(split, "block", "bpe_blocks")
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    words = blocks.where("shard is not null").select("block", "shard", "words", "numbers")
    coded = words.groupBy("shard").applyInArrow(
        _encode_shard(ranks, pattern), "block long, numbers binary, sizes binary, ids binary"
    )
    places = blocks.where("shard is null").select("block", "lengths", "codes", *keep)
    out = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", n_tokens long, ids binary"
    if with_decoded:
        out += ", decoded binary"
    result = to_arrow_schema(StructType.fromDDL(out))
    return places.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(
        _assemble(keep, result, ranks if with_decoded else None), out
    )


def decode(coded: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``coded`` with ``decoded``: the bytes of its tokens, joined from the token table. An
    id outside the table is an error; null ids decode to no bytes."""
    spark = coded.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    names = coded.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        join = _decoder(ranks)
        for batch in batches:
            data = [join(ids.as_py() or b"") for ids in batch.column(ids_col)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(data, pa.binary())], names=[*names, "decoded"]
            )

    kinds = ", ".join(f"`{c}` {t}" for c, t in coded.dtypes)
    return map_arrow(coded, run, f"{kinds}, decoded binary")
