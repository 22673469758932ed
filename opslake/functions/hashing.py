"""Deterministic per-row pseudo-random numbers from integer arithmetic.

A draw depends only on (seed, column name, row id), so it is the same for any number of
partitions and after a task retry, and it needs no per-partition state. Every product is
below 2**63, so the arithmetic is exact in any engine with 64-bit integers.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

MODULUS = 2147483647  # 2**31 - 1, prime


def stream_constants(seed: int, column: str) -> tuple[int, int, int, int]:
    """Four multipliers for one random column, each in [1, MODULUS)."""
    parts = (zlib.crc32(f"{seed}/{column}/{i}".encode()) for i in range(4))
    return tuple(p % (MODULUS - 1) + 1 for p in parts)


def draw(row_id: Column, seed: int, column: str) -> Column:
    """Integer in [0, MODULUS) for this row and column; row ids must lie in [0, 2**60)."""
    a, b, c, d = (F.lit(v).cast("bigint") for v in stream_constants(seed, column))
    m = F.lit(MODULUS).cast("bigint")
    low, high = row_id % m, F.shiftright(row_id, 31)
    mixed = (low * a + high * b) % m
    mixed = (mixed * mixed + mixed * c + d) % m
    return (mixed * mixed + mixed * d + a) % m


def uniform(row_id: Column, seed: int, column: str) -> Column:
    """Double in [0, 1)."""
    return draw(row_id, seed, column) / F.lit(float(MODULUS))


def randint(row_id: Column, seed: int, column: str, low: int, high: int) -> Column:
    """Integer between ``low`` and ``high``, both included."""
    return draw(row_id, seed, column) % F.lit(high - low + 1) + F.lit(low)


def choice(row_id: Column, seed: int, column: str, values: list) -> Column:
    """One of ``values`` with equal weight."""
    index = (draw(row_id, seed, column) % F.lit(len(values)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), index)


def weighted(row_id: Column, seed: int, column: str, weights: dict) -> Column:
    """One of the keys of ``weights``; the weights are integers out of their sum."""
    total = sum(weights.values())
    slot = draw(row_id, seed, column) % F.lit(total)
    picked, upper = None, 0
    for value, weight in list(weights.items())[:-1]:
        upper += weight
        hit = slot < upper
        picked = F.when(hit, F.lit(value)) if picked is None else picked.when(hit, F.lit(value))
    return picked.otherwise(F.lit(list(weights)[-1]))
