"""Hard negatives against plain loops over exact integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslake.llm import hard_negatives
from opslake.llm.hard_negatives import mine_hard_negatives, strassen

SCHEMA = "vec_id long, embedding array<float>, label int, score string, tile string, anchor string"


def by_hand(rows, is_anchor, n_positives=5, n_negatives=10):
    seen = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector))
        if row not in seen:
            seen.append(row)
    out = []
    for anchor in (r for r in seen if is_anchor(r[0])):
        def key(r):
            return (-sum(x * y for x, y in zip(anchor[2], r[2])), r[0])

        def first(found, k):
            return sorted(set(found))[:k]

        positives = first([key(r) for r in seen if r[1] == anchor[1] and r[0] != anchor[0]], n_positives)
        others = [key(r) for r in seen if r[1] != anchor[1]]
        for p, pid in positives:
            inside = [(s, i) for s, i in others if 30 * -p <= 100 * -s <= 90 * -p]
            for rank, (s, i) in enumerate(first(inside, n_negatives), 1):
                out.append((anchor[0], pid, rank, i, -p, -s))
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)
    got = mine_hard_negatives(df, F.col("vec_id") % 10 == 0, **options).collect()
    return sorted(map(tuple, got))


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 64, 5), (130, 64, 97), (200, 129, 111), (96, 96, 96), (5, 0, 4)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(3)
    m, k, n = shape
    a, b = rng.integers(-(2**27), 2**27, (m, k)), rng.integers(-(2**27), 2**27, (k, n))
    want = a.astype(object) @ b.astype(object) if k else np.zeros((m, n), object)
    assert (strassen(a, b, leaf=8) == want).all()
    assert (strassen(a, b) == want).all()


def test_equals_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE", 16)  # several tiles of anchors
    rng = random.Random(12)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(6)]
    rows = []
    for i in range(400):
        centre = rng.choice(centres)
        rows.append((i, [x + rng.gauss(0, 0.4) for x in centre], rng.randrange(4)))
    want = by_hand(rows, lambda i: i % 10 == 0)
    assert len(want) > 500
    assert run(spark, rows) == want


def test_awkward_rows(spark):
    rng = random.Random(5)
    hot = [1.0, 0.5, 0.25]
    rows = [(i, hot, i % 3) for i in range(60)]  # ties everywhere
    rows += [(100 + i, [rng.random() for _ in range(rng.randrange(0, 6))], i % 3) for i in range(40)]
    rows += rows[:25]  # repeated rows
    rows += [(10, [0.9, 0.1, 0.2], 0), (10, hot, 2)]  # one id, other vectors and labels
    rows += [(None, hot, 1), (500, None, 1), (510, hot, None), (520, [1.0, None, 0.0], 1)]
    rows += [(530, [float("nan"), 1.0], 1), (540, [float("inf"), 1.0], 1), (550, [], 1)]
    rows += [(600, [0.9, 0.4, 0.2, 0.0, 7.0], 7)]  # alone with its label
    got = run(spark, rows)
    assert got == by_hand(rows, lambda i: i % 10 == 0) != []
    assert run(spark, rows[:0]) == []


def test_windows_at_their_limits(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)]
    rows += [(2 + i, [x, 0.5], 2) for i, x in enumerate((0.25, 0.296875, 0.30078125, 0.5, 0.8984375, 0.90234375, 1.0))]
    got = [(r[3], r[5]) for r in run(spark, rows)]
    assert got == [(r[3], r[5]) for r in by_hand(rows, lambda i: i % 10 == 0)]
    assert [i for i, _ in got] == [6, 5, 4]


def test_scores_beyond_64_bits_are_an_error(spark):
    rows = [(i, [1e16, 1e16], 1) for i in (0, 1)]
    with pytest.raises(Exception, match="64 bits"):
        run(spark, rows)


def test_copies_of_anchors_are_never_broadcast(spark, monkeypatch):
    """The copies for all lanes meet the tiles in a shuffle: on the driver they would be lanes times
    the size that Spark takes them for."""
    plans, real = [], hard_negatives.map_arrow

    def seen(df, fn, schema):
        if "a_vectors" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, fn, schema)

    monkeypatch.setattr(hard_negatives, "map_arrow", seen)
    monkeypatch.setattr(hard_negatives, "TILE", 16)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], i % 3) for i in range(200)]
    assert run(spark, rows) == by_hand(rows, lambda i: i % 10 == 0)
    assert len(plans) == 2
    assert all("SortMergeJoin [lane" in p and "BroadcastExchange" not in p for p in plans)
