"""Decontamination, SimHash and repeated passages against brute force."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from opslake.llm import decontaminate, simhash, substring_dedup
from opslake.llm.components import connected_components

BENCHMARK = [
    (1, " ".join(f"word{i}" for i in range(5, 25))),
    (2, "alpha beta GAMMA"),
    (3, None),
    (4, ""),
    (None, "second line"),
    (2, "alpha beta GAMMA"),
    (5, "second line"),
    (6, "text"),
]


def hits_by_hand(text, items, width=10):
    words = decontaminate.words_of(text)
    hit, found = set(), set()
    for item, body in items:
        own = decontaminate.words_of(body)
        for window in decontaminate.windows_of(own, width) if item is not None else ():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_hits_equal_brute_force(spark, awkward, block_bytes):
    docs = awkward.where("doc_id is null or doc_id <> 7")
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    got = decontaminate.benchmark_hits(docs, items, block_bytes=block_bytes)
    got = got.withColumn("n_hit", decontaminate.hit_words(got.spans))
    found = [(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in got.collect()]
    want = []
    for r in docs.select("doc_id", "text").collect():
        n, hit, ids = hits_by_hand(r.text, BENCHMARK)
        want.append((r.doc_id, n, hit, tuple(ids)))
    assert Counter(found) == Counter(want)


def test_hits_of_nothing(spark, awkward, no_docs):
    items = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    assert decontaminate.benchmark_hits(no_docs, items).count() == 0
    none = decontaminate.benchmark_hits(awkward, items.limit(0)).collect()
    assert len(none) == 14 and not any(r["items"] for r in none)


@given(st.lists(st.sampled_from("abc"), max_size=60), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), max_size=6))
@settings(deadline=None, max_examples=200)
def test_shift_tables_skip_no_occurrence(text, patterns):
    words = [w.encode() for w in text]
    windows = {tuple(w.encode() for w in p): [i] for i, p in enumerate(patterns)}
    spans, found = decontaminate.Searcher(windows).hits(words)
    hit = {i for a, b in spans for i in range(a, b)}
    want, items = set(), set()
    for window, ids in windows.items():
        for i in range(len(words) - len(window) + 1):
            if tuple(words[i : i + len(window)]) == window:
                want |= set(range(i, i + len(window)))
                items |= set(ids)
    assert hit == want and found == sorted(items)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints(awkward):
    for r in awkward.select("text").collect():
        assert simhash.fingerprint(r.text) == plain_fingerprint(r.text)


def components_by_hand(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("hot", [256, 3])
def test_all_close_fingerprints_are_linked(spark, hot):
    rng = random.Random(hot)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base[:20]:
        for _ in range(30):
            x = b
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    got = {tuple(r) for r in simhash.fingerprint_links(df, hot).collect()}
    mask = (1 << 64) - 1
    want = {
        (a, b)
        for a in signed
        for b in signed
        if a < b and ((a ^ b) & mask).bit_count() <= 2
    }
    assert got == want and want


def test_simhash_groups(awkward, no_docs):
    rows = simhash.simhash_groups(awkward).collect()
    assert len(rows) == 14
    ids = defaultdict(set)
    for r in awkward.select("doc_id", "text").collect():
        ids[plain_fingerprint(r.text)].add(r.doc_id)
    fps = list(ids)
    links = [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2]
    root = components_by_hand(fps, links)
    least = defaultdict(list)
    for fp in fps:
        least[root[fp]] += [i for i in ids[fp] if i is not None]
    for r in rows:
        assert r.component_id == min(least[root[r.fp & (1 << 64) - 1]], default=None)
    assert simhash.simhash_groups(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(400, 440)] + [(500, 500)]
    df = spark.createDataFrame(links, "src long, dst long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    want = components_by_hand(nodes, [(a, b) for a, b in links if a != b])
    assert got == want
    assert connected_components(df.limit(0)).count() == 0


def test_compact_windows_cover_every_passage_once():
    rng = np.random.default_rng(1)
    values = rng.permutation(40).astype(np.uint64)
    width = 6
    windows = substring_dedup.compact_windows(values, width)
    for i in range(40):
        for j in range(i + width - 1, 40):
            own = [c for left, c, right in windows if left <= i <= c <= j <= right]
            assert own == [i + int(values[i : j + 1].argmin())]


def test_repeated_passages(spark, awkward, no_docs):
    got = {}
    for r in substring_dedup.substring_dedup(awkward).collect():
        got.setdefault(r.doc_id, r)
    assert got[8].repeated and got[9].repeated and got[8].class_id == got[9].class_id == 8
    assert got[8].spans == [[1, 73]] or got[8].spans == [[2, 72]] or got[8].n_links == 1
    assert got[6].class_id == got[7].class_id == 6
    for i in (1, 2, 3, 4, 5, 11):
        assert not got[i].repeated and got[i].spans == [] and got[i].class_id == i
    assert substring_dedup.substring_dedup(no_docs).count() == 0


def test_near_duplicate_passages_in_hot_groups(spark):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(80)]
    rows = []
    for i in range(60):
        own = list(passage)
        if i % 3 == 1:
            own[rng.randrange(5, 75)] = "changed"
        noise = [f"n{i}x{j}" for j in range(100)]
        rows.append((i, " ".join(noise[:50] + own + noise[50:])))
    rows += [(100 + i, " ".join(f"z{i}y{j}" for j in range(150))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup.substring_dedup(docs).collect()}
    assert all(got[i].class_id == 0 and got[i].repeated for i in range(60))
    assert not any(got[100 + i].repeated for i in range(20))
