"""Collocations against plain loops, and the tile counter against a plain count."""

import random
from collections import Counter

import numpy as np
import pytest

from opslake.llm.collocations import count_pairs, mine_phrases, top_phrases


def by_hand(rows, min_count, max_words=4, covered=80, top=2000):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        own = counts.setdefault(lang, Counter())
        text = "".join(c.lower() if c.isascii() else c for c in text or "")
        for c in ",;:!?\n\x0b\x0c\r":
            text = text.replace(c, ".")
        for piece in text.replace("\t", " ").split("."):
            words = [w for w in piece.split(" ") if w]
            sizes[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    own[tuple(words[i : i + k])] += 1
    out = []
    for lang, own in counts.items():
        frequent = {p: f for p, f in own.items() if len(p) > 1 and f >= min_count}
        most = Counter()
        for p, f in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i : i + k]] = max(most[p[i : i + k]], f)
        found = []
        for p, a in frequent.items():
            if 100 * most[p] >= covered * a:
                continue
            cuts = [(2000000 * a // (own[p[:k]] + own[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def run(spark, rows, min_count, top=2000, **options):
    schema = "lang string, text string, word string, n long, f long, block long, w1 long, slot int"
    df = spark.createDataFrame([(*r, "x", 1, 1, 1, 1, 1) for r in rows], schema)
    found = top_phrases(mine_phrases(df, min_count=min_count, **options), top)
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r[c] for c in columns) for r in found.collect())


@pytest.mark.parametrize("ids,size,tile,share", [(1, 5, 4, 16), (40, 3000, 8, 4), (700, 5000, 64, 16), (90, 900, 8, 1000), (5, 0, 4, 2)])
def test_tiles_count_like_a_counter(ids, size, tile, share):
    rng = np.random.default_rng(ids)
    a, b = ((rng.random(size) ** 3 * ids).astype(np.int64) for _ in range(2))
    first, second, n, place = count_pairs(a, b, ids, tile, share)
    assert dict(zip(zip(first.tolist(), second.tolist()), n.tolist())) == Counter(zip(a.tolist(), b.tolist()))
    assert (first[place] == a).all() and (second[place] == b).all()


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    fixed = ["new york city", "strictly speaking", "in the long run", "The the the the", "a b c d e"]
    words = ["of", "the", "city", "long", "run", "new", "Ünder", "x y", "fast"] + [f"w{i}" for i in range(40)]
    out = []
    for i in range(300):
        text = []
        for _ in range(rng.randrange(0, 40)):
            text.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(words))
            text.append(rng.choice([" ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", ";", " ? "]))
        out.append((rng.choice(["en", "en", "de", "und", None, ""]), "".join(text)))
    return out


def test_equals_plain_loops(spark, rows):
    want = by_hand(rows, 5)
    assert len(want) > 40 and {len(r[2].split(" ")) for r in want} == {2, 3, 4}
    assert run(spark, rows, 5) == want
    # Many small blocks, other lengths and limits.
    assert run(spark, rows, 3, top=7, block_words=50, max_words=3, covered=60) == by_hand(
        rows, 3, max_words=3, covered=60, top=7
    )
    assert run(spark, rows, 4, max_words=2) == by_hand(rows, 4, max_words=2)


def test_awkward_texts(spark):
    rows = [("en", None), (None, ""), ("en", " \t "), ("de", "..!?\n"), (None, None)]
    rows += [("en", "one two three")] * 4  # repeated rows
    rows += [("en", "tick tock " * 30_000)]  # a very long text
    rows += [("de", "x" * 40_000 + " y")] * 3
    assert run(spark, rows, 3) == by_hand(rows, 3) != []
    assert run(spark, rows, 3, block_words=1) == by_hand(rows, 3)
    assert run(spark, rows[:5], 3) == run(spark, rows[:0], 3) == []


def test_ties_go_by_bytes(spark):
    rows = [("en", f"{a} {b}") for a, b in [("z", "y"), ("é", "è"), ("a", "b"), ("\U0001f600", "x"), ("￮", "x1")]] * 5
    got = run(spark, rows, 5)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == ["a b", "z y", "é è", "￮ x1", "\U0001f600 x"]
    assert got == by_hand(rows, 5)
