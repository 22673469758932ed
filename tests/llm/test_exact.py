"""Exact dedup against grouping by text, also with a hash that collides; and line dedup."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from opslake.llm.exact_dedup import exact_dedup
from opslake.llm.line_dedup import dedup_lines

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(text):
    return (text or "").translate(UPPER)


@pytest.mark.parametrize("block", [7, 4096])
@pytest.mark.parametrize("weak", [False, True])
def test_groups_equal_texts(awkward, block, weak):
    def collide(col):
        return F.pmod(F.octet_length(col), F.lit(3)).cast("long")

    options = {"block_hash": collide} if weak else {}
    docs = awkward.where("doc_id is null or doc_id not in (6, 7, 10)") if block == 7 else awkward
    got = exact_dedup(docs, carry=["text"], block_bytes=block, **options).collect()
    want = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        want[norm(r.text)].append(r.doc_id)
    assert len(got) == sum(map(len, want.values()))
    for r in got:
        ids = want[norm(r.text)]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = Counter(norm(r.text) for r in got if r.kept)
    assert kept == Counter(list(want))


def test_exact_dedup_of_nothing(no_docs):
    assert exact_dedup(no_docs).count() == 0
    assert dedup_lines(no_docs).count() == 0


def lines_by_hand(rows, min_docs, min_chars=1):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(UPPER)

    seen = Counter()
    for _, text in rows:
        seen.update({key(line) for line in (text or "").split("\n")})
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < min_chars or seen[key(x)] < min_docs]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize(("min_docs", "batches", "fanout"), [(2, 4, 2), (3, 1, 4), (4, 7, 3)])
def test_lines_equal_brute_force(awkward, min_docs, batches, fanout):
    rows = [tuple(r) for r in awkward.select("doc_id", "text").collect()]
    got = dedup_lines(awkward, min_docs=min_docs, batches=batches, fanout=fanout)
    want = lines_by_hand(rows, min_docs)
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_a_line_repeated_within_one_document_stays(spark):
    docs = spark.createDataFrame([(1, "a\na\na"), (2, "b\nA ")], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in dedup_lines(docs, min_docs=2).collect()}
    assert got == {1: "", 2: "b"}
    assert {r.n_dropped for r in dedup_lines(docs, min_docs=3).collect()} == {0}
