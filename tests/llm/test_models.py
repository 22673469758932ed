"""WARC round trip, BPE against the public library, and the trained models."""

import base64
import gzip
import hashlib
import json
import math
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opslake.llm import bpe, kneser_ney, language_id, quality, warc
from opslake.session import scratch_path

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# --- WARC ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    body = "<p>" + "same é " * 40 + "</p>"
    rows = [
        (3, "http://c/", body),
        (1, "http://a/", body),
        (2, None, body),
        (None, "http://n/", body),
        (4, "http://d/\r\nX: y", "short"),
        (5, "http://e/", "short"),
        (6, "http://f/", None),
        (7, "http://g/", ""),
        (8, "http://h/", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 20),
        (9, "http://i/", "long " * 900_000),
        (1, "http://a/", body),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumn("digest", F.lit("extra")).withColumn("id", F.lit("extra"))


@pytest.mark.parametrize("archive_bytes", [1 << 26, 500])
def test_records_come_back(pages, archive_bytes):
    got = warc.warc_round_trip(pages, archive_bytes).collect()
    want = Counter()
    for r in pages.collect():
        data = (r.html or "").encode()
        want[r.page_id, len(data), hashlib.sha256(data).hexdigest()] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want
    same = [r for r in got if r.page_id in (1, 2, 3, None)]
    assert Counter(r.record_type for r in same) == {"response": 1, "revisit": 4}
    assert {r.refers_to for r in same if r.record_type == "revisit"} == {1}
    assert [r.page_id for r in same if r.record_type == "response"] == [1]
    assert all(r.record_type == "response" for r in got if r.page_id in (4, 5, 6, 7, 8, 9))


def test_every_member_is_found_by_the_index(spark, pages):
    raw, normal = scratch_path(spark, "raw"), scratch_path(spark, "normal")
    archives = warc.write_archives(warc.mark_revisits(pages), raw)
    for r in warc.normalise_archives(archives, normal).collect():
        data = Path(r.path).read_bytes()
        entries = [json.loads(x) for x in Path(r["index"]).read_text().splitlines()]
        members = [data[e["offset"] : e["offset"] + e["length"]] for e in entries]
        assert b"".join(members) == data and len(entries) == r.records
        assert all(gzip.decompress(m).startswith(b"WARC/1.1\r\n") for m in members)
    assert warc.warc_round_trip(pages.limit(0)).count() == 0


# --- BPE -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def coder():
    lines = Path(RANKS).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_encoding_equals_the_library(awkward, no_docs, coder, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 5)
    coded = bpe.encode(awkward, RANKS, public_tokenizers.PATTERN, keep=["doc_id", "source"], with_decoded=True)
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in coded.collect())
    want = Counter()
    for r in awkward.select("doc_id", "text").collect():
        ids = coder.encode_ordinary(r.text or "")
        want[r.doc_id, len(ids), np.array(ids, "<u4").tobytes(), (r.text or "").encode()] += 1
    assert got == want
    again = bpe.decode(coded.drop("decoded"), RANKS)
    assert {bytes(r.decoded) for r in again.collect()} == {w[3] for w in want}
    assert bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


@given(st.text(alphabet="ab'sté1² \n\t\x1c\x85\xa0　.,漢<|>", max_size=40))
@settings(deadline=None, max_examples=400)
def test_splitting_equals_the_library(coder, text):
    split = bpe.Splitter(public_tokenizers.PATTERN)
    ids = [i for word in split(text) for i in coder._encode_single_piece(word.encode())]
    assert ids == coder.encode_ordinary(text) and "".join(split(text)) == text


# --- language --------------------------------------------------------------------------


def test_language_is_learnt_and_held_out_rows_are_right(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = language_id.fold(F.col("doc_id"), 4) == 2
    model = language_id.train(docs.where(~held))
    got = language_id.detect_language(docs.select("doc_id", "lang", "text"), model, "text")
    rows = got.where(held).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def plain_languages(rows):
    """Training and prediction by plain loops, all rows and entries."""
    def words(text):
        return regex.findall(r"\p{L}[\p{L}\p{M}]*", text.lower())

    def grams(word, order):
        edged = f"^{word}$"
        return list(word) if order == 1 else [edged[i : i + order] for i in range(len(edged) - order + 1)]

    counts, totals, distinct = {}, {}, {}
    for lang, text in rows:
        for word in words(text or "") if lang is not None else []:
            for order, entry in [(0, word)] + [(o, g) for o in (1, 2, 3, 4, 5) for g in grams(word, o)]:
                own = counts.setdefault((order, entry), {})
                own[lang] = own.get(lang, 0) + 1
                totals[lang, order] = totals.get((lang, order), 0) + 1
    for order, _ in counts:
        distinct[order] = distinct.get(order, 0) + 1
    langs = sorted({lang for lang, _ in totals})

    def logs(order, entry):
        own = counts[order, entry]
        return [
            math.log((own.get(x, 0) + 0.5) / (totals.get((x, order), 0) + 0.5 * distinct[order])) for x in langs
        ]

    def predict(text):
        found = words(text or "")
        if not found:
            return "und", 0.0
        total = [0.0] * len(langs)
        for word in found:
            entries = [(0, word)] if (0, word) in counts else []
            edged = f"^{word}$"
            for at in range(len(edged) - 1) if not entries else ():
                pieces = [(o, edged[at : at + o]) for o in (5, 4, 3, 2)] + [(1, edged[max(at, 1)])]
                known = [(o, p) for o, p in pieces if len(p) == o and (o, p) in counts]
                entries += known[:1]
            for entry in entries:
                total = [t + x / len(entries) for t, x in zip(total, logs(*entry))]
        best = max(range(len(langs)), key=lambda i: (total[i], -i))
        return langs[best], 1 / sum(math.exp(max(-700, t - total[best])) for t in total)

    return predict


def test_language_model_equals_plain_loops(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    held = language_id.fold(F.col("doc_id"), 4) == 2
    train = [(r.lang, r.text) for r in docs.where(~held).collect()]
    asked = [(i, t) for i, t in enumerate(
        [r.text for r in docs.where(held).collect()][:40]
        + ["½", "² ①", "Ⅷ", "٣", "e\u0301te\u0301 x", "zzzqqq Ωμέγα", "1st", "", None, "_ - 9", "नमस्ते"]
    )]
    model = language_id.train(docs.where(~held), max_entries=10**7)
    df = spark.createDataFrame(asked, "i int, text string")
    got = {r.i: (r.lang_pred, r.score) for r in language_id.detect_language(df, model).collect()}
    predict = plain_languages(train)
    for i, text in asked:
        want = predict(text)
        assert got[i][0] == want[0] and got[i][1] == pytest.approx(want[1], rel=1e-6, abs=1e-9)
    assert [got[i][0] for i in range(40, 44)] == ["und"] * 4 and got[46][0] != "und"


def test_a_language_of_copies_and_one_of_few_words_are_kept(spark):
    rows = [("aa", "lorem ipsum dolor")] * 9000 + [("bb", f"mot{chr(97 + i % 26)} rare{chr(97 + i // 26)}") for i in range(50)]
    big = [("cc", " ".join(f"{a}{b}x" for b in "abcdefghijklmnopqrstuvwxyz")) for a in "abcdefghijklmnop"]
    df = spark.createDataFrame(rows + big, "lang string, text string").repartition(5)
    model = language_id.train(df, max_train_docs=1000, max_entries=300)
    assert model.langs == ["aa", "bb", "cc"] and len(model.keys) <= 300
    asked = spark.createDataFrame([(1, "lorem dolor"), (2, "mota rareb"), (3, "aax abx")], "i int, text string")
    got = {r.i: r.lang_pred for r in language_id.detect_language(asked, model).collect()}
    assert got == {1: "aa", 2: "bb", 3: "cc"}


def test_more_languages_than_are_named(spark, monkeypatch):
    monkeypatch.setattr(language_id, "NAMED_LANGUAGES", 2)
    df = spark.createDataFrame([(x, f"{x}{x} {x}") for x in ("aa", "bb", "cc", "dd")] * 3, "lang string, text string")
    model = language_id.train(df)
    assert model.langs == ["aa", "bb", "cc", "dd"] and model.predict("cccc")[0] == "cc"


def test_language_of_awkward_texts(spark, awkward, no_docs):
    model = language_id.train(awkward)
    rows = language_id.detect_language(awkward, model).collect()
    assert len(rows) == 14
    none = {(r.lang_pred, r.score) for r in rows if r.doc_id in (3, 4, 5)}
    assert none == {("und", 0.0)}
    assert {r.lang_pred for r in rows} <= {"en", "de", "und"}
    empty = language_id.train(no_docs)
    assert {r.lang_pred for r in language_id.detect_language(awkward, empty).collect()} == {"und"}
    assert language_id.detect_language(no_docs, model).count() == 0


def test_unseen_words_back_off_to_shorter_grams():
    keys = [(0, "known"), (2, "ab"), (1, "z")]
    logs = np.log([[0.9, 0.1], [0.2, 0.8], [0.7, 0.3]])
    model = language_id.LanguageModel(["x", "y"], keys, logs)
    assert model.predict("known")[0] == "x"
    assert model.predict("ab")[0] == "y"
    assert model.predict("z")[0] == "x"
    assert model.predict("12 !")[0] == "und"


# --- language model --------------------------------------------------------------------


class PlainModel:
    """The same model in dictionaries."""

    def __init__(self, texts):
        docs = [(t or "").encode().lower().split() + ["end"] for t in texts]
        self.counts = Counter(w for d in docs for w in d)
        pairs = Counter(p for d in docs for p in zip(["start", *d], d))
        self.pairs, self.total, self.types = pairs, sum(self.counts.values()), len(self.counts)
        self.d2 = self.discount(pairs.values())
        before = Counter(w for _, w in pairs)
        self.before = before
        self.d1 = self.discount(before.values())
        self.context = defaultdict(Counter)
        for (u, w), c in pairs.items():
            self.context[u][w] = c

    @staticmethod
    def discount(values):
        by = Counter(values)
        return kneser_ney.discounts([by[k] for k in (1, 2, 3, 4)])

    def lower(self, w):
        types = len(self.pairs)
        rest = sum(self.d1[min(c, 3) - 1] for c in self.before.values()) / types
        c = self.before[w]
        return max(c - (self.d1[min(c, 3) - 1] if c else 0), 0) / types + rest / (self.types + 1)

    def prob(self, u, w):
        seen = self.context.get(u)
        if not seen:
            return self.lower(w)
        total = sum(seen.values())
        rest = sum(self.d2[min(c, 3) - 1] for c in seen.values()) / total
        c = seen.get(w, 0)
        return max(c - (self.d2[min(c, 3) - 1] if c else 0), 0) / total + rest * self.lower(w)

    def score(self, text):
        words = (text or "").encode().lower().split() + ["end"]
        base = sum(math.log10((self.counts[w] + 1) / (self.total + self.types + 1)) for w in words)
        own = sum(math.log10(self.prob(u, w)) for u, w in zip(["start", *words], words))
        return len(words), sum(self.counts[w] > 0 for w in words), base, own


def test_scores_equal_the_plain_model(spark, awkward, no_docs, monkeypatch):
    monkeypatch.setattr(kneser_ney, "BLOCK_TOKENS", 5_000)
    train = awkward.where("doc_id is null or doc_id not in (7, 11)")
    model = kneser_ney.train(train)
    plain = PlainModel([r.text for r in train.select("text").collect()])
    assert (model.train_tokens, model.types, model.pairs) == (plain.total, plain.types, len(plain.pairs))
    assert len(model.hot) > 0
    for r in kneser_ney.score_documents(awkward, model, keep=("doc_id", "text")).collect():
        want = plain.score(r.text)
        assert (r.n_tokens, r.n_known) == want[:2]
        assert r.base_score == pytest.approx(want[2]) and r.score == pytest.approx(want[3])
    words = [*plain.counts, "never seen"]
    for u in ("start", b"alpha", "never"):
        assert sum(plain.prob(u, w) for w in words) == pytest.approx(1)
    nothing = kneser_ney.train(no_docs)
    assert kneser_ney.score_documents(no_docs, model).count() == 0
    assert all(r.n_known == 0 for r in kneser_ney.score_documents(awkward, nothing).collect())


# --- quality ---------------------------------------------------------------------------


def test_quality_is_learnt(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    seen, unseen = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    got = quality.quality_scores(docs, seen, good).join(unseen, "doc_id").collect()
    clean = [r.kept for r in got if r.quality == 1 and r.toxic == 0]
    poor = [r.kept for r in got if r.quality == 0]
    assert np.mean(clean) > 0.98 and np.mean(poor) < 0.1
    assert all(0 <= s <= 1 for r in got for s in (r.text_score, r.meta_score, r.score))


def test_quality_of_awkward_tables(spark, awkward, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, None), (6, 0, 1), (2, 1, 0), (10, 0, 0), (None, 1, 0), (99, 1, 0)],
        "doc_id long, quality int, toxic int",
    )
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    rows = quality.quality_scores(awkward, labels, good).collect()
    assert len(rows) == 14 and all(r.score is not None for r in rows)
    none = quality.quality_scores(awkward, labels.limit(0), good).collect()
    assert {(r.score, r.kept) for r in none} == {(1.0, True)}
    bare = awkward.select("doc_id", "text")
    assert quality.quality_scores(bare, labels, good).count() == 14
    assert quality.quality_scores(no_docs, labels, good).count() == 0
