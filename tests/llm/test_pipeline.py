"""The stages over awkward tables, and all rows of the pipeline against plain code."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opslake.llm.decontaminate import words_of
from opslake.llm.queries import QUERIES
from opslake.llm.simhash import fingerprint

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_awkward_documents(spark, sf, awkward, name, stage):
    docs = awkward
    got = stage(spark, docs, sf)
    if name != "encode":
        assert got.columns == docs.columns
    assert 0 < got.count() <= 14
    assert stage(spark, docs.limit(0), sf).count() == 0


def test_columns_named_like_the_row_id_stay(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    docs = docs.withColumn("__row", F.concat(F.lit("own "), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf)
        assert got.columns == docs.columns
        rows = got.select("doc_id", "__row").collect()
        assert rows and all(r["__row"] == f"own {r.doc_id}" for r in rows)


def test_pipeline_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.keep_quality(spark, docs, sf).select("doc_id", "text").collect()
    assert 0.6 * docs.count() < len(kept) < docs.count()
    by_text = {}
    for r in kept:
        key = (r.text or "").encode().lower()
        by_text[key] = max(by_text.get(key, r), r, key=lambda x: x.doc_id)
    rows = sorted(by_text.values(), key=lambda r: r.doc_id)
    prints = {r.doc_id: fingerprint(r.text) for r in rows}
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = [r for r in rows if find(r.doc_id) == r.doc_id]
    bench = [words_of(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 10]) for w in bench if w for i in range(max(1, len(w) - 9))}
    sizes = {len(w) for w in windows}

    def clean(text):
        words = words_of(text)
        return not any(
            tuple(words[i : i + n]) in windows for n in sizes for i in range(len(words) - n + 1)
        )

    want = {r.doc_id: r.text for r in rows if clean(r.text)}
    got = {r.doc_id: r.text for r in corpus_pipeline.run(spark, sf).collect()}
    assert got == want


def test_all_operators_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


def test_near_copies_without_ids_stay_once_per_fingerprint(spark, sf):
    words = " ".join(f"w{i}" for i in range(50))
    rows = [(None, words), (None, words), (None, "other text here"), (4, "of its own"), (3, "Of its own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.drop_near_copies(spark, docs, sf).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [
        (0, "other text here"), (0, words), (3, "Of its own")
    ]
