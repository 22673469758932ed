"""The inverted text index and tables in segments."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslake.operators.embedding import HashedWordEmbedder, ModelEmbedder, sync_segments
from opslake.operators.text_index import TextIndex
from opslake.sources.segments import SegmentedTable


def words(text):
    return re.findall(r"[a-zäöü]+", (text or "").lower())


def by_hand(rows, queries, k):
    docs = {}
    for key, text in rows:
        if key is not None:
            docs[key] = max(docs.get(key, ""), text or "")
    df = {}
    for text in docs.values():
        for w in set(words(text)):
            df[w] = df.get(w, 0) + 1

    def vector(text):
        raw = {w: words(text).count(w) * math.log((len(docs) + 1) / (df.get(w, 0) + 1)) for w in words(text)}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items() if x > 0}

    vectors = {key: vector(text) for key, text in docs.items()}
    out = []
    for query_id, text in queries:
        asked = vector(text)
        found = []
        for key, v in vectors.items():
            if set(v) & set(asked):
                found.append((-round(sum(x * v.get(w, 0) for w, x in asked.items()), 9), key))
        out += [(query_id, rank, key, -s) for rank, (s, key) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    common = ["the", "of", "pump", "Filter"]
    rare = [f"word{c}{d}" for c in "abcdefghij" for d in "abcdefgh"]
    out = []
    for i in range(400):
        text = rng.choices(common, k=rng.randrange(0, 6)) + rng.choices(rare, k=rng.randrange(0, 4))
        out.append((i, " ".join(text)))
    return out + [(5, "zzz larger row of five"), (None, "pump"), (900, None), (901, ""), (902, "1 2 3")]


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    df = spark.createDataFrame(rows, "id long, body string").withColumn("extra", F.col("id") * 2)
    return TextIndex.build(df, "id", "body", str(tmp_path_factory.mktemp("index")), ["extra"], buckets=16)


QUERIES = [
    (1, "wordaa wordbb pump"),
    (2, "the of"),
    (3, "filter FILTER wordcc unknown"),
    (4, ""),
    (5, None),
    (6, "zzz the"),
    (7, "nothing here"),
    (8, "the of pump filter wordaa wordab wordac wordad wordae wordaf wordag wordah"),
]


@pytest.mark.parametrize("frequent", [0.0, 1 / 16, 0.3, 1.0])
@pytest.mark.parametrize("k", [1, 7])
def test_search_equals_plain_loops(spark, rows, index, k, frequent):
    asked = spark.createDataFrame(QUERIES, "query_id int, query_text string")
    got = index.search(asked, k, columns=["extra"], frequent=frequent).collect()
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in got) == by_hand(rows, QUERIES, k)
    assert all(r.extra == 2 * r.id for r in got)


def test_many_words_meet_in_a_join(spark, rows, index, monkeypatch):
    import opslake.operators.text_index as module

    monkeypatch.setattr(module, "NAMED_WORDS", 3)
    asked = spark.createDataFrame(QUERIES, "query_id int, query_text string")
    got = index.search(asked, 4).collect()
    assert sorted((r.query_id, r["rank"], r.id, r.score) for r in got) == by_hand(rows, QUERIES, 4)


def test_only_the_asked_words_are_read(spark, index):
    tokens = index.postings().select("token").distinct().limit(2)
    part = index._only(index.postings(), tokens, 16)
    everything = len(index.postings().inputFiles())
    kept = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        plan = part._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", kept)
    assert re.search(r"PartitionFilters: \[[^\]]*bucket", plan)
    assert re.search(r"PushedFilters: \[[^\]]*In\(token", plan)
    buckets = {int(f.split("bucket=")[1].split("/")[0]) for f in index.postings().inputFiles()}
    asked = {r.bucket for r in part.select("bucket").distinct().collect()}
    assert len(asked) <= 2 < len(buckets) and everything >= len(buckets)
    assert part.select("token").distinct().count() == 2


def test_a_frequent_word_lies_in_several_files(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, "id long, body string")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        postings = TextIndex.build(df, "id", "body", str(tmp_path), buckets=4).postings()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    files = postings.select("token", "id", F.input_file_name().alias("f")).groupBy("token", "f")
    spans = files.agg(F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    largest = postings.groupBy("token").count().orderBy(F.desc("count")).head().token
    parts = sorted((r.low, r.high) for r in spans.where(F.col("token") == largest).collect())
    assert len(parts) > 1 and all(a[1] < b[0] for a, b in zip(parts, parts[1:]))


def test_empty_index(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, body string")
    index = TextIndex.build(empty, "id", "body", str(tmp_path))
    asked = spark.createDataFrame(QUERIES, "query_id int, query_text string")
    assert index.search(asked).collect() == []


# --- segments ---------------------------------------------------------------------------


def content(df):
    return sorted(map(tuple, df.collect()))


def test_segments_merge_on_read(spark, tmp_path):
    table = SegmentedTable(spark, f"{tmp_path}/a`b", "id")
    assert table.manifest() is None
    schema = "id long, x string, v array<float>"

    def rows(*ids, x):
        return spark.createDataFrame([(i, x, [float(i)]) for i in ids], schema)

    with pytest.raises(ValueError):
        table.append(rows(1, x="a"), rows(x=""))
    table.rewrite(rows(1, 2, 3, 4, x="a").unionByName(spark.createDataFrame([(None, "n", None)], schema)))
    assert content(table.read(["id", "x"])) == [(1, "a"), (2, "a"), (3, "a"), (4, "a")]
    table.append(rows(2, 5, x="b"), rows(3, x="").select("id"))
    table.append(rows(3, x="c"), rows(5, 1, x="").select("id"))
    want = [(2, "b", 1), (3, "c", 2), (4, "a", 0)]
    assert content(table.read(["id", "x"], numbered=True)) == want
    assert table.read(["x"]).columns == ["x"]
    spark.sql(f"CREATE OR REPLACE TEMP VIEW merged AS {table.sql()}")
    assert content(spark.table("merged").select("id", "x")) == [r[:2] for r in want]
    # A run that died before the manifest leaves a segment that doesn't count and is replaced.
    table._rows(rows(7, x="lost")).write.parquet(table._folder(3))
    assert content(table.read(["id", "x"])) == [r[:2] for r in want]
    table.append(rows(8, x="d"), rows(x="").select("id"))
    assert [r[0] for r in content(table.read(["id"]))] == [2, 3, 4, 8]
    table.compact()
    assert table.manifest()[1] == table.manifest()[2] == 4
    assert content(table.read(["id", "x"])) == [(2, "b"), (3, "c"), (4, "a"), (8, "d")]
    assert table.read().columns == ["id", "x", "v"]


def test_a_sync_writes_only_changes(spark, tmp_path):
    base = spark.range(2000).select("id", F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"), F.lit(1).alias("price"))
    index = SegmentedTable(spark, str(tmp_path), "id")
    assert sync_segments(index, base, HashedWordEmbedder(salt="a"), "text")
    assert not sync_segments(index, base, ModelEmbedder(None), "text")
    later = base.where("id <> 7").withColumn("price", F.when(F.col("id") == 9, 2).otherwise(1))
    later = later.withColumn("text", F.when(F.col("id") == 11, "new words").otherwise(F.col("text")))
    later = later.unionByName(spark.createDataFrame([(5000, "added", 1)], base.schema))

    def encode(texts):
        assert len(texts) <= 2
        return np.ones((len(texts), 64), np.float32)

    assert sync_segments(index, later, ModelEmbedder(encode), "text")
    number = index.manifest()[2]
    assert index.segment(number).count() == 4
    got = {r.id: r for r in index.read().where("id in (7, 9, 10, 11, 5000)").collect()}
    assert sorted(got) == [9, 10, 11, 5000]
    assert got[9].price == 2 and got[9].embedding != got[11].embedding == [1.0] * 64
    assert index.read().count() == 2000
    assert not sync_segments(index, later, ModelEmbedder(None), "text")


def test_vectors_of_null_texts(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, None)], "id int, text string").coalesce(1)

    def encode(texts):
        return np.array([[ord(t), 0.5] for t in texts])

    got = {r.id: r.embedding for r in ModelEmbedder(encode).transform(df, "text").collect()}
    assert got == {1: [97.0, 0.5], 2: None, 3: [98.0, 0.5], 4: None}
    hashed = HashedWordEmbedder(8).transform(df, "text").where("text is null").head().embedding
    assert hashed == [0.0] * 8
