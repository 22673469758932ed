"""Text search by an inverted index: postings of weighted words, written once, read by word.

A text's words weigh ``tf * ln((docs + 1) / (df + 1))``, scaled to unit length, so the score of
a text for a query is the cosine of the two. The words are runs of letters in lower case;
a word's id is the first 60 bits of its md5, which any SQL engine can compute.

Postings are partitioned by bucket of the id and sorted by id and key, dealt out by range of
(bucket, id, key): a frequent word lies in several files, split by key. A search reads the
folders and row groups of the queried words only. Words that occur in many texts are read
last: once the k best texts by the rarer words are known, a text that has none of those words
and could not reach them by the frequent words' largest weights needn't be looked at. Results
are exact either way.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opslake.operators.diff import one_per_key
from opslake.session import scratch_path

QUERY_ID, SCORE, RANK = "query_id", "score", "rank"
BUCKETS = 64
# A word is frequent if it occurs in more than this share of the texts.
FREQUENT = 1 / 16
# Up to so many distinct words of a set of queries are named in the scan; more meet in a join.
NAMED_WORDS = 1000
SCORE_PLACES = 9
# Room for the rounding of sums wherever bounds are compared.
SLACK = 1e-8


def words_of(text: Column) -> Column:
    """The runs of letters of a text in lower case; none for a NULL text."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"(\p{L}+)"), 1)


def word_id(word: Column) -> Column:
    """The first 60 bits of a word's md5 as a number."""
    return F.conv(F.substring(F.md5(word.cast("binary")), 1, 15), 16, 10).cast("bigint")


def _counted(df: DataFrame, key: str, text: str) -> DataFrame:
    words = df.select(key, F.explode(words_of(F.col(text))).alias("word"))
    return words.groupBy(key, word_id(F.col("word")).alias("token")).agg(F.count(F.lit(1)).alias("tf"))


def _idf(docs: Column | int, df: Column) -> Column:
    total = docs if isinstance(docs, Column) else F.lit(docs)
    return F.log((total + 1).cast("double") / (df + 1))


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class TextIndex:
    """The index under ``path``: folders ``postings``, ``words``, ``texts`` and ``size``."""

    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.path, self.key = spark, path.rstrip("/"), key

    @classmethod
    def build(
        cls,
        source: DataFrame,
        key: str,
        text: str,
        path: str,
        columns: Sequence[str] = (),
        buckets: int = BUCKETS,
    ) -> TextIndex:
        """Write the index of ``source`` into a new folder under ``path``. ``columns`` are kept
        with the texts, to be shown with results.

        Rows without a key are left out; of rows that repeat a key the largest counts. Words
        that occur in every text weigh nothing and have no postings.
        """
        spark = source.sparkSession
        index = cls(spark, f"{path.rstrip('/')}/{uuid.uuid4().hex}", key)
        shown = [c for c in columns if c not in (key, text)]
        texts = one_per_key(source.where(F.col(key).isNotNull()).select(key, text, *shown), key)
        texts.write.parquet(f"{index.path}/texts")
        texts = spark.read.schema(texts.schema).parquet(f"{index.path}/texts")
        docs = texts.count()

        counted = _stored(_counted(texts, key, text), "word-counts")
        found = counted.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
        weighed = counted.join(found, "token").select(
            key, "token", "df", (F.col("tf") * _idf(docs, F.col("df"))).alias("raw")
        )
        weighed = _stored(weighed.where("raw > 0"), "word-weights")
        norms = weighed.groupBy(key).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
        postings = weighed.join(norms, key).select(
            F.pmod("token", F.lit(buckets)).cast("int").alias("bucket"),
            "token",
            key,
            (F.col("raw") / F.col("norm")).alias("weight"),
        )
        order = ["bucket", "token", key]
        ranged = postings.repartitionByRange(*order).sortWithinPartitions(*order)
        ranged.write.partitionBy("bucket").parquet(f"{index.path}/postings")
        largest = index.postings().groupBy("token").agg(F.max("weight").alias("largest"))
        words = found.join(largest, "token", "left").select(
            F.pmod("token", F.lit(buckets)).cast("int").alias("bucket"), "token", "df", "largest"
        )
        words = words.repartitionByRange("bucket", "token").sortWithinPartitions("bucket", "token")
        words.write.partitionBy("bucket").parquet(f"{index.path}/words")
        size = spark.createDataFrame([(docs, buckets)], "docs bigint, buckets int")
        size.coalesce(1).write.parquet(f"{index.path}/size")
        return index

    def texts(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/texts")

    def _table(self, name: str, layout: str) -> DataFrame:
        # With its schema, since an empty index has no file to take it from.
        return self.spark.read.schema(layout).parquet(f"{self.path}/{name}")

    def postings(self) -> DataFrame:
        """``token``, the key, ``weight`` and ``bucket``."""
        kind = self.texts().schema[self.key].dataType.simpleString()
        return self._table("postings", f"token bigint, `{self.key}` {kind}, weight double, bucket int")

    def words(self) -> DataFrame:
        """``token``, ``df``, ``largest`` (its largest weight, NULL without postings), ``bucket``."""
        return self._table("words", "token bigint, df bigint, largest double, bucket int")

    def _only(self, table: DataFrame, tokens: DataFrame, buckets: int) -> DataFrame:
        """The table's rows of these words: by folder and row group if they are few, else by a
        join. ``tokens`` has distinct ones."""
        few = [r[0] for r in tokens.select("token").limit(NAMED_WORDS + 1).collect()]
        if len(few) > NAMED_WORDS:
            return table.join(tokens.select("token"), "token", "left_semi")
        named = sorted({t % buckets for t in few})
        return table.where(F.col("bucket").isin(named) & F.col("token").isin(sorted(few)))

    def _asked(self, queries: DataFrame, text: str, size) -> DataFrame:
        """The queries' words with their weights and what the index knows of them."""
        tf = _counted(queries.select(QUERY_ID, text), QUERY_ID, text)
        tf = _stored(tf, "query-words")
        known = self._only(self.words(), tf.select("token").distinct(), size["buckets"])
        found = F.coalesce("df", F.lit(0))
        weighed = tf.join(known.drop("bucket"), "token", "left").select(
            QUERY_ID, "token", "df", "largest", (F.col("tf") * _idf(size["docs"], found)).alias("raw")
        )
        weighed = _stored(weighed, "query-weights")
        norms = weighed.groupBy(QUERY_ID).agg(F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("norm"))
        asked = weighed.where("largest is not null and raw > 0").join(norms, QUERY_ID)
        asked = asked.select(
            QUERY_ID, "token", "df", "largest", (F.col("raw") / F.col("norm")).alias("asked")
        )
        return _stored(asked, "asked-words")

    def _sums(self, postings: DataFrame, asked: DataFrame) -> DataFrame:
        """Scores of (query, key) by these words. Postings stay where they lie as long as the
        queries' words are small enough to broadcast."""
        met = postings.join(asked.select(QUERY_ID, "token", "asked"), "token")
        product = F.col("weight") * F.col("asked")
        return met.groupBy(QUERY_ID, self.key).agg(F.sum(product).alias(SCORE))

    def search(
        self,
        queries: DataFrame,
        k: int = 5,
        text: str = "query_text",
        columns: Sequence[str] = (),
        frequent: float = FREQUENT,
    ) -> DataFrame:
        """The k best texts of every query: query_id, rank, key, columns, score.

        ``queries`` has ``query_id`` and ``text``; an id that repeats asks for all its words.
        Scores are rounded to nine places; ties go to the smaller key. Texts that share no
        weighing word with a query aren't found, so it may have fewer than k.
        """
        key = self.key
        size = self.spark.read.parquet(f"{self.path}/size").head()
        asked = self._asked(queries.where(F.col(QUERY_ID).isNotNull()), text, size)
        often = F.col("df") > frequent * size["docs"]
        rare, common = asked.where(~often), asked.where(often)

        def postings_of(part: DataFrame) -> DataFrame:
            return self._only(self.postings(), part.select("token").distinct(), size["buckets"])

        scores = self._sums(postings_of(rare), rare)
        if not common.isEmpty():
            scores = self._with_common(_stored(scores, "rare-scores"), postings_of(common), common, k)
        rounded = scores.withColumn(SCORE, F.round(SCORE, SCORE_PLACES))
        order = Window.partitionBy(QUERY_ID).orderBy(F.desc(SCORE), key)
        best = rounded.withColumn(RANK, F.row_number().over(order)).where(F.col(RANK) <= k)
        shown = [c for c in columns if c != key]
        if shown:
            best = best.join(self.texts().select(key, *shown), key)
        return best.select(QUERY_ID, RANK, key, *shown, SCORE)

    def _with_common(self, scores: DataFrame, postings: DataFrame, common: DataFrame, k: int) -> DataFrame:
        """Scores by all words, from those by the rarer ones, leaving out texts that the
        frequent words can't bring among the first k."""
        key = self.key
        most = common.groupBy(QUERY_ID).agg(F.sum(F.col("asked") * F.col("largest")).alias("most"))
        order = Window.partitionBy(QUERY_ID).orderBy(F.desc(SCORE))
        kth = scores.withColumn("at", F.row_number().over(order)).where(F.col("at") == k)
        bounds = most.join(kth.select(QUERY_ID, F.col(SCORE).alias("kth")), QUERY_ID, "left")
        closed = F.coalesce(F.col("most") < F.col("kth") - SLACK, F.lit(False))
        bounds = _stored(bounds.withColumn("closed", closed), "score-bounds")
        settled = bounds.where("closed").select(QUERY_ID, "most", "kth")

        # Closed: only texts that have a rare word and can still get there.
        near = scores.join(settled, QUERY_ID).where(F.col(SCORE) + F.col("most") >= F.col("kth") - SLACK)
        near = _stored(near.select(QUERY_ID, key, SCORE), "near-texts")
        wanted = common.join(near.select(QUERY_ID, key), QUERY_ID)
        wanted = wanted.select(QUERY_ID, "token", "asked", key)
        more = postings.join(wanted, ["token", key]).select(
            QUERY_ID, key, (F.col("weight") * F.col("asked")).alias(SCORE)
        )
        # Open: every text that has any of the words.
        rest = bounds.where("not closed").select(QUERY_ID)
        whole = self._sums(postings, common.join(rest, QUERY_ID, "left_semi"))
        # Without frequent words a query is done; the scores of closed ones are among the near.
        others = scores.join(settled.select(QUERY_ID), QUERY_ID, "left_anti")
        parts = near.unionByName(more).unionByName(whole).unionByName(others)
        return parts.groupBy(QUERY_ID, key).agg(F.sum(SCORE).alias(SCORE))
