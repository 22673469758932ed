"""Language identification: known words first, then shorter and shorter character n-grams.

Training counts words and character n-grams per language in Spark. A word of the model
contributes its log frequency in each language; an unseen word is scored by the longest
n-grams that the model knows, place by place, backing off to shorter ones.

The classifier is fitted on a bounded sample of the labelled rows (about ``max_train_docs`` per
language, drawn row by row where they are scanned, so copies of a text are drawn apart) and keeps
at most ``max_entries`` words and n-grams: of each language its share, the most frequent ones. So
the model that goes to the tasks has a proven size, at any corpus size. All rows are predicted,
over their whole texts.

A letter is a character of Unicode's letter categories, a word a letter and the letters and
combining marks after it; digits and numerals of any kind are neither.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.common import ROW, map_arrow, stored, with_row


WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
PLAIN = re.compile(r"[a-z]+")
ORDERS = (5, 4, 3, 2, 1)
MAX_TRAIN_DOCS = 4_000
MAX_ENTRIES = 200_000
# Shares of so many languages are named in the scan; those of more are joined.
NAMED_LANGUAGES = 500
# Words whose n-grams are remembered by a task.
CACHE = 200_000
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    """The words of a text in lower case; the same, faster, where every character is ASCII."""
    text = text.lower()
    return (PLAIN if text.isascii() else WORD).findall(text)


def grams_of(word: str, order: int) -> list[str]:
    """Character n-grams of a word with its ends marked; letters alone for order 1."""
    if order == 1:
        return list(word)
    edged = f"^{word}$"
    return [edged[i : i + order] for i in range(len(edged) - order + 1)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (language, order, entry); order 0 are words."""
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            counts: dict[str, Counter] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                counts.setdefault(lang, Counter()).update(words_of(text))
            rows: Counter = Counter()
            for lang, words in counts.items():
                for word, n in words.items():
                    rows[lang, 0, word] += n
                    for order in ORDERS:
                        for gram in grams_of(word, order):
                            rows[lang, order, gram] += n
            if rows:
                langs, orders, entries = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(langs, pa.string()),
                        pa.array(orders, pa.int32()),
                        pa.array(entries, pa.string()),
                        pa.array(rows.values(), pa.int64()),
                    ],
                    names=["lang", "order", "entry", "n"],
                )


class LanguageModel:
    """Log frequencies by entry, in every language, and the scoring of texts."""

    def __init__(self, langs: list[str], keys: list[tuple[int, str]], logs: np.ndarray):
        self.langs, self.keys, self.logs = langs, keys, logs
        self.tables: list[dict[str, int]] = [{} for _ in range(max(ORDERS) + 1)]
        for place, (order, entry) in enumerate(keys):
            self.tables[order][entry] = place
        self.cache: dict[str, list[int]] = {}

    def _unseen(self, word: str) -> list[int]:
        """For every place of the word the longest known n-gram starting there."""
        edged = f"^{word}$"
        found = []
        for at in range(len(edged) - 1):
            for order in ORDERS:
                piece = edged[at : at + order] if order > 1 else edged[max(at, 1)]
                if len(piece) == order and (row := self.tables[order].get(piece)) is not None:
                    found.append(row)
                    break
        return found

    def entries(self, word: str) -> list[int]:
        """The entries that score a word: its own, or those of its n-grams."""
        known = self.tables[0].get(word)
        if known is not None:
            return [known]
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= CACHE:
                self.cache.clear()
            found = self.cache[word] = self._unseen(word)
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        """Best language and its share of the likelihood per word; ties go to the first name."""
        words = Counter(words_of(text)) if text else None
        if not words or not self.langs:
            return UNKNOWN, 0.0
        rows: list[int] = []
        weights: list[float] = []
        for word, n in words.items():
            own = self.entries(word)
            rows += own
            weights += [n / len(own)] * len(own) if own else ()
        total = np.array(weights) @ self.logs[rows] if rows else np.zeros(len(self.langs))
        best = int(total.argmax())
        share = np.exp(np.clip((total - total[best]), -700.0, 0.0))
        return self.langs[best], float(1.0 / share.sum())


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    max_train_docs: int = MAX_TRAIN_DOCS,
    max_entries: int = MAX_ENTRIES,
) -> LanguageModel:
    """Fit on rows with text and language. Of languages with more than ``max_train_docs``
    rows, about that many are taken, each row by itself; rarer ones are taken whole. Repeated rows
    count each; other columns are not read."""
    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = with_row(rows.where("lang is not null and text is not null"))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    share = F.least(F.lit(1.0), F.lit(float(max_train_docs)) / F.col("rows"))
    sizes = stored(sizes.select("lang", share.alias("share")), "lang-shares")
    few = sizes.limit(NAMED_LANGUAGES + 1).collect()
    place = F.pmod(F.xxhash64(F.lit("sample"), ROW, "text"), F.lit(1_000_003)) / 1_000_003
    if not few:
        return LanguageModel([], [], np.zeros((0, 0)))
    if len(few) <= NAMED_LANGUAGES:
        shares = F.create_map(*(F.lit(x) for r in few for x in (r["lang"], r["share"])))
        sample = rows.where(place < shares[F.col("lang")])
    else:
        sample = rows.join(sizes, "lang").where(place < F.col("share"))
    counts = map_arrow(sample.select("lang", "text"), _count, "lang string, order int, entry string, n long")
    counts = stored(counts.groupBy("lang", "order", "entry").agg(F.sum("n").alias("n")), "lang-counts")

    totals = {(r[0], r[1]): r[2] for r in counts.groupBy("lang", "order").agg(F.sum("n")).collect()}
    langs = sorted({lang for lang, _ in totals})
    by_order = dict(counts.groupBy("order").agg(F.countDistinct("entry")).collect())
    # Each language names its most frequent entries; ties by entry, so that the model is one.
    own = Window.partitionBy("lang").orderBy(F.desc("n"), "order", "entry")
    ranked = counts.withColumn("at", F.row_number().over(own))
    wide = ranked.groupBy("order", "entry").agg(
        F.min("at").alias("at"), F.collect_list("lang").alias("langs"), F.collect_list("n").alias("ns")
    )
    kept = wide.where(F.col("at") <= max(1, max_entries // max(1, len(langs))))
    found = kept.orderBy("order", "entry").select("order", "entry", "langs", "ns").toArrow()
    orders, entries = found["order"].to_numpy(), found["entry"].to_pylist()
    seen = np.zeros((len(entries), len(langs)))
    if entries:
        named, ns = (found[c].combine_chunks() for c in ("langs", "ns"))
        column = {lang: i for i, lang in enumerate(langs)}
        at = np.fromiter((column[x] for x in named.flatten().to_pylist()), np.int64)
        seen[np.repeat(np.arange(len(entries)), np.diff(named.offsets)), at] = ns.flatten().to_numpy()
    # What each language would have if every entry of the order occurred half a time more.
    whole = np.zeros((max(ORDERS) + 1, len(langs)))
    for order, distinct in by_order.items():
        whole[order] = [totals.get((lang, order), 0) + 0.5 * distinct for lang in langs]
    logs = np.log((seen + 0.5) / whole[orders]) if entries else seen
    return LanguageModel(langs, list(zip(orders.tolist(), entries)), logs)


def detect_language(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score`` added.

    Only the text is looked at. Null texts and texts without a letter are ``und`` with score
    0, as are all texts under a model without languages. Repeated rows are predicted alike;
    columns named like the results are replaced.
    """
    rest = [c for c in docs.columns if c not in (text_col, "lang_pred", "score")]
    sent = docs.sparkSession.sparkContext.broadcast((model.langs, model.keys, model.logs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LanguageModel(*sent.value)
        for batch in batches:
            found = [own.predict(text.as_py()) for text in batch.column("__text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in rest),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=[*rest, "lang_pred", "score"],
            )

    texts = docs.select(*rest, F.col(text_col).cast("string").alias("__text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in texts.drop("__text").dtypes)
    return map_arrow(texts, run, f"{kinds}, lang_pred string, score double")


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds))
