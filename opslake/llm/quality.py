"""Document quality by co-training two classifiers on two views.

The text view sees words and how they are used; the metadata view sees source, language,
size and layout. Both are logistic regressions fitted on the labelled rows. In each round
either view labels documents of an unlabelled pool; those it is sure of train the other view
in the next round, unless that view leans the other way. In the end each view is calibrated
on labelled rows kept out of training, a last regression combines the two calibrated views,
and all documents are scored whole.

Fitting uses bounded samples, chosen by hash: ``max_labelled`` labelled rows and ``max_pool``
pool rows, of which the driver gets word numbers and statistics, no texts. Scoring reads the
documents where they are scanned; nothing of the corpus is shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.common import ROW, map_arrow, stored, with_row

MAX_LABELLED = 8_000
MAX_POOL = 8_000
ROUNDS = 2
SURE = 0.98
VOCABULARY = 20_000
MIN_DOCS = 3
THRESHOLD = 0.5
PENALTY = 1e-3
ITERATIONS = 100
# Slots that names of sources and languages are hashed into.
NAME_SLOTS = 4096

TOKEN = regex.compile(r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+")
META_NAMES = ("source", "lang")
VIEWS = ("text", "meta")


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def text_numbers(text: str, tokens: list[str]) -> list[float]:
    """Share of distinct words, share of symbols, mean length of a word."""
    symbols = sum(len(t) for t in tokens if not t[0].isalnum())
    n = max(1, len(tokens))
    return [len(set(tokens)) / n, symbols / max(1, len(text)), len(text) / n / 10]


def meta_numbers(text: str) -> list[float]:
    """Size, lines, length of a line, share of distinct lines."""
    lines = text.split("\n")
    size = np.log1p([len(text), len(lines), len(text) / len(lines)])
    return [*(size / 10).tolist(), len(set(lines)) / len(lines)]


def name_slots(names: Sequence[str | None]) -> list[int]:
    """A slot for each name, with the kind of name; a missing name has none."""
    return [
        zlib.crc32(f"{kind}={name}".encode()) % NAME_SLOTS
        for kind, name in zip(META_NAMES, names)
        if name is not None
    ]


@dataclass
class Rows:
    """Sparse rows: ones at the given places, and a few numbers after all places."""

    places: list[np.ndarray]
    numbers: np.ndarray
    width: int

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, column and value of every entry."""
        n, extra = self.numbers.shape
        sizes = [len(p) for p in self.places]
        row = np.concatenate([np.repeat(np.arange(n), sizes), np.repeat(np.arange(n), extra)])
        column = np.concatenate([*self.places, np.tile(self.width + np.arange(extra), n)])
        value = np.concatenate([np.ones(sum(sizes)), self.numbers.ravel()])
        return row, column.astype(np.int64), value

    def take(self, rows: np.ndarray) -> Rows:
        return Rows([self.places[i] for i in rows], self.numbers[rows], self.width)

    def __add__(self, other: Rows) -> Rows:
        return Rows(
            self.places + other.places, np.concatenate([self.numbers, other.numbers]), self.width
        )


@dataclass
class Logistic:
    """A fitted logistic regression."""

    weights: np.ndarray
    intercept: float

    @classmethod
    def fit(cls, rows: Rows, labels: np.ndarray, penalty: float = PENALTY) -> Logistic:
        """Least mean log loss plus an L2 penalty on weights of features of unit deviation,
        by limited-memory BFGS."""
        row, column, value = rows.flat()
        n, width = len(labels), rows.width + rows.numbers.shape[1]
        mean = np.bincount(column, value, width) / n
        square = np.bincount(column, value**2, width) / n
        deviation = np.sqrt(np.maximum(square - mean**2, 0))
        scale = np.divide(1, deviation, out=np.zeros(width), where=deviation > 1e-9)
        value = value * scale[column]

        def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
            z = np.bincount(row, value * w[column], n) + w[-1]
            p = 1 / (1 + np.exp(-np.clip(z, -35, 35)))
            cost = np.mean(np.logaddexp(0, z) - labels * z) + penalty / 2 * w[:-1] @ w[:-1]
            slope = (p - labels) / n
            down = np.bincount(column, value * slope[row], width) + penalty * w[:-1]
            return cost, np.append(down, slope.sum())

        w = minimize(loss, np.zeros(width + 1))
        return cls(w[:-1] * scale, float(w[-1]))

    def probability(self, rows: Rows) -> np.ndarray:
        row, column, value = rows.flat()
        z = np.bincount(row, value * self.weights[column], len(rows.places)) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def minimize(loss, start: np.ndarray, steps: int = ITERATIONS, memory: int = 10) -> np.ndarray:
    """Limited-memory BFGS with backtracking."""
    w, (cost, slope) = start, loss(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        direction, kept = slope.copy(), []
        for s, y in reversed(moves):
            a = s @ direction / (s @ y)
            direction -= a * y
            kept.append(a)
        if moves:
            s, y = moves[-1]
            direction *= s @ y / (y @ y)
        for (s, y), a in zip(moves, reversed(kept)):
            direction += s * (a - y @ direction / (s @ y))
        step, gain = 1.0, slope @ direction
        while True:
            after = w - step * direction
            new_cost, new_slope = loss(after)
            if new_cost <= cost - 1e-4 * step * gain or step < 1e-8:
                break
            step /= 2
        s, y = after - w, new_slope - slope
        done = cost - new_cost < 1e-7 * max(1.0, abs(cost))
        w, cost, slope = after, new_cost, new_slope
        if done:
            break
        if s @ y > 1e-12:
            moves = [*moves, (s, y)][-memory:]
    return w


def _logits(*scores: np.ndarray) -> Rows:
    """Scores as rows of log odds."""
    bounded = np.clip(np.stack(scores, axis=1), 1e-9, 1 - 1e-9)
    none = [np.empty(0, np.int64)] * len(bounded)
    return Rows(none, np.log(bounded / (1 - bounded)), 0)


@dataclass
class QualityModel:
    """Both views, their calibration and the combination; or a constant without labels."""

    vocabulary: dict[str, int]
    views: dict[str, Logistic]
    calibration: dict[str, Logistic]
    combination: Logistic | None
    constant: float = 1.0

    def rows(self, texts: list[str | None], names: list[Sequence[str | None]]) -> dict[str, Rows]:
        """Features of both views."""
        words, numbers, metas = [], [], []
        for text in texts:
            tokens = tokens_of(text or "")
            found = {self.vocabulary.get(t, -1) for t in set(tokens)} - {-1}
            words.append(np.fromiter(sorted(found), np.int64, len(found)))
            numbers.append(text_numbers(text or "", tokens))
            metas.append(meta_numbers(text or ""))
        slots = [np.array(name_slots(own), np.int64) for own in names]
        return {
            "text": Rows(words, np.array(numbers).reshape(-1, 3), len(self.vocabulary)),
            "meta": Rows(slots, np.array(metas).reshape(-1, 4), NAME_SLOTS),
        }

    def calibrated(self, rows: dict[str, Rows]) -> list[np.ndarray]:
        raw = {view: self.views[view].probability(rows[view]) for view in VIEWS}
        return [self.calibration[view].probability(_logits(raw[view])) for view in VIEWS]

    def scores(self, texts: list[str | None], names: list[Sequence[str | None]]) -> np.ndarray:
        """Text score, metadata score and score of each document."""
        if self.combination is None:
            return np.full((3, len(texts)), self.constant)
        views = self.calibrated(self.rows(texts, names))
        return np.stack([*views, self.combination.probability(_logits(*views))])


def _inputs(docs: DataFrame, text_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """The kept columns, text and names; a missing column counts as null."""
    names = [
        (F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(f"__{c}")
        for c in META_NAMES
    ]
    return docs.select(*keep, F.col(text_col).cast("string").alias("__text"), *names)


def _names(batch: pa.RecordBatch) -> list[tuple]:
    return list(zip(*(batch.column(f"__{c}").to_pylist() for c in META_NAMES)))


def _sampled(rows: DataFrame, bound: int, size: int, salt: str, id_col: str) -> DataFrame:
    """About ``bound`` of ``size`` rows, by a hash of the id; all of fewer rows."""
    place = F.pmod(F.xxhash64(F.lit(salt), id_col), F.lit(1_000_003)) / 1_000_003
    return rows.where(F.col(id_col).isNotNull() & (place < bound / max(size, 1)))


def _distinct_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 200):
            texts = batch.column("__text").slice(at, 200).to_pylist()
            found = [t for text in texts if text for t in set(tokens_of(text))]
            yield pa.RecordBatch.from_pydict({"token": pa.array(found, pa.string())})


FEATURES = (
    "label double, held boolean, words array<long>, text_numbers array<double>, "
    "slots array<long>, meta_numbers array<double>"
)


def _sample_features(vocabulary: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = QualityModel(vocabulary, {}, {}, None)
        for batch in batches:
            rows = model.rows(batch.column("__text").to_pylist(), _names(batch))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("label"),
                    batch.column("held"),
                    pa.array(rows["text"].places, pa.list_(pa.int64())),
                    pa.array(list(rows["text"].numbers), pa.list_(pa.float64())),
                    pa.array(rows["meta"].places, pa.list_(pa.int64())),
                    pa.array(list(rows["meta"].numbers), pa.list_(pa.float64())),
                ],
                names=["label", "held", "words", "text_numbers", "slots", "meta_numbers"],
            )

    return run


def _as_rows(table: pa.Table, places: str, numbers: str, width: int) -> Rows:
    own = [np.asarray(p.values, np.int64) for p in table[places].combine_chunks()]
    stacked = table[numbers].combine_chunks().flatten().to_numpy()
    return Rows(own, stacked.reshape(len(own), -1), width)


def cotrain(
    rows: dict[str, Rows], labels: np.ndarray, held: np.ndarray, rounds: int, sure: float
) -> tuple[dict, dict, Logistic]:
    """Views, calibration and combination from rows with labels 0 and 1, and nan for the pool."""
    known = ~np.isnan(labels)
    fit_on, check_on = np.flatnonzero(known & ~held), np.flatnonzero(known & held)
    # Where one class is missing in a part, the whole serves for both.
    if len(set(labels[fit_on])) < 2 or len(set(labels[check_on])) < 2:
        fit_on = check_on = np.flatnonzero(known)
    pool = np.flatnonzero(~known)
    pool_rows = {view: rows[view].take(pool) for view in VIEWS}
    sets = {view: (rows[view].take(fit_on), labels[fit_on]) for view in VIEWS}
    for number in range(rounds + 1):
        views = {view: Logistic.fit(*sets[view]) for view in VIEWS}
        if number == rounds or not len(pool):
            break
        p = {view: views[view].probability(pool_rows[view]) for view in VIEWS}
        for view, other in zip(VIEWS, reversed(VIEWS)):
            # Not against the view that is to learn it: a weak view must not mislead.
            good = (p[other] >= sure) & (p[view] >= 0.5)
            poor = (p[other] <= 1 - sure) & (p[view] <= 0.5)
            chosen = np.flatnonzero(good | poor)
            sets[view] = (
                rows[view].take(fit_on) + pool_rows[view].take(chosen),
                np.concatenate([labels[fit_on], good[chosen].astype(float)]),
            )
    model = QualityModel({}, views, {}, None)
    own = {view: rows[view].take(check_on) for view in VIEWS}
    for view in VIEWS:
        raw = _logits(views[view].probability(own[view]))
        model.calibration[view] = Logistic.fit(raw, labels[check_on])
    both = _logits(*model.calibrated(own))
    return views, model.calibration, Logistic.fit(both, labels[check_on])


def train(
    docs: DataFrame,
    labels: DataFrame,
    good: Column,
    text_col: str = "text",
    id_col: str = "doc_id",
    max_labelled: int = MAX_LABELLED,
    max_pool: int = MAX_POOL,
    rounds: int = ROUNDS,
    sure: float = SURE,
) -> QualityModel:
    """Fit on the labelled rows of ``docs``; ``good`` is a condition over ``labels``.

    Rows without id, labels without a value and labels of unknown documents are left out; a
    document with several labels is good if all say so. If one class has no row, nothing can
    be learnt: every document gets the share of good ones, or 1 without any label.
    """
    labels = labels.select(F.col(id_col), good.cast("int").alias("good")).where(
        f"`{id_col}` is not null and good is not null"
    )
    labels = labels.groupBy(id_col).agg(F.min("good").cast("double").alias("label"))
    chosen = stored(_sampled(labels, max_labelled, labels.count(), "label", id_col), "labels")
    source = _inputs(docs, text_col, [id_col])
    # The chosen labels are bounded by max_labelled, so they may be sent to the tasks.
    labelled = source.join(F.broadcast(chosen), id_col)
    pool = _sampled(source, max_pool, source.count(), "pool", id_col)
    pool = pool.join(F.broadcast(chosen.select(id_col)), id_col, "left_anti")
    pool = pool.withColumn("label", F.lit(None).cast("double"))
    held = F.pmod(F.xxhash64(F.lit("held"), id_col), F.lit(4)) == 0
    both = labelled.unionByName(pool).withColumn("held", held)
    both = stored(both, "quality-sample")

    counts = {r[0]: r[1] for r in both.groupBy("label").count().collect()}
    if not counts.get(0.0) or not counts.get(1.0):
        known = counts.get(0.0, 0) + counts.get(1.0, 0)
        return QualityModel({}, {}, {}, None, counts.get(1.0, 0) / known if known else 1.0)

    tokens = map_arrow(both.select("__text"), _distinct_tokens, "token string")
    common = tokens.groupBy("token").count().where(F.col("count") >= MIN_DOCS)
    common = common.orderBy(F.desc("count"), "token").limit(VOCABULARY)
    vocabulary = {r["token"]: i for i, r in enumerate(common.collect())}
    table = map_arrow(both, _sample_features(vocabulary), FEATURES).toArrow()
    rows = {
        "text": _as_rows(table, "words", "text_numbers", len(vocabulary)),
        "meta": _as_rows(table, "slots", "meta_numbers", NAME_SLOTS),
    }
    label = table["label"].to_numpy().astype(float)
    views, calibration, combination = cotrain(
        rows, label, table["held"].to_numpy().astype(bool), rounds, sure
    )
    return QualityModel(vocabulary, views, calibration, combination)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    good: Column,
    text_col: str = "text",
    id_col: str = "doc_id",
    threshold: float = THRESHOLD,
    **options,
) -> DataFrame:
    """One row per row of ``docs``: ``__row``, the id, ``text_score``, ``meta_score``,
    ``score`` (the calibrated probability of a good document) and ``kept`` (score of at least
    ``threshold``).

    Null and empty texts are scored as texts without words, missing source or language as
    no name. Repeated rows score alike; an empty table gives no rows.
    """
    model = train(docs, labels, good, text_col, id_col, **options)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = sent.value.scores(part.column("__text").to_pylist(), _names(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *map(pa.array, found)],
                    names=[ROW, id_col, "text_score", "meta_score", "score"],
                )

    inputs = _inputs(with_row(docs), text_col, [ROW, id_col])
    kind = dict(inputs.dtypes)[id_col]
    ddl = f"{ROW} long, `{id_col}` {kind}, text_score double, meta_score double, score double"
    return map_arrow(inputs, run, ddl).withColumn("kept", F.col("score") >= threshold)
