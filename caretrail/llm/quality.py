"""Quality classifier learned from positives and unlabelled text (PU learning).

Trusted positives are documents labelled good; the unlabelled ones are web text of unknown quality. A logistic model on the
features of a text minimises the non-negative unbiased risk

    prior * R(positives as good) + max(0, R(unlabelled as bad) - prior * R(positives as bad))

with the logistic loss: where the second term falls below zero, which only overfitting can bring about, the step goes against
it. The prior, the share of good text, is estimated as the least ratio, over thresholds, of the share of unlabelled to that of
positive scores above it (for a first model that tells the two samples apart), so no negative label is used.

Features are shares over the whole text, computed from byte and word counts: how its characters divide over classes,
how often words or lines repeat, how words look. They do not depend on language words, ids, labels or sources.

Defined cases: a null text is an empty one; an empty text has all-zero features and gets the score of the intercept; repeated
rows each count and each get a score; an empty table gives an empty one, and rows with equal texts tie. No column name is reserved: a kept column
that has the name of the result gets `_in` behind it. Without positives or unlabelled texts the model scores one half for all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from caretrail.llm.names import laid_out
from caretrail.llm.stored import small_batches, tidy

CLASSES = ("lower", "upper", "digit", "space", "newline", "sentence", "quote", "bracket", "dash", "symbol", "pipe", "beyond", "control")


def _class_table() -> np.ndarray:
    table = np.full(256, CLASSES.index("symbol"), np.int64)
    for name, members in (
        ("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", b" \t"), ("newline", b"\n\r"),
        ("sentence", b".,;:?"), ("quote", b"'\"`"), ("bracket", b"()[]{}<>"), ("dash", b"-_/"), ("pipe", b"|"),
        ("beyond", range(128, 256)), ("control", [*range(0, 9), 11, 12, *range(14, 32), 127]),
    ):
        table[list(members)] = CLASSES.index(name)
    return table


CLASS_OF = _class_table()
N = len(CLASSES)
NAMES = [
    *CLASSES, *(f"{a}>{b}" for a in CLASSES for b in CLASSES), "short", "word_length", "long_words", "distinct_words",
    "same_as_last", "top_word", "capital_words", "shouted_words", "marked_words", "distinct_lines", "line_length",
]


# No feature is above it: the mean length of words, in tens, is the only one that is no share.
MOST = 8.0


def features(text: str | None) -> np.ndarray:
    """The features of a whole text: class shares, shares of class pairs, and word and line statistics."""
    out = np.zeros(len(NAMES), np.float32)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    kinds = CLASS_OF[raw]
    out[:N] = np.bincount(kinds, minlength=N) / len(raw)
    if len(raw) > 1:
        out[N : N + N * N] = np.bincount(kinds[:-1] * N + kinds[1:], minlength=N * N) / (len(raw) - 1)
    words, at = text.split(), N + N * N
    if words:
        counts: dict[str, int] = {}
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        n = len(words)
        lengths = sum(map(len, words))
        out[at : at + 9] = (
            1 / (1 + n / 20),
            min(lengths / n / 10, MOST),
            sum(c for w, c in counts.items() if len(w) > 24) / n,
            (len(counts) / n) * min(1.0, n / 400) ** 0.25,
            sum(map(str.__eq__, words, words[1:])) / n,
            max(counts.values()) / n * min(1.0, n / 50),
            sum(c for w, c in counts.items() if w[0].isupper()) / n,
            sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / n,
            sum(c for w, c in counts.items() if len(w) > 1 and not w[-1].isalnum() and not w[-2].isalnum()) / n,
        )
    lines = text.split("\n")
    out[at + 9] = len(set(lines)) / len(lines)
    out[at + 10] = min(1.0, len(text) / len(lines) / 500)
    return out


class Model:
    """Scale, weights and intercept; `score` is the probability that a text is good."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, intercept: float, prior: float):
        self.mean, self.scale, self.weights, self.intercept, self.prior = mean, scale, weights, intercept, prior

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.intercept

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


# For thresholds (ascending): how many scores are at or above each, and how many there are.
Above = Callable[[np.ndarray], tuple[np.ndarray, int]]
# Margins are compared in so many digits, whatever batch they were worked out in.
DIGITS = 9
# Features are added up as whole numbers of this unit: squares of a batch stay below 2 ** 63.
UNIT = float(1 << 20)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _adam(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    theta, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(theta)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta


def estimate_prior(positive: np.ndarray, above: np.ndarray | Above, least_share: float = 0.1) -> float:
    """Share of good among the unlabelled scores: unlabelled = prior * positive + rest, so where the rest has nothing the
    ratio of the two shares above a threshold is the prior. The least ratio over thresholds that keep enough of both.

    `above` are the unlabelled scores, or gives for thresholds how many are at or above each, and how many there are.
    """
    cuts = np.quantile(positive, np.linspace(0, 1 - least_share, 60))
    counts, total = above(cuts) if callable(above) else (np.array([(above >= c).sum() for c in cuts]), len(above))
    high_p, high_u = np.array([(positive >= c).mean() for c in cuts]), counts / total
    ratio = (high_u + 1 / np.sqrt(total) * np.sqrt(high_u * (1 - high_u))) / np.maximum(high_p, 1e-9)
    return float(np.clip(ratio.min(), 0.05, 0.98))


def fit(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, l2: float = 1e-3, steps: int = 400, rate: float = 0.04,
    spread: tuple[np.ndarray, np.ndarray] | None = None, above: Callable[[Model], Above] | None = None,
) -> Model:
    """Minimise the non-negative risk; the prior is estimated where none is given.

    `spread` (mean and deviation of the features) and `above` (of a model's margins) are those of the unlabelled vectors where not given.
    """
    size = len(NAMES)
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(size), np.ones(size), np.zeros(size), 0.0, 0.5)
    mean, scale = spread or (unlabelled.mean(axis=0), unlabelled.std(axis=0))
    scale = scale + 0.02
    p, u = (np.clip((x.astype(np.float64) - mean) / scale, -8, 8) for x in (positive, unlabelled))
    p, u = (np.hstack([x, np.ones((len(x), 1))]) for x in (p, u))
    ridge = (l2 + 3 / len(p)) * np.r_[np.ones(size), 0]  # few positives bear few free weights
    if prior is None:
        # Positive against unlabelled; its scores order texts by quality.
        apart = _adam(
            lambda w: -(p.T @ _sigmoid(-(p @ w))) / len(p) + u.T @ _sigmoid(u @ w) / len(u) + 10 * ridge * w, size + 1, steps // 2, rate
        )
        first = Model(mean, scale, apart[:-1], float(apart[-1]), 0.5)
        prior = estimate_prior(np.round(p @ apart, DIGITS), above(first) if above else np.round(u @ apart, DIGITS))

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        rest = _softplus(zu).mean() - prior * _softplus(zp).mean()
        as_good = -prior * (p.T @ _sigmoid(-zp)) / len(p)
        as_bad = u.T @ _sigmoid(zu) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        return (as_good + as_bad if rest >= 0 else -as_bad) + ridge * w

    theta = _adam(gradient, size + 1, steps, rate)
    return Model(mean, scale, theta[:-1], float(theta[-1]), prior)


def with_features(df: DataFrame, text: str, keep: tuple[str, ...], model: Model | None = None, name: str = "score") -> DataFrame:
    """The kept columns with the features (binary), or with the score where a model is given; no shuffle."""
    small_batches(df.sparkSession)
    name, kind = ("features", "binary") if model is None else (name, "double")
    source, schema = laid_out(df, keep, F.col(text), StructType().add(name, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(len(keep)))
            values = pa.array([r.tobytes() for r in x], pa.binary()) if model is None else pa.array(model.score(x.astype(np.float64)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], values], names=schema.names)

    return source.mapInArrow(tidy(run), schema)


def _matrix(texts: pa.Array) -> np.ndarray:
    rows = [features(t.as_py()) for t in texts]
    return np.stack(rows) if rows else np.zeros((0, len(NAMES)), np.float32)


def _totals(df: DataFrame, text: str, size: int, of_batch: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """Sums over all rows of whole numbers that `of_batch` gives for a matrix of features: `size` of them and the count of rows.

    A task sends its own sums only, and whole numbers add up to the same in any order.
    """
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(size + 1, object)
        for batch in batches:
            sums[:size] += of_batch(_matrix(batch.column(0)).astype(np.float64)).astype(object)
            sums[size] += batch.num_rows
        values = pa.array([Decimal(int(v)) for v in sums], pa.decimal128(28, 0))
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), values], names=["i", "n"])

    parts = df.select(F.col(text).alias("c0")).mapInArrow(tidy(run), "i int, n decimal(28,0)")
    found = {r.i: int(r.n) for r in parts.groupBy("i").agg(F.sum("n").alias("n")).collect()}
    return [found.get(i, 0) for i in range(size + 1)]


def spread_of(df: DataFrame, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of every feature over all rows."""
    size = len(NAMES)

    def of_batch(x: np.ndarray) -> np.ndarray:
        whole = np.round(x * UNIT).astype(np.int64)
        return np.concatenate([whole.sum(axis=0), (whole * whole).sum(axis=0)])

    *sums, rows = _totals(df, text, 2 * size, of_batch)
    rows = max(rows, 1)
    mean = np.array([v / rows / UNIT for v in sums[:size]])
    variance = [max(0, rows * b - a * a) / rows / rows / UNIT / UNIT for a, b in zip(sums[:size], sums[size:], strict=True)]
    return mean, np.sqrt(np.array(variance))


def margins_above(df: DataFrame, model: Model, text: str = "text") -> Above:
    """How many rows have a margin at or above each of some thresholds."""

    def above(cuts: np.ndarray) -> tuple[np.ndarray, int]:
        def of_batch(x: np.ndarray) -> np.ndarray:
            margins = np.sort(np.round(model.margin(x), DIGITS))
            return len(margins) - np.searchsorted(margins, cuts, "left")

        *counts, rows = _totals(df, text, len(cuts), of_batch)
        return np.array(counts, np.float64), max(rows, 1)

    return above


def held_out(doc_id: Column) -> Column:
    """One document in five, by its id; a null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def _sampled(df: DataFrame, most: int, seed: int) -> DataFrame:
    """About `most` rows by hash of the text and the id, without a sort of the table."""
    total = df.count()
    if total <= most:
        return df
    return df.where(F.xxhash64("__text", "doc_id", F.lit(seed)).bitwiseAND((1 << 30) - 1) < int((1 << 30) * most / total))


def train(documents: DataFrame, labels: DataFrame, most: int = 5_000) -> Model:
    """Fit on the training rows: labelled good against unlabelled, about `most` of each at most, drawn by hash.

    Mean and spread of the features and the class prior come from all documents, in one pass each. Only the weights rest on the
    sample (vectors of 770 bytes, one for each id drawn), which is all that comes to the driver.
    """
    learn = labels.where(~held_out(F.col("doc_id"))).select("doc_id", "quality")
    good = learn.where("quality = 1").select("doc_id").distinct()
    texts = documents.select("doc_id", F.col("text").alias("__text"))
    positive = _sampled(good.withColumn("__text", F.lit("")), most, 1).select("doc_id")
    # The sampled ids are about `most`, so they go to every task; the texts stay where they are.
    positive = texts.join(F.broadcast(positive), "doc_id")
    unlabelled = _sampled(texts.select("doc_id", F.xxhash64("__text").alias("__text")), most, 2).select("doc_id").distinct()
    unlabelled = texts.join(F.broadcast(unlabelled), "doc_id")

    def vectors(df: DataFrame) -> np.ndarray:
        # An id that many rows have gives one vector.
        rows = with_features(df, "__text", ("doc_id",)).groupBy("doc_id").agg(F.min("features").alias("features")).select("features").collect()
        rows = sorted(bytes(r[0]) for r in rows)  # the same model whatever the order of the rows
        return np.stack([np.frombuffer(r, np.float32) for r in rows]) if rows else np.zeros((0, len(NAMES)), np.float32)

    p, u = vectors(positive), vectors(unlabelled)
    if not len(p) or not len(u):
        return fit(p, u)
    return fit(p, u, spread=spread_of(texts, "__text"), above=lambda first: margins_above(texts, first, "__text"))


def quality_scores(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    model = train(documents, labels)
    return with_features(documents, "text", ("doc_id",), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """`documents` without the rows that the model rejects; same columns."""
    columns = documents.columns
    scored = with_features(documents, "text", tuple(columns), train(documents, labels))
    places = [f"c{i}" for i in range(len(columns))]
    return scored.toDF(*places, "score").where(F.col("score") >= threshold).select(*places).toDF(*columns)
