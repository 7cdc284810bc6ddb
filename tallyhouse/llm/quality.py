"""Quality classifier: a regularised quadratic discriminant over transformed text statistics.

Each class is a Gaussian whose covariance is shrunk towards its own diagonal and the pooled
covariance. A score is the logistic of the difference of log densities, computed from
Mahalanobis distances by triangular solves against Cholesky factors, which are made once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import by_batch, held_out, keep, sql_type, text_of

FEATURES = (
    "symbols", "bars", "shouts", "stops", "commas", "upper_words", "capitals", "digits",
    "repeated", "stuck", "markup", "word_length", "line_words", "twin_lines",
)
# Rates of plain prose that a text of no words is taken to have, and how many words and lines they
# count for: a short text is judged by what it shows against these, not by the noise of few words.
PRIOR_WORDS = 40
PRIOR_LINES = 4
STOPS, COMMAS, CAPITALS, WORD_LENGTH, LINE_WORDS = 0.1, 0.06, 0.1, 6.0, 40.0
SHRINK_DIAGONAL = 0.1
SHRINK_POOLED = 0.1
RIDGE = 1e-4
TEMPER = 0.5  # statistics of one text depend on each other, so densities of all of them are too sure
THRESHOLD = 0.3


def statistics(text: str) -> list[float]:
    """The features of one whole text, in the order of ``FEATURES``.

    Shares are counts per word under a square root, which spreads the small ones; sizes are logs.
    """
    words = text.split()
    n = len(words)
    data = text.encode()
    size, some = len(data), n + PRIOR_WORDS

    def count(marks: bytes) -> int:
        return size - len(data.translate(None, marks))

    lines = [line for line in text.split("\n") if line.strip()]
    shares = [
        count(b"#*$%&<>"), data.count(b"|"), data.count(b"!"), count(b".?:;") + STOPS * PRIOR_WORDS, data.count(b",") + COMMAS * PRIOR_WORDS,
        sum(map(str.isupper, words)), count(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ") + CAPITALS * PRIOR_WORDS, count(b"0123456789"),
        n - len(set(words)), sum(map(str.__eq__, words[1:], words)), count(b"{}[]()=/\\_~^@"),
    ]
    sizes = [(sum(map(len, words)) + WORD_LENGTH * PRIOR_WORDS) / some, (n + LINE_WORDS * PRIOR_LINES) / (len(lines) + PRIOR_LINES)]
    twins = (len(lines) - len(set(lines))) / (len(lines) + PRIOR_LINES)
    return [*np.sqrt(np.array(shares) / some), *np.log(sizes), twins**0.5]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``f``, an array of the statistics of every whole text. Null counts as empty."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = np.array([statistics(text) for text in batch.column(1).to_pylist()])
        edges = pa.array(np.arange(len(made) + 1, dtype=np.int32) * len(FEATURES))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(edges, pa.array(made.ravel()))], ["doc_id", "f"])

    rows = docs.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text"))
    return by_batch(rows, work, f"doc_id {sql_type(rows, 'doc_id')}, f array<double>")


@dataclass(frozen=True)
class Discriminant:
    """Class sizes, means and shrunk covariances; class 1 is the one that scores near 1."""

    sizes: np.ndarray
    means: np.ndarray
    covariances: np.ndarray

    @cached_property
    def factors(self) -> np.ndarray:
        """Inverse Cholesky factors, one per class."""
        return np.stack([np.linalg.inv(np.linalg.cholesky(c)) for c in self.covariances])

    @cached_property
    def log_volumes(self) -> np.ndarray:
        return np.array([-2 * np.log(np.diagonal(f)).sum() for f in self.factors])

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Score of each row of statistics. With one class only, its smoothed share for all."""
        prior = np.log((self.sizes[1] + 1) / (self.sizes[0] + 1))
        if self.sizes.min() < 2:
            return np.full(len(x), 1 / (1 + np.exp(-prior)))
        logs = [-0.5 * ((((x - m) @ f.T) ** 2).sum(axis=1) + v) for m, f, v in zip(self.means, self.factors, self.log_volumes)]
        return 1 / (1 + np.exp(-np.clip(TEMPER * (logs[1] - logs[0]) + prior, -60, 60)))


def shrunk(sizes: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Discriminant:
    """A discriminant from each class's row count, sums, and sums of products."""
    d = sums.shape[1]
    means = sums / np.maximum(sizes, 1)[:, None]
    raw = squares / np.maximum(sizes, 1)[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (raw * sizes[:, None, None]).sum(axis=0) / max(sizes.sum(), 1)
    diagonal = raw * np.eye(d)
    mixed = (1 - SHRINK_DIAGONAL - SHRINK_POOLED) * raw + SHRINK_DIAGONAL * diagonal + SHRINK_POOLED * pooled
    scale = np.maximum(np.diagonal(pooled), 1.0 / max(sizes.sum(), 1))
    return Discriminant(sizes, means, mixed + (RIDGE * np.diag(np.maximum(scale, RIDGE)))[None])


def fit(made: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> Discriminant:
    """Learn from all labelled rows whose id is not held out.

    ``made`` comes from ``features`` and is stored. Rows of labels that are null or neither 0 nor
    1 are left out. Sums per class are all that reaches the driver.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
    d = len(FEATURES)
    flat = made.join(known, "doc_id").select("label", *[F.col("f")[i].alias(f"f{i}") for i in range(d)])
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = [F.sum(f"f{i}") for i in range(d)] + [F.sum(F.col(f"f{i}") * F.col(f"f{j}")) for i, j in pairs]
    sizes, first, second = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for row in flat.groupBy("label").agg(F.count("*"), *sums).collect():
        sizes[row[0]], first[row[0]] = row[1], row[2 : 2 + d]
        for (i, j), value in zip(pairs, row[2 + d :]):
            second[row[0], i, j] = second[row[0], j, i] = value
    return shrunk(sizes, first, second)


def score(made: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for rows of ``features``."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["doc_id", "score"])

    scored = by_batch(made, work, f"doc_id {sql_type(made, 'doc_id')}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """Score of every whole text, from statistics of the text alone.

    Columns: ``doc_id``, ``held_out``, ``score``, ``predicted``. Empty and null texts are scored
    like others, as plain prose of no words. Without labels of both classes every text gets
    the smoothed share of the class there is (one half without any). Null and repeated ids and
    rows give a row each, a null id is not held out; an empty table gives none.
    """
    made = keep(features(docs, id_col, text_col), "features")
    return score(made, fit(made, labels, id_col, label_col), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns as they are.

    The verdict is taken beside the row, so no id has to be unique.
    """
    model = fit(keep(features(docs, id_col, text_col), "features"), labels, id_col, label_col)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.array([statistics(text) for text in batch.column(1).to_pylist()])
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], ["row", "score"])

    rows = docs.select(F.struct(F.col("*")).alias("row"), text_of(text_col).alias("text"))
    scored = by_batch(rows, work, f"row {sql_type(rows, 'row')}, score double")
    return scored.filter(F.col("score") >= threshold).select("row.*")
