"""Quality classifier: a regularised quadratic discriminant over document statistics.

Each text becomes a short vector of transformed statistics (log ratios of character classes,
word shape, repetition). One class has one mean and one covariance; the covariance is shrunk
towards its own diagonal and towards the covariance of both classes, which keeps it positive
definite however few rows a class has. A score is the difference of the two Gaussian log
densities (squared Mahalanobis distance by triangular solve with the Cholesky factor, plus its
log determinant) plus the log prior ratio, passed through the logistic curve.

The fit needs only counts, sums and sums of products per class. They are added up by Spark over
all labelled rows, so nothing is sampled and nothing that grows reaches the driver.

Defined results: a null text counts as an empty one; an empty text has the statistics of no
characters and gets a score like any other. Repeated rows are scored each for itself and count
each in the fit. Labels that are null or not 0/1 are ignored. With no labelled row of one of the
classes every score is the prior of the labels seen (0.5 without any).
"""

from __future__ import annotations

import itertools
import operator
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from shelfwise.llm import caches
from shelfwise.session import written

#: Fixed order of the statistics of one text.
STATISTICS = (
    "log_chars", "log_words", "upper", "digit", "symbol", "bang", "pipe", "stop", "comma",
    "newline", "word_length", "distinct", "distinct_log", "repeat", "longest_run", "decorated",
    "capital_words", "common_share", "sentence_length", "repeated_lines",
)
SHRINK_TO_DIAGONAL = 0.2
SHRINK_TO_POOLED = 0.1
#: Added to every variance, in units of squared log ratios.
RIDGE = 0.1
#: Ids of at most so many label rows are broadcast to pick rows out of the texts.
BROADCAST_ROWS = 2_000_000

_DECORATED = re.compile(r"[#$%&*@^~!|](?!\S)")
_CAPITALS = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{2,}\b")
_CLASSES = np.zeros((256, 8))
for _column, _members in enumerate((
    range(65, 91), range(48, 58), b"#$%&*@^~_=+<>{}[]\\/", b"!?", b"|", b".", b",;:", b"\n",
)):
    _CLASSES[list(_members), _column] = 1


def statistics_of(text: str | None) -> list[float]:
    """The transformed statistics of one whole text, in the order of ``STATISTICS``."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    upper, digit, symbol, bang, pipe, stop, comma, newline = (
        np.bincount(raw, minlength=256) @ _CLASSES
    )
    words = text.split()
    chars, n = len(text), len(words)

    def share(count: float, total: float, usual: float, weight: float = 20.0) -> float:
        """Log of a share, drawn to its usual value where the total is small."""
        return float(np.log((count + usual * weight) / (total + weight) + 1e-4))

    seen = Counter(words)
    repeats = sum(map(operator.eq, words, itertools.islice(words, 1, None)))
    longest = max((len([*same]) for _, same in itertools.groupby(words)), default=1) - 1 if (
        repeats) else 0
    decorated, capital = len(_DECORATED.findall(text)), len(_CAPITALS.findall(text))
    lines = [line for line in text.split("\n") if line]
    return [
        np.log1p(chars),
        np.log1p(n),
        share(upper, chars, 0.02, 200.0),
        share(digit, chars, 0.002, 200.0),
        share(symbol, chars, 0.001, 200.0),
        share(bang, chars, 0.001, 200.0),
        share(pipe, chars, 0.001, 200.0),
        share(stop, chars, 0.015, 200.0),
        share(comma, chars, 0.008, 200.0),
        share(newline, chars, 0.002, 200.0),
        float(np.log((chars + 20 * 6) / (n + 20))),
        share(len(seen), n, 0.8),
        float(np.log1p(len(seen)) / np.log1p(n + 1)),
        share(repeats, n, 0.01),
        np.log1p(longest),
        share(decorated, n, 0.01),
        share(capital, n, 0.01),
        share(max(seen.values(), default=0), n, 0.08),
        float(np.log((n + 10) / (stop + bang + 1))),
        share(len(lines) - len(set(lines)), len(lines), 0.02),
    ]


@F.pandas_udf(ArrayType(DoubleType()))
def statistics(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    caches.claim("quality")
    for batch in texts:
        yield batch.map(lambda text: [float(x) for x in statistics_of(text)])


@dataclass
class Gaussian:
    """One class: its mean, and the Cholesky factor of its covariance, factored once."""

    mean: np.ndarray
    covariance: np.ndarray
    inverse_factor: np.ndarray = field(init=False)
    log_determinant: float = field(init=False)

    def __post_init__(self):
        factor = np.linalg.cholesky(self.covariance)
        self.inverse_factor = np.linalg.solve(factor, np.eye(len(factor)))
        self.log_determinant = 2 * float(np.log(np.diag(factor)).sum())

    def log_density(self, x: np.ndarray) -> np.ndarray:
        whitened = (x - self.mean) @ self.inverse_factor.T
        return -0.5 * ((whitened**2).sum(1) + self.log_determinant)


@dataclass
class Discriminant:
    """``score`` gives the probability-like score of class 1 for rows of statistics."""

    prior: float = 0.5
    classes: tuple[Gaussian, Gaussian] | None = None

    def margin(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), np.log(self.prior / (1 - self.prior)))
        bad, good = self.classes
        ratio = np.log(self.prior / (1 - self.prior))
        return good.log_density(x) - bad.log_density(x) + ratio

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.margin(x), -35, 35)
        return 1 / (1 + np.exp(-z))

    def udf(self):
        @F.pandas_udf(DoubleType())
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                x = np.array(batch.tolist()).reshape(len(batch), len(STATISTICS))
                yield pd.Series(self.score(x))

        return score

    def text_udf(self):
        """The score of a text in one Python pass: statistics and densities in one worker."""
        @F.pandas_udf(DoubleType())
        def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            caches.claim("quality")
            for batch in batches:
                x = np.array([statistics_of(text) for text in batch])
                yield pd.Series(self.score(x.reshape(len(batch), len(STATISTICS))))

        return score


def _sums(rows: DataFrame, vector: str, label: str) -> dict[int, np.ndarray]:
    """Per class the sum of (1, x)(1, x)^T: a square of known size from each task, added up."""
    size = len(STATISTICS) + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {0: np.zeros((size, size)), 1: np.zeros((size, size))}
        for batch in batches:
            for k, total_k in total.items():
                x = batch.loc[batch["label"] == k, "x"].tolist()
                if x:
                    x = np.hstack([np.ones((len(x), 1)), np.array(x)])
                    total_k += x.T @ x
        cells = range(size * size)
        yield pd.DataFrame({
            "label": np.repeat([0, 1], size * size),
            "cell": [*cells, *cells],
            "value": np.concatenate([total[0].ravel(), total[1].ravel()]),
        })

    small = rows.select(F.col(label).cast("int").alias("label"), F.col(vector).alias("x"))
    parts = small.filter("label in (0, 1)").mapInPandas(partial, "label int, cell int, value double")
    out = {0: np.zeros(size * size), 1: np.zeros(size * size)}
    for row in parts.groupBy("label", "cell").agg(F.sum("value").alias("value")).collect():
        out[row["label"]][row["cell"]] = row["value"]
    return {k: v.reshape(size, size) for k, v in out.items()}


def discriminant(sums: dict[int, np.ndarray]) -> Discriminant:
    """The classifier for given class sums."""
    n = {k: s[0, 0] for k, s in sums.items()}
    prior = (n[1] + 1) / (n[0] + n[1] + 2)
    if min(n.values()) < 2:
        return Discriminant(prior)
    mean = {k: s[0, 1:] / n[k] for k, s in sums.items()}
    scatter = {k: s[1:, 1:] - n[k] * np.outer(mean[k], mean[k]) for k, s in sums.items()}
    pooled = (scatter[0] + scatter[1]) / (n[0] + n[1])
    classes = []
    for k in (0, 1):
        own = scatter[k] / n[k]
        own = (1 - SHRINK_TO_POOLED) * own + SHRINK_TO_POOLED * pooled
        own = (1 - SHRINK_TO_DIAGONAL) * own + SHRINK_TO_DIAGONAL * np.diag(np.diag(own))
        classes.append(Gaussian(mean[k], own + RIDGE * np.eye(len(own))))
    return Discriminant(prior, (classes[0], classes[1]))


def labelled(labels: DataFrame, label: str, fold: int, held_out: int) -> DataFrame:
    """(doc_id, label) of rows to learn from: one row a document, the held-out fold left out.

    A document with contradictory labels takes the larger one.
    """
    fold_of = F.crc32(F.col("doc_id").cast("string")) % fold
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold_of != held_out))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )


def fit(described: DataFrame, labels: DataFrame, fold: int = 3, held_out: int = 1) -> Discriminant:
    """Learn from ``described`` (doc_id, x: statistics) and ``labels`` (doc_id, quality)."""
    rows = described.select("doc_id", "x").join(
        labelled(labels, "quality", fold, held_out), "doc_id"
    )
    return discriminant(_sums(rows, "x", "label"))


def described(documents: DataFrame) -> DataFrame:
    """(doc_id, x) for every row."""
    return documents.select("doc_id", statistics(F.col("text")).alias("x"))


def classify(documents: DataFrame, labels: DataFrame, fold: int = 3, held_out: int = 1):
    """(doc_id, held_out, score, predicted) for every row of ``documents``.

    The statistics are stored once: they are read for the fit and again for the scores.
    """
    stored = written(described(documents), "quality_statistics")
    model = fit(stored, labels, fold, held_out)
    scored = stored.select("doc_id", model.udf()(F.col("x")).alias("score"))
    return scored.select(
        "doc_id",
        (F.coalesce(F.crc32(F.col("doc_id").cast("string")) % fold, F.lit(-1)) == held_out)
        .alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, learn_from: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents`` that the classifier accepts, all columns as they are.

    Learns from the labelled rows of ``learn_from``; each row is judged by its own text. Texts
    are never shuffled: a short list of labelled ids is broadcast to them, beyond
    ``BROADCAST_ROWS`` every row is described and only its statistics meet the labels.
    """
    ids = labels.filter(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    if labels.count() <= BROADCAST_ROWS:
        learn_from = learn_from.join(F.broadcast(ids), "doc_id", "left_semi")
    known = written(described(learn_from), "quality_labelled")
    score = fit(known, labels).text_udf()
    return documents.filter(score(F.col("text")) >= 0.5)
