"""Document quality by kernel ridge regression on document statistics.

Random Fourier features turn the Gaussian kernel over the standardised
statistics into an inner product of ``FEATURES`` cosines. Ridge regression on
them needs only the normal equations, which are summed over partitions; one
sum per fold gives the models that leave a fold out as well. Their scores on
the fold left out are counted in fixed bins, and isotonic regression over the
bins turns a score into the share of good documents.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import per_row, text_bytes
from flowgauge.llm.held_out import FOLDS, is_held_out, training_labels
from flowgauge.llm.partition_sums import partition_sums
from flowgauge.session import settle

FEATURES = 192
RIDGE = 1e-3
#: Standardised statistics are cut here, so that a very long text is not far from everything.
REACH = 4.0
#: Bins of the raw score from -1 to 2 that the calibration counts.
BINS = 3072
THRESHOLD = 0.3
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#$%&*+<=>@\\^_`{|}~[]/")] = True
STATISTICS = (
    "log_bytes log_words word_length upper digit symbol stop mark comma pipe not_ascii space unique_words top_word "
    "repeated_word capital_words upper_words odd_ends log_lines line_words unique_lines compressed sentence_words "
    "plain_words"
).split()
_CHUNK = 1 << 20


def statistics(text: bytes) -> list[float]:
    """Shares and averages of a whole text; an empty text has zeros."""
    n = len(text)
    if n == 0:
        return [0.0] * len(STATISTICS)
    codes = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    words, lines = text.split(), text.split(b"\n")
    m = max(len(words), 1)
    count = Counter(words)
    ends = Counter(w[-1] for w in words)
    odd_ends = sum(k for c, k in ends.items() if _SYMBOLS[c] or c == 33)
    upper_words = sum(k for w, k in count.items() if len(w) > 2 and w.isupper())
    capital = sum(k for w, k in count.items() if 65 <= w[0] <= 90)
    plain = sum(k for w, k in count.items() if w.isalpha() or not w.isascii())
    upper = codes[65:91].sum()
    letters = max(upper + codes[97:123].sum() + codes[128:].sum(), 1)
    stops = codes[46] + codes[63]
    return [
        math.log1p(n),
        math.log1p(len(words)),
        min(n / m, 50.0),
        upper / letters,
        codes[48:58].sum() / n,
        codes[_SYMBOLS].sum() / n,
        stops / m,
        codes[33] / m,
        codes[44] / m,
        codes[124] / m,
        codes[128:].sum() / n,
        (n - codes[33:].sum()) / n,
        len(count) / m,
        max(count.values(), default=0) / m,
        sum(a == b for a, b in zip(words, words[1:])) / m,
        capital / m,
        upper_words / m,
        odd_ends / m,
        math.log1p(len(lines)),
        math.log1p(len(words) / len(lines)),
        len(set(lines)) / len(lines),
        sum(len(zlib.compress(text[i : i + _CHUNK], 1)) for i in range(0, n, _CHUNK)) / n,
        math.log1p(len(words) / (stops + 1)),
        plain / m,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row; NULL text counts as empty."""

    def work(text):
        return (statistics(text),)

    return per_row(docs.select("doc_id", text_bytes().alias("text")), work, "x array<double>", ["doc_id"])


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


@dataclass
class Kernel:
    """Random Fourier features of standardised statistics; the first feature is constant."""

    mean: np.ndarray
    scale: np.ndarray
    width: np.ndarray
    phase: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -REACH, REACH)
        waves = math.sqrt(2 / len(self.phase)) * np.cos(z @ self.width + self.phase)
        return np.hstack([np.ones((len(x), 1)), waves])


def fit_kernel(labelled: DataFrame, features: int, seed: int) -> Kernel:
    """Means and deviations of the labelled rows, and the random waves."""
    d = len(STATISTICS)

    def work(batch):
        x = matrix(batch.column(0))
        return np.stack([np.full(d, len(x), dtype=float), x.sum(axis=0), (x**2).sum(axis=0)])

    n, s, q = partition_sums(labelled.select("x"), work, (3, d))
    n = np.maximum(n, 1)
    scale = np.sqrt(np.maximum(q / n - (s / n) ** 2, 0))
    rng = np.random.default_rng(seed)
    width, phase = rng.normal(0, 1 / math.sqrt(d), (d, features)), rng.uniform(0, 2 * math.pi, features)
    return Kernel(s / n, np.where(scale > 1e-9, scale, 1.0), width, phase)


def fit_ridge(labelled: DataFrame, kernel: Kernel, ridge: float = RIDGE) -> np.ndarray:
    """Weights by fold: row 0 is learned from all folds, row k from all but fold k."""
    p = len(kernel.phase) + 1

    def work(batch):
        x, y, fold = matrix(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(2))
        out = np.zeros((FOLDS, p, p + 2))
        for k in range(1, FOLDS):
            z, t = kernel(x[fold == k]), y[fold == k]
            out[k, :, :p], out[k, :, p], out[k, 0, p + 1] = z.T @ z, z.T @ t, len(t)
        return out.reshape(FOLDS * p, p + 2)

    sums = partition_sums(labelled.select("x", "y", "fold"), work, (FOLDS * p, p + 2)).reshape(FOLDS, p, p + 2)
    total, weights = sums.sum(axis=0), np.zeros((FOLDS, p))
    for k in range(FOLDS):
        own = total - (sums[k] if k else 0)
        n = max(own[0, p + 1], 1.0)
        penalty = ridge * np.eye(p)
        penalty[0, 0] = 1e-9
        weights[k] = np.linalg.solve(own[:, :p] / n + penalty, own[:, p] / n)
    return weights


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The closest rising sequence, by pooling neighbours that fall."""
    pools: list[list[float]] = []
    for v, w in zip(values.tolist(), weights.tolist()):
        pools.append([v, w, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            b, a = pools.pop(), pools[-1]
            a[0] = (a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1])
            a[1], a[2] = a[1] + b[1], a[2] + b[2]
    return np.repeat([p[0] for p in pools], [p[2] for p in pools])


def fit_calibration(labelled: DataFrame, kernel: Kernel, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Raw scores and their calibrated ones, rising, from scores on the folds left out."""

    def work(batch):
        x, y, fold = matrix(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(2))
        at = bins((kernel(x) * weights[fold]).sum(axis=1))
        return np.stack([np.bincount(at, minlength=BINS), np.bincount(at, y, minlength=BINS)])

    n, good = partition_sums(labelled.select("x", "y", "fold"), work, (2, BINS))
    held = np.flatnonzero(n)
    if not len(held):
        return np.array([0.0]), np.array([0.5])
    # one good and one bad document more, spread over all: no share is exactly 0 or 1
    prior = 1.0 / len(held)
    value = isotonic((good[held] + prior * 0.5) / (n[held] + prior), n[held])
    return (held + 0.5) * 3 / BINS - 1, value


def bins(raw: np.ndarray) -> np.ndarray:
    return np.clip(((raw + 1) / 3 * BINS).astype(np.int64), 0, BINS - 1)


@dataclass
class Model:
    kernel: Kernel
    weights: np.ndarray
    known: np.ndarray  # raw scores, rising
    value: np.ndarray  # what they are calibrated to

    def __call__(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Raw and calibrated scores of statistics."""
        raw = self.kernel(x) @ self.weights
        return raw, np.interp(raw, self.known, self.value)


def fit(
    own: DataFrame, labels: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = 7
) -> Model:
    """Learn from the statistics ``own`` (doc_id, x) of the documents that ``labels`` (doc_id, quality) names."""
    labelled = settle(own.join(training_labels(labels, "quality"), "doc_id"))
    kernel = fit_kernel(labelled, features, seed)
    weights = fit_ridge(labelled, kernel, ridge)
    return Model(kernel, weights[0], *fit_calibration(labelled, kernel, weights))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, raw.

    ``labels`` has doc_id and quality (1 is good). Fold 0 of doc_id is never
    learned from, nor are rows without an id. NULL texts count as empty and
    are scored like any text. Repeated rows give repeated rows, and a label
    counts once for every document row it meets. Without any label all scores
    are 0.5; without any document the result is empty. Only doc_id and text
    are read.
    """
    own = settle(document_statistics(docs))
    model, names = fit(own, labels, **settings), ["doc_id", "raw", "score"]

    def score(batches):
        for batch in batches:
            if batch.num_rows:
                found = [pa.array(x) for x in model(matrix(batch.column(1)))]
                yield pa.RecordBatch.from_arrays([batch.column(0), *found], names=names)

    kind = own.schema["doc_id"].dataType.simpleString()
    scored = own.mapInArrow(score, f"doc_id {kind}, raw double, score double")
    return scored.select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "raw",
    )


def accept(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **settings) -> DataFrame:
    """The rows of ``docs`` that are predicted good, all columns as they are.

    The rows are judged in place, each by its own text, so no text is shuffled
    and rows without an id are judged like any other.
    """
    model = fit(settle(document_statistics(docs)), labels, **settings)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model(np.array([statistics(t) for t in text]).reshape(-1, len(STATISTICS)))[1])

    return docs.filter(score(text_bytes()) >= threshold)
