"""Quality by ordinal regression: hashed-text weights shared by all grades, with ordered thresholds.

The cumulative-link model says P(grade > j) = sigmoid(eta - threshold_j), with thresholds in
rising order, so one weight vector serves all grades. ``eta`` is the mean of the words' weights; a
word's weight is the sum over its hashed features: itself, its shape, and its last characters. A
word that repeats the one before it also counts as a word of its own kind.

Training takes a bounded sample of labelled rows on the driver (``training_rows``). Scoring reads
each text once, in one pass without a shuffle, and gives the expected grade and the probability to
reach a grade, by which documents are selected.

Defined results: null, empty and blank texts have ``eta`` 0; rows are kept one to one; with one
grade in the sample every score is that grade's; without any labelled row the expected grade is 0.
Columns named in ``keep`` come back unchanged; ``out`` must be a new name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from quayside.llm.hashed_text import bucket, doc_batches, shape, training_rows

SIZE = 1 << 16
RATING = "struct<eta: double, expected_grade: double, tail: array<double>>"
_ARROW_RATING = pa.struct([("eta", pa.float64()), ("expected_grade", pa.float64()), ("tail", pa.list_(pa.float64()))])


#: Stands behind the words as often as a word repeats the one before it; no text has it, as it holds a blank.
AGAIN = " again"


def repeats(words: list[str]) -> int:
    return sum(map(eq, words, words[1:]))


def word_features(word: str) -> tuple[int, int, int]:
    return bucket(word.lower(), SIZE), bucket(shape(word), SIZE, 1), bucket(word[-3:], SIZE, 2)


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray

    def rate(self, eta: np.ndarray) -> np.ndarray:
        """P(grade > j) for every threshold j."""
        return 1.0 / (1.0 + np.exp(-np.clip(eta[:, None] - self.thresholds, -30, 30)))


def train(rows: Sequence[tuple[int, str]], epochs: int = 120, rate: float = 0.05, decay: float = 1e-4) -> OrdinalModel:
    """Maximum likelihood by full-batch Adam; each grade weighs the same.

    Thresholds are a first one and positive steps (their logarithms are what is learnt), so they
    stay in order.
    """
    top = max((g for g, _ in rows), default=0)
    weights = np.zeros(SIZE)
    if len({g for g, _ in rows}) < 2:
        return OrdinalModel(weights, np.where(np.arange(top) < top, -30.0, 30.0))
    split = [words + [AGAIN] * repeats(words) for words in (t.split() for _, t in rows)]
    number = {w: i for i, w in enumerate({w for words in split for w in words})}
    feats = np.array([word_features(w) for w in number], np.int64).reshape(-1, 3)
    flat = np.fromiter((number[w] for words in split for w in words), np.int64)
    sizes = np.array([len(words) for words in split])
    owner = np.repeat(np.arange(len(split)), sizes)
    share = 1.0 / np.maximum(sizes, 1)[owner]
    grades = np.array([g for g, _ in rows])
    importance = 1.0 / np.bincount(grades, minlength=top + 1)[grades]
    importance /= importance.sum()
    first, steps = 0.0, np.zeros(max(top - 1, 0))
    theta = np.concatenate([[first], steps])
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(theta), np.zeros_like(theta)]
    for n in range(1, epochs + 1):
        cut = np.cumsum(np.append(theta[0], np.exp(theta[1:])))
        eta = np.bincount(owner, weights[feats].sum(axis=1)[flat] * share, minlength=len(split))
        p = 1.0 / (1.0 + np.exp(-np.clip(eta[:, None] - cut, -30, 30)))
        # The chance of the grade itself is a difference of neighbours; its gradient needs both ends.
        full = np.concatenate([np.ones((len(eta), 1)), p, np.zeros((len(eta), 1))], axis=1)
        own = np.maximum(full[np.arange(len(eta)), grades] - full[np.arange(len(eta)), grades + 1], 1e-9)
        slope = p * (1 - p)
        d = np.zeros_like(p)
        for j in range(top):
            d[:, j] = np.where(grades == j, slope[:, j], 0.0) - np.where(grades == j + 1, slope[:, j], 0.0)
        d *= (importance / own)[:, None]
        per_word = np.bincount(flat, d.sum(axis=1)[owner] * share, minlength=len(number))
        g_weights = np.bincount(feats.ravel(), np.repeat(per_word, 3), minlength=SIZE) + decay * weights / len(split)
        g_cut = -d.sum(axis=0)
        behind = np.cumsum(g_cut[::-1])[::-1]
        g_theta = np.append(behind[0], behind[1:] * np.exp(theta[1:]))
        for k, (value, g) in enumerate(((weights, g_weights), (theta, g_theta))):
            m, s = state[2 * k], state[2 * k + 1]
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            value -= rate * 4 * (m / (1 - 0.9**n)) / (np.sqrt(s / (1 - 0.99**n)) + 1e-9)
    return OrdinalModel(weights, np.cumsum(np.append(theta[0], np.exp(theta[1:]))))


class WordWeights(dict):
    """The weight of a word, kept for words that were met; forgets all when it is full."""

    KNOWN = 500_000

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= self.KNOWN:
            self.clear()
        a, b, c = word_features(word)
        value = self[word] = float(self.weights[a] + self.weights[b] + self.weights[c])
        return value


def _rate(model, keep: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordWeights(model.value.weights)
        for batch, start, stop, texts in doc_batches(batches, 2_000_000):
            eta = np.zeros(len(texts))
            for i, text in enumerate(texts):
                words = text.split()
                if words:
                    again = repeats(words)
                    eta[i] = (sum(map(known.__getitem__, words)) + again * known[AGAIN]) / (len(words) + again)
            tail = model.value.rate(eta)
            rows = [{"eta": e, "expected_grade": x.sum(), "tail": x.tolist()} for e, x in zip(eta, tail)]
            columns = [batch.column(name).slice(start, stop - start) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, _ARROW_RATING)], names)

    return run


def rate_texts(df: DataFrame, model: OrdinalModel, text: str = "text", out: str = "rating", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) and ``out``: ``eta``, the expected grade and P(grade > j) for each j."""
    keep = list(df.columns if keep is None else keep)
    if out.lower() in {name.lower() for name in keep}:
        raise ValueError(f"the input already has a column {out!r}")
    sent = df.sparkSession.sparkContext.broadcast(model)  # 0.5 MB, whatever the input
    schema = StructType([df.schema[name] for name in keep] + [StructField(out, _parse_datatype_string(RATING))])
    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(_rate(sent, keep, [*keep, out]), schema)


def fit(docs: DataFrame, labels: DataFrame, grade: Column, per_grade: int = 1500, longest: int = 8000, **options) -> OrdinalModel:
    """Train on at most ``per_grade`` texts of each grade of at most ``longest`` characters, held-out ids excluded."""
    return train(training_rows(docs, labels, grade, per_grade, longest), **options)
