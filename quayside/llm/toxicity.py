"""Toxicity of texts: a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as a hashed word vector beside the mean of its hashed character n-gram vectors. Two
recurrent layers read a window of words in both directions, attention pools their states, and the
window's logit follows. A text is scored by its worst window; windows of ``width`` words overlap by
half and cover the whole text.

Training takes a bounded sample of labelled rows (``training_rows``) on the driver: the loss of a
text is that of its worst window, which is what a label on whole texts says. Scoring is one pass
over all rows without a shuffle; only text goes in.

Defined results: null, empty and blank texts are scored as one window without words, the same for
all; rows are kept one to one, so repeated rows and ties need no rule; without any labelled row the
score is 0.5. Columns named in ``keep`` come back unchanged; ``out`` must be a new name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from quayside.llm.hashed_text import bucket, char_grams, doc_batches, training_rows

WORDS, GRAMS = 1 << 15, 1 << 15
DIM, HIDDEN, ATTENTION = 8, 8, 8
LEAST_STEPS = 250
DOUBT = 4  # log-odds of a feature count half when it stands in this many training texts
DECAY = 1.0  # word and n-gram vectors shrink by this times the rate in each step, so that rare ones are not learnt by heart
_STRIP = ".,;:!?\"'()[]{}«»“”"


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def words_of(text: str) -> list[str]:
    return [w.strip(_STRIP) for w in text.lower().split()]


def features(word: str) -> tuple[int, list[int]]:
    return bucket(word, WORDS), [bucket(g, GRAMS, 1) for g in char_grams(word)]


def windows(n: int, width: int) -> np.ndarray:
    """First words of windows that overlap by half; the last one ends with the text."""
    if n <= width:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - width, width // 2)
    return np.append(starts, n - width)


class Vocabulary:
    """Hashed word and character n-grams of a list of words, as arrays."""

    def __init__(self, words: Sequence[str]):
        both = [features(w) for w in words]
        self.word = np.array([w for w, _ in both], np.int64)
        self.sizes = np.array([len(g) for _, g in both], np.int64)
        self.grams = np.fromiter((x for _, g in both for x in g), np.int64, int(self.sizes.sum()))
        self.offset = np.cumsum(self.sizes) - self.sizes

    def grams_of(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[chosen]
        at = np.repeat(self.offset[chosen] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return self.grams[at], sizes


@dataclass
class Model:
    width: int
    params: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def fresh(cls, width: int, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        near = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        # Words that training never met stay close to nothing.
        p = {"word": 0.02 * rng.standard_normal((WORDS, DIM), np.float32), "gram": 0.1 * rng.standard_normal((GRAMS, DIM), np.float32)}
        for way in "fb":
            p |= {f"W{way}": near(2 * DIM, 3 * HIDDEN), f"U{way}": near(HIDDEN, 3 * HIDDEN), f"c{way}": np.zeros(3 * HIDDEN, np.float32)}
        p |= {"A": near(2 * HIDDEN, ATTENTION), "v": near(ATTENTION), "o": near(2 * HIDDEN), "b": np.zeros(1, np.float32)}
        return cls(width, p)

    def inputs(self, words: Vocabulary, chosen: np.ndarray) -> np.ndarray:
        """The input vectors of the chosen words."""
        at, sizes = words.grams_of(chosen)
        grams = np.add.reduceat(self.params["gram"][at], np.cumsum(sizes) - sizes) / sizes[:, None]
        return np.concatenate([self.params["word"][words.word[chosen]], grams.astype(np.float32)], axis=1)

    def _read(self, way: str, x: np.ndarray, mask: np.ndarray, trace: list | None) -> np.ndarray:
        """States of one direction; ``x`` is (steps, windows, 3 * hidden), already projected."""
        steps, n, _ = x.shape
        u, h = self.params[f"U{way}"], np.zeros((n, HIDDEN), np.float32)
        out = np.zeros((steps, n, HIDDEN), np.float32)
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            a = h @ u
            gates = x[t, :, : 2 * HIDDEN] + a[:, : 2 * HIDDEN]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1.0
            np.reciprocal(gates, out=gates)
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = np.tanh(x[t, :, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
            h2 = new + z * (h - new)
            h2 = np.where(mask[t][:, None], h2, h)
            if trace is not None:
                trace.append((t, h, a, z, r, new))
            out[t] = h = h2
        return out

    def forward(self, xf: np.ndarray, xb: np.ndarray, mask: np.ndarray, trace: dict | None = None) -> np.ndarray:
        """Logit of every window."""
        p = self.params
        tf, tb = ([], []) if trace is not None else (None, None)
        h = np.concatenate([self._read("f", xf, mask, tf), self._read("b", xb, mask, tb)], axis=2)
        q = np.tanh(h @ p["A"])
        e = np.where(mask, q @ p["v"], np.float32(-30.0))
        w = np.exp(e - e.max(axis=0))
        w /= w.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", w, h)
        if trace is not None:
            trace |= {"f": tf, "b": tb, "h": h, "q": q, "w": w, "pooled": pooled}
        return pooled @ p["o"] + p["b"][0]

    def gradients(self, d: np.ndarray, trace: dict, mask: np.ndarray, x: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients for the logit gradients ``d``, of the parameters and of the word inputs ``x``."""
        p, h, q, w = self.params, trace["h"], trace["q"], trace["w"]
        g = {"o": trace["pooled"].T @ d, "b": np.array([d.sum()], np.float32)}
        dp = d[:, None] * p["o"]
        dh = w[:, :, None] * dp[None]
        dw = np.einsum("tnh,nh->tn", h, dp)
        de = w * (dw - (w * dw).sum(axis=0)) * mask
        dq = de[:, :, None] * p["v"] * (1 - q * q)
        g["v"] = np.einsum("tna,tn->a", q, de)
        g["A"] = np.einsum("tnh,tna->ha", h, dq)
        dh = dh + dq @ p["A"].T
        dx = np.zeros_like(x)
        for k, way in enumerate("fb"):
            u, W = p[f"U{way}"], p[f"W{way}"]
            gu, gx = np.zeros_like(u), np.zeros((*x.shape[:2], 3 * HIDDEN), np.float32)
            carry = np.zeros((x.shape[1], HIDDEN), np.float32)
            for t, before, a, z, r, new in reversed(trace[way]):
                total = dh[t, :, k * HIDDEN : (k + 1) * HIDDEN] + carry
                live = total * mask[t][:, None]
                dn = live * (1 - z) * (1 - new * new)
                dz = live * (before - new) * z * (1 - z)
                dr = dn * a[:, 2 * HIDDEN :] * r * (1 - r)
                gx[t] = np.concatenate([dz, dr, dn], axis=1)
                da = np.concatenate([dz, dr, dn * r], axis=1)
                gu += before.T @ da
                carry = total * ~mask[t][:, None] + live * z + da @ u.T
            g[f"U{way}"], g[f"W{way}"] = gu, np.einsum("tni,tng->ig", x, gx)
            g[f"c{way}"] = gx.sum(axis=(0, 1))
            dx += gx @ W.T
        return g, dx


def _layout(texts: Sequence[np.ndarray], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words (steps, windows), their mask, and the text of every window. Word 0 stands for none."""
    words, mask, owner = [], [], []
    for d, ids in enumerate(texts):
        first = windows(len(ids), width)
        at = first[:, None] + np.arange(width)
        inside = at < len(ids)
        words.append(np.where(inside, ids[np.minimum(at, len(ids) - 1)], 0) if len(ids) else np.zeros((1, width), np.int64))
        mask.append(inside)
        owner.append(np.full(len(first), d))
    return np.concatenate(words).T, np.concatenate(mask).T, np.concatenate(owner)


def _odds(vocabulary: Vocabulary, texts: Sequence[np.ndarray], labels: np.ndarray) -> dict[str, np.ndarray]:
    """Log-odds of hashed words and n-grams between texts of label 1 and 0, drawn towards 0 the more the rarer they are; 0 if not met."""
    counts = {"word": np.zeros((2, WORDS)), "gram": np.zeros((2, GRAMS))}
    for ids, y in zip(texts, labels.astype(int)):
        distinct = np.unique(ids)
        if len(distinct):
            counts["word"][y, np.unique(vocabulary.word[distinct])] += 1
            counts["gram"][y, np.unique(vocabulary.grams_of(distinct)[0])] += 1
    total = np.bincount(labels.astype(int), minlength=2)
    out = {}
    for name, (no, yes) in counts.items():
        share = (yes + no) / total.sum()
        odds = np.log((yes + 2 * share + 0.02) / (total[1] + 2)) - np.log((no + 2 * share + 0.02) / (total[0] + 2))
        out[name] = (np.clip(odds, -4, 4) * (yes + no) / (yes + no + DOUBT)).astype(np.float32)
    return out


def train(rows: Sequence[tuple[int, str]], width: int = 32, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 11) -> Model:
    """A model of ``(label 0 or 1, text)`` rows; label 1 and 0 weigh the same in every batch."""
    model = Model.fresh(width, seed)
    if len({y for y, _ in rows}) < 2:
        model.params["o"][:] = 0
        return model
    number: dict[str, int] = {"": 0}
    texts = [np.array([number.setdefault(w, len(number)) for w in words_of(t)], np.int64) for _, t in rows]
    vocabulary = Vocabulary(list(number))
    labels = np.array([y for y, _ in rows], np.float32)
    odds = _odds(vocabulary, texts, labels)
    for name, value in odds.items():
        model.params[name][value == 0] = 0
        model.params[name][:, 0] = value / 2
    signs = np.maximum(odds["word"][vocabulary.word], 0) + np.maximum(np.maximum.reduceat(odds["gram"][vocabulary.grams], vocabulary.offset), 0)
    sides = [np.flatnonzero(labels == y) for y in (0, 1)]
    rng = np.random.default_rng(seed)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.params.items()}
    # Small samples are gone through more often.
    steps = max(LEAST_STEPS, epochs * 2 * len(sides[1]) // batch)
    for step in range(1, steps + 1):
        chosen = np.concatenate([rng.choice(side, min(batch // 2, len(side)), replace=False) for side in sides])
        words, mask, owner = _layout([texts[i] for i in chosen], width)
        distinct, back = np.unique(words, return_inverse=True)
        words = back.reshape(words.shape)
        x = model.inputs(vocabulary, distinct)
        ways = [x @ model.params[f"W{k}"] + model.params[f"c{k}"] for k in "fb"]
        logits = model.forward(ways[0][words], ways[1][words], mask)
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        ends = np.append(first[1:], len(owner))
        # At first a text's worst window is where single words say so, since the network knows nothing yet.
        rank = logits if step > 0.3 * steps else np.where(mask, signs[distinct[words]], 0).max(axis=0)
        worst = np.array([a + int(np.argmax(rank[a:b])) for a, b in zip(first, ends)])
        words, mask = words[:, worst], mask[:, worst]
        trace: dict = {}
        logits = model.forward(ways[0][words], ways[1][words], mask, trace)
        d = (_sigmoid(logits) - labels[chosen]).astype(np.float32) / len(chosen)
        g, dx = model.gradients(d, trace, mask, x[words])
        used, place = np.unique(words[mask], return_inverse=True)
        per_word = np.zeros((len(used), 2 * DIM), np.float32)
        np.add.at(per_word, place, dx[mask])
        g["word"], g["gram"] = np.zeros_like(model.params["word"]), np.zeros_like(model.params["gram"])
        np.add.at(g["word"], vocabulary.word[distinct[used]], per_word[:, :DIM])
        at, sizes = vocabulary.grams_of(distinct[used])
        np.add.at(g["gram"], at, np.repeat(per_word[:, DIM:] / sizes[:, None], sizes, axis=0))
        for name, value in odds.items():
            g[name][value == 0] = 0
        now = rate * (1 - 0.9 * step / steps)
        for k, v in g.items():
            m, s = moments[k]
            m += 0.1 * (v - m)
            s += 0.01 * (v * v - s)
            model.params[k] -= now * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-7)
            if k in odds:
                model.params[k] *= 1 - now * DECAY
    return model


class Scorer:
    """Scores texts in a worker. The projected inputs of words that were met are kept, up to a bound."""

    KNOWN = 200_000
    WINDOWS = 1024

    def __init__(self, model: Model):
        self.model = model
        self.project = [(model.params[f"W{k}"], model.params[f"c{k}"]) for k in "fb"]
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((1024, 6 * HIDDEN), np.float32)
        self.filled = 0
        self.ids([[""]])

    def ids(self, texts: list[list[str]]) -> list[np.ndarray]:
        number, new = self.number, []
        known = len(number)

        out = []
        for words in texts:
            try:
                out.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
            except KeyError:
                for w in words:
                    if w not in number:
                        number[w] = len(number)
                        new.append(w)
                out.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        if new:
            x = self.model.inputs(Vocabulary([w.strip(_STRIP) for w in new]), np.arange(len(new)))
            if len(number) > len(self.table):
                self.table = np.concatenate([self.table, np.zeros((max(len(self.table), len(number)), 6 * HIDDEN), np.float32)])
            self.table[known : len(number)] = np.concatenate([x @ w + c for w, c in self.project], axis=1)
        return out

    def __call__(self, texts: list[str]) -> np.ndarray:
        if len(self.number) > self.KNOWN:
            self.forget()
        ids = self.ids([t.lower().split() for t in texts])
        out = np.full(len(texts), -np.inf, np.float32)
        words, mask, owner = _layout(ids, self.model.width)
        for lo in range(0, len(owner), self.WINDOWS):
            x = self.table[words[:, lo : lo + self.WINDOWS]]
            logits = self.model.forward(x[:, :, : 3 * HIDDEN], x[:, :, 3 * HIDDEN :], mask[:, lo : lo + self.WINDOWS])
            np.maximum.at(out, owner[lo : lo + self.WINDOWS], logits)
        return _sigmoid(out.astype(np.float64))


def _score(model, keep: list[str], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.value)
        for batch, start, stop, texts in doc_batches(batches, 1_000_000):
            columns = [batch.column(name).slice(start, stop - start) for name in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scorer(texts), pa.float64())], names)

    return run


def score_texts(df: DataFrame, model: Model, text: str = "text", out: str = "score", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` (all columns unless given) and ``out``: the chance that a text is toxic."""
    keep = list(df.columns if keep is None else keep)
    if out.lower() in {name.lower() for name in keep}:
        raise ValueError(f"the input already has a column {out!r}")
    sent = df.sparkSession.sparkContext.broadcast(model)  # 0.8 MB, whatever the input
    schema = StructType([df.schema[name] for name in keep] + [StructField(out, DoubleType())])
    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(_score(sent, keep, [*keep, out]), schema)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1500, longest: int = 8000, **options) -> Model:
    """Train on at most ``per_label`` texts of each label of at most ``longest`` characters, held-out ids excluded."""
    rows = training_rows(docs, labels, F.col("toxic").cast("int"), per_label, longest)
    return train([(int(y == 1), t) for y, t in rows], **options)
