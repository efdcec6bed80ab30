"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. The field scores each line by features of itself and of the
lines beside it, and each pair of neighbouring labels. Forward and backward passes give the
probability that a line is good; their mean over a document, weighted by line lengths, is
mapped to the probability that the document is good.

The field is trained in numpy on a bounded sample of labelled documents. Labels belong to
documents, so at first all lines carry the document's label. Then the lines of bad
documents that the field holds to be good are no longer taught as bad, and it is trained
again.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import learnable, map_texts
from .toxicity import training_rows

TRAIN_DOCS = 2000  # labelled documents of each class to learn from, at most
TRAIN_LINES = 64  # lines of one training sequence
OWN = 16  # features of a line by itself; three such rows and a constant make one


def _classes() -> np.ndarray:
    """Kind of each character below 256; others are letters."""
    kinds = np.full(257, 1)
    for i in range(256):
        c = chr(i)
        kinds[i] = (0 if c.isspace() else 2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit()
                    else 4 if c in ".,;:'\"()-" else 5)
    return kinds


_KINDS = _classes()


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of the lines of a text, beside lines included, and the lines' lengths.

    Empty lines are lines of length 0.
    """
    lines = text.split("\n")
    n = len(lines)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _KINDS[np.minimum(points, 256)]
    ends = np.r_[np.flatnonzero(points == 10), len(points)]
    starts = np.r_[0, ends[:-1] + 1]
    line = np.repeat(np.arange(n), np.diff(np.r_[-1, ends]))[:len(points)]
    counts = np.bincount(line * 6 + kinds, minlength=6 * n).reshape(n, 6).astype(np.float64)
    counts[:-1, 0] -= 1  # the line break itself
    length = (ends - starts).astype(np.float64)
    own = np.zeros((n, OWN))
    share = counts / np.maximum(length, 1)[:, None]
    own[:, 0:6] = share
    own[:, 6] = np.log1p(length)
    before = None
    for i, content in enumerate(lines):
        words = content.split()
        k = len(words)
        if k:
            row = own[i]
            row[7] = len(set(words)) / k
            row[8] = sum(map(str.__eq__, words[1:], words)) / k
            row[9] = (len(content) - k + 1) / k / 10
            row[10] = content[-1] in ".!?"
            row[11] = k < 5
            row[12] = content == before
            row[13] = words.count("|") / k
            row[14] = math.log1p(k)
        own[i, 15] = k == 0
        before = content
    above = np.vstack([np.zeros((1, OWN)), own[:-1]])
    below = np.vstack([own[1:], np.zeros((1, OWN))])
    return np.hstack([own, above, below, np.ones((n, 1))]), length


def _log_sum(a, b):
    top = np.maximum(a, b)
    return top + np.log1p(np.exp(-np.abs(a - b)))


def marginals(score: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Probability that each line is good; score (lines,) of good against bad, pair (2, 2)."""
    n = len(score)
    (p00, p01), (p10, p11) = np.exp(pair - pair.max()).tolist()
    good = np.exp(-np.logaddexp(0, -score)).tolist()
    forward, a0, a1 = [], 1.0, 1.0
    for i in range(n):
        g = good[i]
        b0, b1 = (a0 * p00 + a1 * p10) * (1 - g), (a0 * p01 + a1 * p11) * g
        if i == 0:
            b0, b1 = 1 - g, g
        total = b0 + b1 or 1e-300
        a0, a1 = max(b0 / total, 1e-300), max(b1 / total, 1e-300)
        forward.append((a0, a1))
    out, c0, c1 = [0.0] * n, 1.0, 1.0
    for i in range(n - 1, -1, -1):
        a0, a1 = forward[i]
        m0, m1 = a0 * c0, a1 * c1
        out[i] = m1 / (m0 + m1)
        g = good[i]
        d0, d1 = c0 * (1 - g), c1 * g
        c0, c1 = p00 * d0 + p01 * d1, p10 * d0 + p11 * d1
        total = c0 + c1 or 1e-300
        c0, c1 = max(c0 / total, 1e-300), max(c1 / total, 1e-300)
    return np.array(out)


class Field:
    def __init__(self):
        self.mean, self.spread = np.zeros(3 * OWN + 1), np.ones(3 * OWN + 1)
        self.weights, self.pair = np.zeros(3 * OWN + 1), np.zeros((2, 2))
        self.slope, self.shift = 0.0, 0.0

    def scores(self, features: np.ndarray) -> np.ndarray:
        return ((features - self.mean) / self.spread) @ self.weights

    def raw(self, text: str) -> float:
        """Length-weighted mean of the lines' log-odds-bounded probabilities of being good."""
        features, length = line_features(text)
        good = marginals(self.scores(features), self.pair)
        weight = length + (length.sum() == 0)
        return float((weight * good).sum() / weight.sum())

    def quality(self, text: str) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * self.raw(text) + self.shift))))


def _fit_chain(field: Field, x: np.ndarray, mask: np.ndarray, y: np.ndarray, taught: np.ndarray, rounds: int) -> None:
    """Maximise the likelihood of the taught labels; x (chains, lines, features)."""
    n, places, _ = x.shape
    m1, m2, v1, v2 = (np.zeros_like(a) for a in (field.weights, field.pair, field.weights, field.pair))

    def passes(low, high):
        """Marginals and pair marginals where scores of bad and good are given."""
        forward = np.zeros((places, n, 2))
        forward[0] = np.stack([low[:, 0], high[:, 0]], 1)
        for t in range(1, places):
            before = forward[t - 1][:, :, None] + field.pair[None]
            step = np.stack([low[:, t], high[:, t]], 1) + _log_sum(before[:, 0], before[:, 1])
            forward[t] = np.where(mask[:, t, None], step, forward[t - 1])
        backward = np.zeros((places, n, 2))
        for t in range(places - 2, -1, -1):
            after = field.pair[None] + (np.stack([low[:, t + 1], high[:, t + 1]], 1) + backward[t + 1])[:, None, :]
            step = _log_sum(after[:, :, 0], after[:, :, 1])
            backward[t] = np.where(mask[:, t + 1, None], step, backward[t + 1])
        joint = forward + backward
        good = 1 / (1 + np.exp(np.clip(joint[..., 0] - joint[..., 1], -40, 40)))
        pairs = np.zeros((2, 2))
        for t in range(1, places):
            cell = (forward[t - 1][:, :, None] + field.pair[None]
                    + (np.stack([low[:, t], high[:, t]], 1) + backward[t])[:, None, :])
            cell = np.exp(cell - cell.max(axis=(1, 2), keepdims=True))
            cell /= cell.sum(axis=(1, 2), keepdims=True)
            pairs += (cell * mask[:, t, None, None]).sum(axis=0)
        return good.T, pairs

    for step in range(1, rounds + 1):
        score = x @ field.weights
        free, free_pairs = passes(-score / 2, score / 2)
        # Taught lines are held to their label, the others stay open.
        wall = np.where(taught, 40.0, 0.0)
        held, held_pairs = passes(-score / 2 - wall * (y == 1), score / 2 - wall * (y == 0))
        g = np.einsum("ntf,nt->f", x, (held - free) * mask) / mask.sum() - 1e-4 * field.weights
        g_pair = (held_pairs - free_pairs) / mask.sum() - 1e-4 * field.pair
        for value, grad, m, v in ((field.weights, g, m1, v1), (field.pair, g_pair, m2, v2)):
            m[:] = 0.9 * m + 0.1 * grad
            v[:] = 0.99 * v + 0.01 * grad ** 2
            value += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)


def train(texts: list[str], labels: list[int], rounds: int = 60) -> Field:
    """Fit the field; deterministic for the same rows in the same order."""
    field = Field()
    if len(set(labels)) < 2:
        field.shift = 3.0 if labels and labels[0] == 1 else -3.0 if labels else 0.0
        return field
    found = [line_features(t) for t in texts]
    every = np.vstack([f for f, _ in found])
    field.mean, field.spread = every.mean(axis=0), every.std(axis=0) + 1e-6
    field.mean[-1], field.spread[-1] = 0.0, 1.0
    chains = [(i, s) for i, (f, _) in enumerate(found) for s in range(0, len(f), TRAIN_LINES)]
    x = np.zeros((len(chains), TRAIN_LINES, 3 * OWN + 1))
    mask = np.zeros((len(chains), TRAIN_LINES), bool)
    y = np.zeros((len(chains), TRAIN_LINES), int)
    for c, (i, s) in enumerate(chains):
        part = (found[i][0][s:s + TRAIN_LINES] - field.mean) / field.spread
        x[c, :len(part)], mask[c, :len(part)], y[c] = part, True, labels[i]
    _fit_chain(field, x, mask, y, mask, rounds)
    apart = np.zeros_like(mask)
    for c in range(len(chains)):
        own = marginals(x[c][mask[c]] @ field.weights, field.pair)
        apart[c, :len(own)] = (own > 0.6) & (own > own.min())
    _fit_chain(field, x, mask, y, mask & ~(apart & (y == 0)), rounds)
    # Logistic map from the weighted mean to the label of the document.
    raw, label = np.array([field.raw(t) for t in texts]), np.array(labels, float)
    a, b = 4.0, -2.0
    for _ in range(3000):
        e = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30))) - label
        a, b = a - 2.0 * float((e * raw).mean()), b - 2.0 * float(e.mean())
    field.slope, field.shift = max(a, 0.0), b
    return field


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3,
                  per_class: int = TRAIN_DOCS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    A null or empty text is one empty line and gets that line's score. Repeated rows get a
    row each; a null id counts as held out; null labels teach nothing; with labels of one
    class every text gets the same score, 0.5 with none. Other columns are not looked at.
    """
    rows = training_rows(docs, labels, "quality", per_class).collect()
    rows = sorted({(r["doc_id"], r["text"], r["y"]) for r in rows})
    sent = docs.sparkSession.sparkContext.broadcast(train([r[1] for r in rows], [r[2] for r in rows]))

    def work(texts):
        return [(s := sent.value.quality(t), int(s >= threshold)) for t in texts]

    held = F.coalesce(~learnable(), F.lit(True)).alias("held_out")
    return map_texts(docs.select("doc_id", held, "text"), work, ["doc_id", "held_out"],
                     "doc_id bigint, held_out boolean, score double, predicted int")
