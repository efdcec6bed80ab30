"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as the sum of a word vector and the mean of vectors of characters at its
beginning and end, so that unseen words still have their parts. The table holds the words
and parts of enough training documents; all others share one row. Two gated
recurrent layers read a window of words forwards and backwards; attention weighs their
states; a logistic unit scores the window. All overlapping windows of a text are scored;
a logistic map of the two highest scores and the mean gives the score of the text.

The network is trained in numpy on a bounded sample of labelled documents. A label belongs
to a document, so after a first pass over all windows only the highest window of a toxic
document is taught as toxic.
"""

from __future__ import annotations

import re
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, learnable, map_texts

WINDOW, STRIDE = 48, 36
HIDDEN, WIDTH = 8, 16
TABLE = 60_000  # words and parts in the table, at most
LEAST_SHARE = 0.008  # of the training documents a word or part has to be in, and in two
PARTS = 5  # keys of a word
TRAIN_DOCS = 1500  # labelled documents of each class to learn from, at most
ROUND_STEPS = 150  # steps of a round, at least; few windows are gone through several times
_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def keys_of(word: str) -> tuple[str, ...]:
    """The word itself, three beginnings and one end."""
    marked = f"<{word}>"
    return marked, marked[:4] + "-", marked[:6] + "-", marked[:8] + "-", "-" + marked[-4:]


def windows_of(n: int) -> list[tuple[int, int]]:
    """Overlapping windows that cover n words."""
    starts = range(0, max(1, n - WINDOW + STRIDE), STRIDE)
    return [(s, min(n, s + WINDOW)) for s in starts if s < max(n, 1)]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters by name; two directions are stacked in the first axis.

    ``rows`` gives the table row of a key; row 0 is for all other keys.
    """

    def __init__(self, seed: int = 1, keys: list[str] = ()):
        self.rows = {k: i for i, k in enumerate(dict.fromkeys(keys), 1)}
        rng = np.random.default_rng(seed)
        h, d = HIDDEN, WIDTH

        def normal(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        self.p = {"table": normal(len(self.rows) + 1, d, scale=0.1), "w": normal(2, d, 3 * h, scale=d ** -0.5),
                  "b": np.zeros((2, 1, 3 * h), np.float32), "u": normal(2, h, 2 * h, scale=h ** -0.5),
                  "c": normal(2, h, h, scale=h ** -0.5), "att": normal(2 * h, scale=0.3),
                  "out": normal(2 * h, scale=0.3), "bias": np.float32([-1.0])}
        self.calibration = np.zeros(6)  # of the columns of document_features and a constant

    def table_rows(self, words) -> np.ndarray:
        """(words, PARTS) rows of the table."""
        get = self.rows.get
        return np.array([[get(k, 0) for k in keys_of(w)] for w in words], np.int64).reshape(-1, PARTS)

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        """Input vectors of words given by their table rows."""
        table = self.p["table"]
        return table[rows[:, 0]] + table[rows[:, 1:]].mean(axis=1)

    def projected(self, x: np.ndarray) -> np.ndarray:
        """What words add to the gates, for both directions: (2, words, 3 h)."""
        return (x[None] @ self.p["w"] + self.p["b"]).astype(np.float32)

    def forward(self, gates: np.ndarray, index: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits of windows; index (windows, places) into gates, mask of the places used."""
        p, h = self.p, HIDDEN
        n, places = index.shape
        turned = np.stack([index, index[:, ::-1]])
        shown = np.stack([mask, mask[:, ::-1]])[..., None].astype(np.float32)
        state = np.zeros((2, n, h), np.float32)
        states, saved = np.empty((places, 2, n, h), np.float32), []
        side = np.arange(2)[:, None]
        for t in range(places):
            g = gates[side, turned[:, :, t]]
            zr = _sigmoid(g[..., :2 * h] + state @ p["u"])
            z, r = zr[..., :h], zr[..., h:]
            new = np.tanh(g[..., 2 * h:] + (r * state) @ p["c"])
            m = shown[:, :, t]
            following = state + m * z * (new - state)
            if keep:
                saved.append((state, z, r, new, m))
            state = states[t] = following
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2).transpose(1, 0, 2)
        score = np.where(mask, both @ p["att"], -1e9)
        weight = np.exp(score - score.max(axis=1, keepdims=True)) * mask
        weight /= np.maximum(weight.sum(axis=1, keepdims=True), 1e-9)
        pooled = (weight[..., None] * both).sum(axis=1)
        logit = pooled @ p["out"] + p["bias"][0]
        return (logit, (both, weight, pooled, saved, turned)) if keep else logit

    def gradients(self, x, index, mask, error, kept):
        """Gradients of all parameters but the table, and of the words' vectors."""
        p, h = self.p, HIDDEN
        both, weight, pooled, saved, turned = kept
        g = {k: np.zeros_like(v) for k, v in p.items() if k != "table"}
        g["bias"][0], g["out"] = error.sum(), pooled.T @ error
        d_pooled = error[:, None] * p["out"]
        d_weight = (both * d_pooled[:, None]).sum(axis=2)
        d_score = weight * (d_weight - (weight * d_weight).sum(axis=1, keepdims=True))
        g["att"] = np.einsum("nt,nth->h", d_score, both)
        d_both = (weight[..., None] * d_pooled[:, None] + d_score[..., None] * p["att"]).transpose(1, 0, 2)
        places = len(saved)
        d_states = np.stack([d_both[:, :, :h], d_both[::-1, :, h:]], axis=1)
        d_gates = np.zeros((2, len(x), 3 * h), np.float32)
        d_state = np.zeros_like(saved[0][0])
        for t in reversed(range(places)):
            state, z, r, new, m = saved[t]
            d = d_state + d_states[t]
            d_z, d_new = d * m * (new - state) * z * (1 - z), d * m * z * (1 - new ** 2)
            d_rs = d_new @ p["c"].transpose(0, 2, 1)
            d_r = d_rs * state * r * (1 - r)
            d_zr = np.concatenate([d_z, d_r], axis=2)
            g["c"] += (r * state).transpose(0, 2, 1) @ d_new
            g["u"] += state.transpose(0, 2, 1) @ d_zr
            d_state = d * (1 - m * z) + d_rs * r + d_zr @ p["u"].transpose(0, 2, 1)
            d_g = np.concatenate([d_zr, d_new], axis=2)
            for k in range(2):
                np.add.at(d_gates[k], turned[k, :, t], d_g[k])
        g["b"] = d_gates.sum(axis=1, keepdims=True)
        g["w"] = x.T[None] @ d_gates
        return g, np.einsum("knh,kdh->nd", d_gates, p["w"])


def padded(windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    index, mask = np.zeros((len(windows), WINDOW), np.int64), np.zeros((len(windows), WINDOW), bool)
    for i, w in enumerate(windows):
        index[i, :len(w)], mask[i, :len(w)] = w, True
    return index, mask


def train(texts: list[str], labels: list[int], share: float | None = None, rounds: int = 3,
          batch: int = 128, rate: float = 0.01) -> Network:
    """Fit by Adam on all windows; deterministic for the same rows in the same order.

    ``share`` is the share of label 1 among all documents, where the sample's is another.
    """
    net, rng = Network(), np.random.default_rng(2)
    seen = Counter()
    vocabulary: dict[str, int] = {}
    flat, starts, ends, owner = array("i"), array("q"), array("q"), array("i")
    for i, text in enumerate(texts):
        listed = words_of(text)
        seen.update({k for w in set(listed) for k in keys_of(w)})
        at = len(flat)
        flat.extend(vocabulary.setdefault(w, len(vocabulary)) for w in listed)
        for a, b in windows_of(len(listed)):
            if b > a:
                starts.append(at + a)
                ends.append(at + b)
                owner.append(i)
    if not owner or len(set(labels)) < 2:
        net.calibration[-1] = -3.0
        return net
    frequent = sorted((-n, k) for k, n in seen.items() if n >= max(2, LEAST_SHARE * len(texts)))[:TABLE]
    net = Network(keys=[k for _, k in frequent])
    rows = net.table_rows(vocabulary)
    owner, y = np.array(owner), np.array(labels, np.float32)
    flat, starts, ends = np.array(flat), np.array(starts), np.array(ends)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0

    def windows(pick):
        """Words and mask of some windows; all windows at once would be many times the texts."""
        at = starts[pick][:, None] + np.arange(WINDOW)
        mask = at < ends[pick][:, None]
        return np.where(mask, flat[np.minimum(at, len(flat) - 1)], 0), mask

    def logits():
        out = []
        for s in range(0, len(owner), 2048):
            index, mask = windows(slice(s, s + 2048))
            used, local = np.unique(index, return_inverse=True)
            gates = net.projected(net.vectors(rows[used]))
            out.append(net.forward(gates, local.reshape(-1, WINDOW), mask))
        return np.concatenate(out)

    chosen = np.arange(len(owner))
    for k in range(rounds):
        if k:
            score = logits()
            order = np.lexsort((-score, owner))
            first = order[np.r_[True, owner[order][1:] != owner[order][:-1]]]
            chosen = np.concatenate([first[y[owner[first]] == 1], np.flatnonzero(y[owner] == 0)])
            # Of clean windows the highest stay, and as many others.
            clean = np.flatnonzero(y[owner] == 0)
            top = clean[np.argsort(-score[clean], kind="stable")[:4 * int(y.sum()) + 500]]
            rest = rng.choice(clean, min(len(clean), 4 * int(y.sum()) + 500), replace=False)
            chosen = np.unique(np.concatenate([first[y[owner[first]] == 1], top, rest]))
        passes = max(1, -(-ROUND_STEPS * batch // len(chosen)))
        shuffled = np.concatenate([rng.permutation(chosen) for _ in range(passes)])
        for s in range(0, len(shuffled), batch):
            pick = shuffled[s:s + batch]
            index, mask = windows(pick)
            used, local = np.unique(index, return_inverse=True)
            own = rows[used]
            x = net.vectors(own)
            logit, kept = net.forward(net.projected(x), local.reshape(-1, WINDOW), mask, keep=True)
            error = (_sigmoid(logit) - y[owner[pick]]) / len(pick)
            g, d_x = net.gradients(x, local, mask, error.astype(np.float32), kept)
            table_rows, place = np.unique(own, return_inverse=True)
            place = place.reshape(own.shape)
            table_g = np.zeros((len(table_rows), WIDTH), np.float32)
            np.add.at(table_g, place[:, 0], d_x)
            for k in range(1, PARTS):
                np.add.at(table_g, place[:, k], d_x / (PARTS - 1))
            step += 1
            for name, grad in [*g.items(), ("table", table_g)]:
                at = table_rows if name == "table" else slice(None)
                m, v = moments[name]
                m[at] = 0.9 * m[at] + 0.1 * grad
                v[at] = 0.99 * v[at] + 0.01 * grad ** 2
                net.p[name][at] -= rate * (m[at] / (1 - 0.9 ** step)) / (np.sqrt(v[at] / (1 - 0.99 ** step)) + 1e-6)
    net.calibration = _logistic(document_features(len(texts), owner, logits()), y, share)
    return net


def document_features(n: int, owner: np.ndarray, logit: np.ndarray) -> np.ndarray:
    """Of each of n documents: highest and second highest logit of its windows, whether it has
    one window only, the mean probability and the logarithm of the number of windows.

    ``owner`` gives the document of each window.
    """
    out = np.tile([-8.0, -8.0, 1.0, 0.0, 0.0], (n, 1))
    if len(owner):
        order = np.lexsort((-logit, owner))
        who, value = owner[order], np.clip(logit[order], -8, 8)
        first = np.flatnonzero(np.r_[True, who[1:] != who[:-1]])
        many = np.diff(np.r_[first, len(who)])
        out[who[first], 0] = out[who[first], 1] = value[first]
        more = first[many > 1]
        out[who[more], 1], out[who[more], 2] = value[more + 1], 0.0
        out[who[first], 3] = np.add.reduceat(_sigmoid(value), first) / many
        out[who[first], 4] = np.log(many)
    return out


def _logistic(x: np.ndarray, y: np.ndarray, share: float | None) -> np.ndarray:
    """Weights and constant of a logistic fit with a small penalty, by Newton steps.

    Rows are weighted so that label 1 has its ``share``.
    """
    own = y.mean()
    share = min(max(own if share is None else share, 1e-3), 1 - 1e-3)
    weight = np.where(y == 1, share / own, (1 - share) / (1 - own))
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), 0.1 * np.eye(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + penalty, x.T @ (weight * (y - p)) - penalty @ w)
        w = w + step * min(1.0, 2.0 / (1e-9 + float(np.abs(step).max())))
    return w


class Scorer:
    """Scores texts; remembers what distinct words add to the gates, up to a bound."""

    MEMORY = 150_000

    def __init__(self, net: Network):
        self.net, self.number = net, {}
        self.gates = np.zeros((2, 1024, 3 * HIDDEN), np.float32)

    def _indices(self, texts_words: list[list[str]]) -> list[np.ndarray]:
        new = [w for w in dict.fromkeys(w for words in texts_words for w in words) if w not in self.number]
        if len(self.number) + len(new) > self.MEMORY:
            self.number.clear()
            new = list(dict.fromkeys(w for words in texts_words for w in words))
        if new:
            start = len(self.number)
            if start + len(new) > self.gates.shape[1]:
                grown = np.zeros((2, max(2 * self.gates.shape[1], start + len(new)), 3 * HIDDEN), np.float32)
                grown[:, :start] = self.gates[:, :start]
                self.gates = grown
            for s in range(0, len(new), 20_000):
                part = new[s:s + 20_000]
                self.gates[:, start + s:start + s + len(part)] = self.net.projected(
                    self.net.vectors(self.net.table_rows(part)))
            self.number.update(zip(new, range(start, start + len(new))))
        return [np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)) for words in texts_words]

    def scores(self, texts: list[str]) -> list[float]:
        out: list[float] = []
        held, size = [], 0
        for text in texts:
            words = words_of(text)
            held.append(words)
            size += len(words)
            if size > 100_000:
                out += self._some(held)
                held, size = [], 0
        return out + self._some(held)

    def _some(self, texts_words: list[list[str]]) -> list[float]:
        if not texts_words:
            return []
        units, owner = [], []
        for i, words in enumerate(self._indices(texts_words)):
            for a, b in windows_of(len(words)):
                if b > a:
                    units.append(words[a:b])
                    owner.append(i)
        parts = [self.net.forward(self.gates, *padded(units[s:s + 1024])) for s in range(0, len(units), 1024)]
        x = document_features(len(texts_words), np.array(owner, np.int64), np.concatenate(parts) if parts else np.zeros(0))
        w = self.net.calibration
        return _sigmoid(x @ w[:-1] + w[-1]).tolist()


def training_rows(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``doc_id, text, y`` of documents to learn from: at most ``per_class`` of each class,
    those with the smallest hashes of id and text, which any partitioning gives alike."""
    own = labels.where(learnable() & F.col(label).isin(0, 1)).select("doc_id", F.col(label).alias("y"))
    own = own.groupBy("doc_id").agg(F.max("y").alias("y"))
    order = F.xxhash64("doc_id")
    picked = None
    for y in (0, 1):
        one = own.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return texts.join(F.broadcast(picked), "doc_id")  # 2 x per_class rows at most


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> Network:
    rows = training_rows(docs, labels, "toxic", per_class).collect()
    rows = sorted({(r["doc_id"], r["text"], r["y"]) for r in rows})
    known = labels.where(learnable()).agg(F.count_if(F.col("toxic") == 1).alias("toxic"),
                                          F.count_if(F.col("toxic") == 0).alias("clean")).first()
    share = known["toxic"] / max(1, known["toxic"] + known["clean"])
    return train([r[1] for r in rows], [r[2] for r in rows], share)


def _scorer(sent) -> Scorer:
    net, held = sent.value, kept("toxicity")
    if held.get("of") is not net:
        held.update(of=net, scorer=Scorer(net))
    return held["scorer"]


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
                   per_class: int = TRAIN_DOCS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    A null or empty text gets the score of a text without words, as low as the scores go.
    Repeated rows get a row each; a null id counts as held out; null labels teach nothing;
    with labels of one class or none every text gets the same low score. Other columns are
    not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    def work(texts):
        return [(s, int(s >= threshold)) for s in _scorer(sent).scores(texts)]

    held = F.coalesce(~learnable(), F.lit(True)).alias("held_out")
    return map_texts(docs.select("doc_id", held, "text"), work, ["doc_id", "held_out"],
                     "doc_id bigint, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5,
               per_class: int = TRAIN_DOCS) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, unchanged."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, per_class))

    from .common import steps

    def run(batches):
        for batch in steps(batches):
            scores = _scorer(sent).scores([t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array([s < threshold for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
