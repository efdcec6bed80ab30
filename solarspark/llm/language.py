"""Language of a text as a mixture of languages.

Every language has probabilities of hashed letter trigrams, counted on labelled documents.
A document is a mixture: expectation-maximisation finds the proportions of the languages
that make its trigrams likeliest. Sets of languages are compared by their likelihood less
a penalty for each language, and the language with the largest proportion is the answer.
"""

from __future__ import annotations

import math
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import learnable, map_texts, steps

BITS = 16  # trigrams are hashed to 2**16 places
TRAIN_DOCS = 3000  # documents of each language to learn from, on average at most
ROUNDS = 12
OVERLAP = 3  # neighbouring trigrams share letters; their joint weight is divided by this


@lru_cache(2)
def _in_category(kinds: str) -> np.ndarray:
    """True for code points whose category begins with one of the letters."""
    return np.array([unicodedata.category(chr(i))[0] in kinds for i in range(0x110000)])


def grams(text: str) -> np.ndarray:
    """Places of the letter trigrams of a text, sorted; words are set off by a blank."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    if not _in_category("L")[points].any():  # marks alone are no text
        return np.zeros(0, np.uint16)
    is_letter = _in_category("LM")[points]
    points = np.where(is_letter, points, 32).astype(np.uint32)
    keep = np.r_[True, (points[1:] != 32) | (points[:-1] != 32)]
    p = points[keep]
    mixed = p[:-2] * np.uint32(0x9E3779B1) ^ p[1:-1] * np.uint32(0x85EBCA6B) ^ p[2:] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return np.sort((mixed >> np.uint32(32 - BITS)).astype(np.uint16), kind="stable")


def counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    found = grams(text)
    if not len(found):
        return found, found
    new = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    return found[new], np.diff(np.r_[new, len(found)])


class Mixture:
    def __init__(self, names: list[str], counts: np.ndarray, documents: np.ndarray):
        self.names = names
        smooth = counts + 0.05
        self.chance = (smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float64)
        self.prior = (documents + 1.0) / (documents.sum() + len(names))

    def _fit(self, chance: np.ndarray, weight: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, float]:
        start = share
        for _ in range(ROUNDS if len(share) > 1 else 0):
            mixed = share @ chance
            share = share * (chance @ (weight / mixed)) + start
            share /= share.sum()
        return share, float(weight @ np.log(share @ chance))

    def predict(self, text: str) -> tuple[str, float]:
        places, weight = counted(text)
        if not len(places) or not self.names:
            return "und", 0.0
        weight = weight / OVERLAP
        chance = self.chance[:, places]
        share, _ = self._fit(chance, weight, self.prior / self.prior.sum())
        order, best = np.argsort(-share, kind="stable"), None
        for k in range(1, len(order) + 1):
            chosen = order[:k]
            part, likelihood = self._fit(chance[chosen], weight, share[chosen] / share[chosen].sum())
            value = likelihood - 0.5 * (k - 1) * math.log(1 + weight.sum())
            if best is not None and value <= best[0]:
                break
            best = (value, chosen, part)
        _, chosen, part = best
        top = int(np.argmax(part))
        return self.names[chosen[top]], float(part[top])


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Mixture:
    """Count trigrams of each language on documents that are not held out.

    A language with more than ``train_docs`` documents gives about as many, chosen by a hash
    of the id. The driver gets one row of counts for each language.
    """
    known = docs.where(learnable() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return Mixture([], np.zeros((0, 1 << BITS)), np.zeros(0))
    share = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, min(1.0, train_docs / n))])
    picked = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for batch in steps(batches):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                held.setdefault(lang, np.zeros(1 << BITS, np.int64))
                held[lang] += np.bincount(grams(text), minlength=1 << BITS)
        for lang, counts in held.items():
            places = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(places), pa.string()), pa.array(places, pa.int32()),
                 pa.array(counts[places], pa.int64())], names=["lang", "place", "n"])

    rows = (picked.select("lang", "text").mapInArrow(count, "lang string, place int, n bigint")
            .groupBy("lang", "place").agg(F.sum("n").alias("n")).toPandas())
    names = sorted(totals)
    counts = np.zeros((len(names), 1 << BITS))
    counts[rows["lang"].map({k: i for i, k in enumerate(names)}).to_numpy(int), rows["place"].to_numpy(int)] = rows["n"]
    return Mixture(names, counts, np.array([totals[k] for k in names], float))


def predict_language(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``.

    ``score`` is the proportion of the predicted language. A text that is null or has no
    letter is ``und`` with score 0, and so is every text if no language was learned. A null
    id counts as held out. Repeated rows give a row each, empty input gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, train_docs))

    def work(texts):
        return [sent.value.predict(t) for t in texts]

    held = F.coalesce(~learnable(), F.lit(True)).alias("held_out")
    return map_texts(docs.select("doc_id", held, "text"), work, ["doc_id", "held_out"],
                     "doc_id bigint, held_out boolean, lang_pred string, score double")
