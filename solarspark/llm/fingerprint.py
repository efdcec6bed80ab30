"""Document fingerprints: sums of wide vectors hashed from the parts of a text.

A text is a multiset of parts: its paragraphs, long ones cut after sentences and, where
there are none, after every so many characters. A part is hashed to a vector of LANES odd
numbers between -255 and 255; a fingerprint is the sum of the vectors of all parts modulo
a power of two in each lane. The sum does not depend on the order of parts, and parts are
put in and taken out by adding and subtracting their vectors. Two fingerprints are equal
for equal multisets, and for others with negligible probability.

The difference of two fingerprints is the fingerprint of what the two multisets do not
share. The mean square of its lanes estimates how many parts these are, from which the
likeness of two texts follows without the texts.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, sha256, staged, steps

LANES = 256
MODULUS = 2 ** 32
LONG = 64  # a part of more characters is cut every PIECE characters
PIECE = 32
_POWER = sum(v * v for v in range(-255, 256, 2)) / 256  # mean square of a lane of one vector


def parts_of(text: str) -> list[str]:
    """The multiset of parts of a text, as a list."""
    out = []
    for part in text.replace(". ", ".\n").split("\n"):
        if len(part) > LONG:
            out += [part[i:i + PIECE] for i in range(0, len(part), PIECE)]
        elif part:
            out.append(part)
    return out


def vectors(parts: list[str]) -> np.ndarray:
    """One row of LANES odd numbers for every part."""
    raw = b"".join([hashlib.shake_128(p.encode("utf-8", "surrogatepass")).digest(LANES) for p in parts])
    return np.frombuffer(raw, np.int8).reshape(-1, LANES)


def _odd_sum(rows: np.ndarray) -> np.ndarray:
    """Sum of the odd vectors 2 v + 1 of rows of bytes."""
    return 2 * rows.sum(axis=0, dtype=np.int64) + len(rows)


def fingerprint(parts: list[str]) -> np.ndarray:
    return _odd_sum(vectors(parts)) % MODULUS if parts else np.zeros(LANES, np.int64)


def inserted(state: np.ndarray, parts: list[str]) -> np.ndarray:
    return (state + fingerprint(parts)) % MODULUS


def deleted(state: np.ndarray, parts: list[str]) -> np.ndarray:
    return (state - fingerprint(parts)) % MODULUS


def _signed(state: np.ndarray) -> np.ndarray:
    state = state % MODULUS
    return np.where(state >= MODULUS // 2, state - MODULUS, state).astype(np.float64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Between 0 and 1: one less the share of parts that the two do not share, as estimated."""
    apart = _signed(a - b)
    if not apart.any():
        return 1.0
    power = float((_signed(a) ** 2).sum() + (_signed(b) ** 2).sum())
    return min(1.0, max(0.0, 1.0 - float((apart ** 2).sum()) / power)) if power else 0.0


def name(state: np.ndarray, empty: bool) -> str:
    """Short name of a fingerprint in hexadecimal; texts without parts differ if one is not empty."""
    return sha256(state.astype("<u4").tobytes() + (b"" if empty else b"+"))


class _Text:
    """A text with its parts and their vectors."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.counts = Counter(parts_of(text))
        self.rows = dict(zip(self.counts, vectors(list(self.counts)))) if self.counts else {}
        self.state = self.sum(self.counts)

    def sum(self, counts: Counter, other: dict | None = None) -> np.ndarray:
        if not counts:
            return np.zeros(LANES, np.int64)
        rows = [self.rows[p] if p in self.rows else other[p] for p in counts]
        weights = np.fromiter(counts.values(), np.int64, len(counts))
        total = np.stack(rows).astype(np.float64).T @ weights  # exact below 2**53
        return (2 * total.astype(np.int64) + int(weights.sum())) % MODULUS

    def against(self, following: "_Text") -> tuple:
        """The row of results with the next document's text."""
        n = len(self.text)
        half = n // 2
        edited = self.text[:n - half] + following.text[:half]
        counts = Counter(parts_of(edited))
        gone, new = self.counts - counts, counts - self.counts
        known = following.rows
        unknown = [p for p in new if p not in known]
        if unknown:
            known = known | dict(zip(unknown, vectors(unknown)))
        changed = (self.state - self.sum(gone) + self.sum(new, known)) % MODULUS
        return (self.doc_id, n, sha256(edited.encode("utf-8", "surrogatepass")), name(self.state, not n),
                name(changed, not edited), likeness(self.state, changed), likeness(self.state, following.state))


_RESULT = ("doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string,"
           " edited_fingerprint string, near_edited double, near_next double")
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_parts, fingerprint`` (LANES 32-bit numbers, little-endian) of every row.

    Null and empty texts have no parts and a zero fingerprint.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(texts):
        return [(len(p := parts_of(t)), fingerprint(p).astype("<u4").tobytes()) for t in texts]

    return map_texts(rows, work, ["doc_id"], "doc_id bigint, n_parts bigint, fingerprint binary")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    In the edited text the last half of the code points is replaced by the first as many of
    the next document in order of id, after the last the first. Its fingerprint comes from
    the text's own by taking parts out and putting parts in. Null counts as the empty text.
    Equal ids are ordered by a hash of the text; a null id comes first. A single document is
    its own next one. Empty input gives no rows; other columns are not looked at.

    Rows are dealt by ranges of ids, so that almost every document finds the next one in
    its own task. The last of each range meets the first of the next through a small join
    of as many rows as there are ranges.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def walk(batches):
        number, before = TaskContext.get().partitionId(), None

        def batch_of(found, edges):
            k = len(edges)
            columns = [pa.array([e[0] for e in edges] + ["row"] * len(found), pa.string()),
                       pa.array([number] * (k + len(found)), pa.int32()),
                       pa.array([e[2] for e in edges] + [None] * len(found), pa.string())]
            columns += [pa.array([e[1] if i == 0 else None for e in edges] + [f[i] for f in found], t)
                        for i, t in enumerate(_TYPES)]
            return pa.RecordBatch.from_arrays(columns, names=["kind", "number", "text", *_NAMES])

        for batch in steps(batches):
            found, edges = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                current = _Text(doc_id, text)
                if before is None:
                    edges.append(("first", doc_id, text))
                else:
                    found.append(before.against(current))
                before = current
            yield batch_of(found, edges)
        if before is not None:
            yield batch_of([], [("last", before.doc_id, before.text)])

    walked = staged(dealt.mapInArrow(walk, f"kind string, number int, text string, {_RESULT}"))
    ranges = sorted(r["number"] for r in walked.where("kind = 'first'").select("number").collect())
    following = spark.createDataFrame(list(zip(ranges, ranges[1:] + ranges[:1])), "number int, next int")
    last = walked.where("kind = 'last'").join(following, "number").select("doc_id", "text", "next")
    first = walked.where("kind = 'first'").select(F.col("number").alias("next"), F.col("text").alias("next_text"))

    def meet(batches):
        for batch in batches:
            ids, texts, others = (batch.column(c).to_pylist() for c in ("doc_id", "text", "next_text"))
            found = [_Text(i, t).against(_Text(None, u)) for i, t, u in zip(ids, texts, others)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[i] for f in found], t) for i, t in enumerate(_TYPES)], names=_NAMES)

    edges = last.join(first, "next").select("doc_id", "text", "next_text").mapInArrow(meet, _RESULT)
    return walked.where("kind = 'row'").select(*_NAMES).unionByName(edges)
