"""Near duplicates by circulant MinHash, banding and exact verification.

Elements are 32-bit numbers of word n-grams. Two permutations of these numbers serve all
signature coordinates: the first one scatters the elements, the second one is applied to
them after a circular shift by k steps, and coordinate k is the least value it gives.
Two sets agree in a coordinate with the probability of their Jaccard similarity. ``ROWS``
neighbouring coordinates make a band; sets that agree in a band share a bucket. At a
similarity of 0.85 a pair shares none of the ``BANDS`` buckets with a probability of 3e-7.

Links are confirmed on the full sets of 64-bit n-gram hashes. Equal sets are one class from
the beginning. A few bands are compared first. After that only buckets that still hold
several groups are looked at, and in them only sets of different groups: most near copies
are joined by the first bands and then cost no more. A bucket of many sets, or of large ones, is compared block against block, so that no
task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import STEP_CHARS, staged, steps
from .components import components
from .decontaminate import _Hashes
from .partenum import gram_set

BANDS, ROWS = 32, 6
ROUNDS = ((0, 3), (3, BANDS))  # bands compared together
BLOCK_SETS = 500  # sets of a bucket held at once, against as many others
BLOCK_ELEMENTS = 2_000_000  # and their elements, unless one set has more
FEW_TEXTS = 500_000  # so many row hashes at most are sent to all tasks
RARE = 8  # an element of so many sets at most is counted pair by pair
CELLS = 8_000_000  # cells of the matrix of frequent elements made at once

_SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)[:, None]
_STEP = 512  # elements permuted at once, so that the work stays in the cache


def _scatter(x: np.ndarray) -> np.ndarray:
    """The first permutation of the 32-bit numbers."""
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x7FEB352D)
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x846CA68B)
    return x ^ (x >> np.uint32(16))


def signature(elements: np.ndarray) -> np.ndarray:
    """All coordinates of a set of 64-bit hashes: least second permutation of shifted places."""
    places = _scatter((elements >> np.uint64(32)).astype(np.uint32))
    least = np.full(len(_SHIFTS), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(places), _STEP):
        x = places[None, start:start + _STEP] + _SHIFTS
        y = x >> np.uint32(16)
        for odd, shift in ((0x85EBCA6B, 13), (0xC2B2AE35, 16)):
            x ^= y
            x *= np.uint32(odd)
            np.right_shift(x, np.uint32(shift), out=y)
        x ^= y
        np.minimum(least, x.min(axis=1), out=least)
    return least


def bucket_names(signatures: np.ndarray) -> np.ndarray:
    """A 64-bit name for every band of every signature (a row each)."""
    values = signatures.reshape(len(signatures), BANDS, ROWS).astype(np.uint64)
    name = np.broadcast_to((np.arange(BANDS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15),
                           values.shape[:2]).copy()
    for i in range(ROWS):
        name ^= values[:, :, i]
        name *= np.uint64(0xFF51AFD7ED558CCD)
        name ^= name >> np.uint64(32)
    return name.view(np.int64)


def joined(sets: list[np.ndarray], labels: list, percent: int, split: int | None = None) -> list[tuple[int, int]]:
    """For every set that links join to an earlier one, its place and the first place it is joined to.

    Sets are sorted arrays; those of one label count as joined, and pairs of them are left out.
    With ``split`` only links of one set before it and one from it on count.
    """
    m = len(sets)
    number = np.unique(np.array(labels, object), return_inverse=True)[1]
    sizes = np.array([len(s) for s in sets], np.int64)
    flat, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    column = np.cumsum(np.r_[True, flat[1:] != flat[:-1]]) - 1
    degree = np.bincount(column)
    common = np.zeros((m, m), np.float32)
    first = np.r_[0, np.cumsum(degree)[:-1]]
    for d in range(2, RARE + 1):
        places = first[degree == d]
        for i in range(d):
            for j in range(i):
                np.add.at(common, (owner[places + j], owner[places + i]), 1)
    often = degree[column] > RARE
    column, owner = column[often], owner[often]
    if len(column):
        column = np.cumsum(np.r_[False, column[1:] != column[:-1]])
        width = max(64, CELLS // m)
        for start in range(0, int(column[-1]) + 1, width):
            a, b = np.searchsorted(column, [start, start + width])
            part = np.zeros((m, int(column[b - 1]) + 1 - start), np.float32)
            part[owner[a:b], column[a:b] - start] = 1
            common += np.triu(part @ part.T)
    shared = common.astype(np.int64)
    near = np.triu(100 * shared >= percent * (sizes[:, None] + sizes[None] - shared), 1)
    near &= number[:, None] != number[None]
    if split is not None:
        near[:split, :split] = near[split:, split:] = False
    parent = list(range(int(number.max()) + 1))

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    linked = np.argwhere(near).tolist()
    for i, j in linked:
        parent[root(number[i])] = root(number[j])
    touched = {root(number[i]) for i, _ in linked}
    center, out = {}, []
    for i in range(m):
        group = root(number[i])
        if group in touched and center.setdefault(group, i) != i:
            out.append((i, center[group]))
    return out


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[list[dict]]:
    """Neighbouring rows that agree in ``by``, whatever batches they came in."""
    rows, last = [], None
    for batch in batches:
        for row in batch.to_pylist():
            name = tuple(row[c] for c in by)
            if rows and name != last:
                yield rows
                rows = []
            last = name
            rows.append(row)
    if rows:
        yield rows


def _compare(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``a, b``: sets joined within buckets ``name, key, n, label`` that have several labels."""
    several = staged(buckets.groupBy("name").agg(
        F.min("label").alias("low"), F.max("label").alias("high"),
        F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_ELEMENTS)).cast("int").alias("blocks"))
        .where("low <> high").select("name", "blocks"))
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    # Each block meets every block of its bucket, itself included, once.
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(j, block).alias("x"), F.greatest(j, block).alias("y")))
    placed = (buckets.join(several, "name").select("name", "key", "label", block.alias("block"), F.explode(meet).alias("at"))
              .select("name", "key", "label", "block", "at.x", "at.y").join(sets, "key"))

    def run(batches):
        for rows in _groups(batches, ["name", "x", "y"]):
            rows.sort(key=lambda r: (r["block"], r["key"]))
            split = sum(r["block"] == r["x"] for r in rows)
            found = joined([np.frombuffer(r["elements"], np.uint64) for r in rows], [r["label"] for r in rows],
                           percent, split if rows[0]["x"] != rows[0]["y"] else None)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([rows[i]["key"] for i, _ in found], pa.binary()),
                     pa.array([rows[j]["key"] for _, j in found], pa.binary())], names=["a", "b"])

    return (placed.repartition("name", "x", "y").sortWithinPartitions("name", "x", "y")
            .mapInArrow(run, "a binary, b binary"))


def near_duplicates(docs: DataFrame, percent: int = 85, n: int = 5, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at least ``percent`` percent
    similarity, and the row of that id is kept. Null and empty texts have an empty set and are
    linked with nothing; texts of fewer than ``n`` words have one gram. Repeated rows and
    ids give a row each and are linked like other copies. A row with a null id names no
    component unless it is alone, when ``component_id`` is null and it is kept. An empty
    table gives no rows; other columns are not looked at.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.withColumn("row", F.xxhash64("doc_id", "text"))

    def summarise(batches):
        hashes, seen = _Hashes(), set()
        for batch in steps(batches, limit=STEP_CHARS // 2):
            keys, sizes, made, signed = [], [], [], []
            for text in batch.column("text").to_pylist():
                elements = gram_set(text, hashes, n)
                key = xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None
                keys.append(key)
                sizes.append(len(elements))
                made.append(key is not None and key not in seen)
                if made[-1]:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(key)
                    signed.append(signature(elements))
            names = iter(bucket_names(np.array(signed)).tolist() if signed else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array([next(names) if m else None for m in made], pa.list_(pa.int64()))],
                names=["doc_id", "row", "key", "n", "names"])

    rows = staged(texts.mapInArrow(summarise, "doc_id bigint, row bigint, key binary, n bigint, names array<bigint>"))

    # Buckets that hold more than one set; copies that several tasks signed are one.
    signed = rows.where("names is not null").select("key", "n", F.explode("names").alias("name"))
    shared = staged(signed.groupBy("name").agg(F.min("key").alias("low"), F.max("key").alias("high"))
                    .where("low <> high").select("name"))
    signed = rows.where("names is not null").select("key", "n", F.posexplode("names").alias("band", "name"))
    buckets = staged(signed.join(shared, "name").groupBy("name", "key").agg(
        F.first("band").alias("band"), F.first("n").alias("n")))

    # One text of every set in such a bucket is read again for its elements.
    wanted = buckets.select("key").distinct()
    one = rows.where("key is not null").groupBy("key").agg(F.min("row").alias("row"))
    chosen = staged(one.join(wanted, "key", "left_semi"))
    few = chosen.count() <= FEW_TEXTS

    def elements_of(batches):
        hashes = _Hashes()
        for batch in steps(batches):
            found = [gram_set(t, hashes, n).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([xxhash.xxh3_128_digest(f) for f in found], pa.binary()), pa.array(found, pa.binary())],
                names=["key", "elements"])

    picked = chosen.select("row")
    again = texts.join(F.broadcast(picked) if few else picked, "row", "left_semi").select("text")
    sets = staged(again.mapInArrow(elements_of, "key binary, elements binary").dropDuplicates(["key"]))

    known = None
    for low, high in ROUNDS:
        part = buckets.where(F.col("band").between(low, high - 1)).select("name", "key", "n")
        if known is None:
            part = part.withColumn("label", F.col("key"))
        else:
            # What one round joined is one label, as far as one step shows; components come last.
            seen = known.groupBy("a").agg(F.min("b").alias("label")).withColumnRenamed("a", "key")
            part = staged(part.join(seen, "key", "left").withColumn("label", F.coalesce("label", "key")))
        found = staged(_compare(part, sets, percent))
        known = found if known is None else known.unionByName(found)
    labels = staged(components(known))

    classes = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = staged(classes.join(labels.withColumnRenamed("node", "key"), "key", "left").select(
        "key", "least", F.coalesce("label", "key").alias("label")))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    final = staged(named.join(least, "label").select("key", "component_id"))
    return (rows.select("doc_id", "key", F.col("n").alias("n_shingles")).join(final, "key", "left")
            .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
