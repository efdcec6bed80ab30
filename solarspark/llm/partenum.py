"""Similarity join of texts by n-gram sets with signatures from enumerated partitions.

Sets with a Jaccard similarity of at least ``percent`` / 100 have sizes in one band or in
neighbouring bands, and differ in at most k elements, where k follows from the band. The
domain of the hashed n-grams is cut into more than k equal ranges. Two such sets agree on
all ranges but k, so

* for a small k every combination of three out of k + 3 ranges gives a signature, and at
  least one combination agrees;
* for a larger k each of k + 1 + e + k / 4 ranges gives a signature, and all but k agree. A
  range without elements gives none, unless a set has more than e of them; e is chosen by
  band so that hardly any set has. So similar sets share more than k / 4 signatures.

Signatures that only one set has are dropped, and then all of a set in a band with fewer
left than similar sets share; that is done twice, as it leaves others alone. What is left
links sets as candidates. Links by chance run most sets with a common passage together into
one component that grows with the corpus. So in components of many sets only those are linked
that share one of their rarest elements: similar sets do, if each offers as many as it may lack
in the other and one more, in one order for all. Components are small then; their sets meet in
one task, or block by block if there are many, and are compared exactly. Equal sets are one
class from the beginning, so copies cost nothing further.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from functools import lru_cache, partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import FEW_KEYS, STEP_CHARS, bit_table, free, free_shuffles, shuffles_go, staged, steps, unpacked, without
from .components import components
from .decontaminate import _gram_hashes, _Hashes

BLOCK = 2000  # sets of a candidate component compared in one task, against as many others
BLOCK_BYTES = 32_000_000  # and their elements, unless one set has more
FEW = 8  # up to so many differing elements, ranges are combined
BAND_BITS = 10
RANGE = 500_000  # elements of all these sets counted at once, about
ROWS = 256  # of the table of pairs worked on at once
PART_CELLS = 4_000_000  # of a table of sets and frequent elements
RARE = 12  # an element of so many sets at most is counted pair by pair
FEW_SETS = 200  # candidate components of more sets are linked again by rare elements
COUNT_BITS = 24  # elements are counted in 2**24 places at most
COUNTS = 1 << 16  # places summed together
ROUNDS = 2  # of dropping signatures that cannot lead to a link
BITS = 27  # the table of candidate sets has 2**27 places at most, eight for each set below that

#: Lower-cases A-Z. bytes.split() then cuts at U+0020 and U+0009 to U+000D, and nowhere else.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def gram_set(text: str | None, hashes: dict, n: int) -> np.ndarray:
    """Sorted hashes of the distinct n-grams of words; a shorter text is one gram."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    numbers = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    return np.unique(_gram_hashes(numbers, min(n, len(words))))


@lru_cache(4)
def _bands(percent: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """Upper ends of the size bands; how many elements sets of a band and the next may differ
    in; how many ranges may be empty; and how many signatures similar sets share at least."""
    ends = [next(n for n in range(1, 1 << 30) if n * (100 - percent) // percent >= 1) - 1]
    while ends[-1] < 1 << 32:
        ends.append((ends[-1] + 1) * 100 // percent)
    differ, empty = [e * (100 - percent) // percent for e in ends], []
    for k, least in zip(differ, [1, *(e + 1 for e in ends)]):
        best = (-1.0, 2)
        spare = 2
        while k > FEW and spare <= k + 2 and best[0] < 5.0:
            # Empty ranges are about Poisson distributed: how many deviations are left?
            parts = k + 1 + k // 4 + spare
            mean = parts * math.exp(-least / parts)
            best = max(best, ((spare - mean) / math.sqrt(mean), spare))
            spare += 1 + spare // 20
        empty.append(best[1])
    return ends, differ, empty, [1 if k <= FEW else 1 + k // 4 for k in differ]


def signatures(elements: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a sorted set, each with its band in the last bits.

    Sets within the first band match only if they are equal and have none.
    """
    n, (ends, differ, empty, shared) = len(elements), _bands(percent)
    own = bisect_left(ends, n)
    if not n:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        sums, out = np.r_[np.uint64(0), np.cumsum(elements, dtype=np.uint64)], []
        for band in {max(own - 1, 0), own}:
            k = differ[band]
            if k == 0:
                continue
            parts = k + 3 if k <= FEW else k + shared[band] + empty[band]
            borders = (np.arange(1, parts, dtype=np.float64) / parts * 2.0 ** 64).astype(np.uint64)
            at = np.r_[0, np.searchsorted(elements, borders), n]
            each = sums[at[1:]] - sums[at[:-1]]
            if k <= FEW:
                chosen = list(combinations(range(parts), 3))
                values = np.array([each[list(c)].sum(dtype=np.uint64) for c in chosen], np.uint64)
                names = np.arange(len(chosen), dtype=np.uint64)
            else:
                full = at[1:] > at[:-1]
                names = np.arange(parts, dtype=np.uint64)
                if parts - int(full.sum()) <= empty[band]:
                    each, names = each[full], names[full]
                values = each
            salt = (names + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band * 0x632BE59BD9B4E019 % 2**64)
            mixed = (values ^ salt) * np.uint64(0xFF51AFD7ED558CCD)
            mixed = (mixed ^ (mixed >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
            mixed ^= mixed >> np.uint64(33)
            out.append(mixed >> np.uint64(BAND_BITS) << np.uint64(BAND_BITS) | np.uint64(band))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


def _shared_counts(sets: list[np.ndarray], common: np.ndarray) -> None:
    """Add to ``common`` how many elements each set shares with those before it, or with any by products."""
    m = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m, dtype=np.int32), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.r_[True, flat[1:] != flat[:-1]][:len(flat)]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1  # an element of one set alone is in no intersection
    column, owner = column[shared], owner[shared]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    degree = np.bincount(column)
    # Elements of few sets add to their pairs one by one, those of many by products.
    for d in np.unique(degree[degree <= RARE]).tolist():
        owners = owner[degree[column] == d].reshape(-1, d)
        for i in range(d):
            for j in range(i):
                np.add.at(common, (owners[:, j], owners[:, i]), 1)
                np.add.at(common, (owners[:, i], owners[:, j]), 1)
    often = degree[column] > RARE
    column, owner = column[often], owner[often]
    column = np.unique(column, return_inverse=True)[1] if len(column) else column
    width = max(256, min(4096, PART_CELLS // max(m, 1)))
    for start in range(0, int(column.max()) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((m, min(width, int(column[b - 1]) + 1 - start)), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        for row in range(0, m, ROWS):
            common[row:row + ROWS] += part[row:row + ROWS] @ part.T


def linked(sets: list[np.ndarray], percent: int, split: int | None = None) -> np.ndarray:
    """Label of each set: the first one it reaches through sets at least that similar.

    With ``split`` only pairs of one set before it and one from it on are compared. Sets are
    sorted. They are counted range by range of the hashed domain, some ``RANGE`` elements at a
    time, so that beside the sets only the table of their pairs takes much memory.
    """
    m = len(sets)
    sizes = np.array([len(s) for s in sets], np.float32)
    ranges = 1 + sum(map(len, sets)) // RANGE
    borders = (np.arange(1, ranges, dtype=np.float64) / ranges * 2.0 ** 64).astype(np.uint64)
    cuts = [np.r_[0, np.searchsorted(s, borders), len(s)] for s in sets]
    common = np.zeros((m, m), np.float32)
    for i in range(ranges):
        _shared_counts([s[c[i]:c[i + 1]] for s, c in zip(sets, cuts)], common)
    np.fill_diagonal(common, sizes)
    near = np.zeros((m, m), bool)
    for row in range(0, m, ROWS):
        own = common[row:row + ROWS]
        near[row:row + ROWS] = 100 * own >= percent * (sizes[row:row + ROWS, None] + sizes[None] - own)
    if split is not None:
        near[:split, :split] = near[split:, split:] = False
    labels = np.full(m, -1)
    for i in range(m):
        if labels[i] < 0:
            labels[i], front = i, [i]
            while front:
                reached = np.flatnonzero(near[front].any(axis=0) & (labels < 0))
                labels[reached], front = i, reached.tolist()
    return labels


def rarest(elements: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """Of a set the elements, least counted first, of which sets at least that similar share one;
    without those that no other set has. ``counts`` are by the first bits of an element."""
    n = len(elements)
    often = counts[elements >> np.uint64(65 - len(counts).bit_length())]
    first = np.lexsort((elements, often))[:n + (-percent * n) // 100 + 1]
    return elements[first[often[first] > 1]]


def _shared_by_several(signed: DataFrame) -> DataFrame:
    """``sig, node, hub, last``: rows whose ``sig`` several nodes have, and the least and last of these."""
    alike = Window.partitionBy("sig")
    ends = signed.select("sig", "node", F.min("node").over(alike).alias("hub"), F.max("node").over(alike).alias("last"))
    return ends.where("hub <> last")


def _linked_by_rare(sets: DataFrame, percent: int) -> DataFrame:
    """``node, label``: sets (node, elements) that share a rare element, by component; others are left out."""
    spark = sets.sparkSession
    total = sets.agg(F.sum(F.length("elements"))).first()[0] or 0
    bits = min(COUNT_BITS, max(10, (total // 8).bit_length()))
    size = min(COUNTS, 1 << bits)

    def found(batches):
        for batch in steps(batches, "elements"):
            yield batch, [np.frombuffer(e.as_buffer(), np.uint64) for e in batch.column("elements")]

    def count(batches):
        counts = np.zeros(1 << bits, np.uint16)
        for _, held in found(batches):
            for elements in held:
                at = elements >> np.uint64(64 - bits)  # several elements of a set in one place count once
                counts[at] = np.minimum(counts[at], 65_534) + np.uint16(1)
        for i, part in enumerate(counts.reshape(-1, size)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()])], names=["part", "n"])

    def summed(table: pa.Table) -> pa.Table:
        total = np.zeros(size, np.int64)
        for part in table.column("n"):
            total += np.frombuffer(part.as_buffer(), np.uint16)
        return pa.table({"part": table.column("part")[:1], "n": pa.array([np.minimum(total, 65_535).astype(np.uint16).tobytes()])})

    few = sets.coalesce(2 * spark.sparkContext.defaultParallelism)  # each hands on all its counts
    with shuffles_go(spark):
        parts = few.select("elements").mapInArrow(count, "part int, n binary").groupBy("part").applyInArrow(
            summed, "part int, n binary").toArrow()
    counts = np.zeros((1 << bits) // size * size, np.uint16).reshape(-1, size)
    for part, n in zip(parts.column("part").to_pylist(), parts.column("n").to_pylist()):
        counts[part] = np.frombuffer(n, np.uint16)
    sent = spark.sparkContext.broadcast(counts.tobytes())

    def rare(batches):
        counts = np.frombuffer(sent.value, np.uint16)
        for batch, held in found(batches):
            kept = [rarest(elements, counts, percent) for elements in held]
            nodes = np.repeat(batch.column("node").to_numpy(), [len(k) for k in kept])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(kept).view(np.int64)), pa.array(nodes)], names=["sig", "node"])

    shared = _shared_by_several(sets.select("node", "elements").mapInArrow(rare, "sig bigint, node bigint"))
    return components(shared.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")))


def similar_components(docs: DataFrame, percent: int = 90, n: int = 3, id_col: str = "doc_id",
                       text_col: str = "text", lots: int = 1) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Signatures are made and shuffled in ``lots``: more need less disk at a time, and read the
    texts as often.

    ``component_id`` is the smallest id reachable over links of at least ``percent`` percent
    similarity. Null and empty texts have an empty set and are linked with nothing; texts
    of fewer than ``n`` words have one gram. Repeated rows and ids give a row each and are
    linked like other copies. Rows with a null id never name a component unless alone, when
    it is null. Empty input gives no rows; other columns are not looked at.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def summarise(batches):
        hashes = _Hashes()
        for batch in steps(batches):
            keys, sizes = [], []
            for text in batch.column("text").to_pylist():
                elements = gram_set(text, hashes, n)
                keys.append(xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None)
                sizes.append(len(elements))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())],
                names=["doc_id", "key", "n"])

    def sign(batches, lot):
        hashes, seen = _Hashes(), set()
        for batch in steps(batches, limit=STEP_CHARS // 4):
            nodes, signed = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for text in batch.column("text").to_pylist():
                elements = gram_set(text, hashes, n)
                key = xxhash.xxh3_128_digest(elements.tobytes())
                if key in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(key)
                own = signatures(elements, percent)
                signed.append(own[(own.view(np.uint64) >> np.uint64(40)) % np.uint64(lots) == lot])
                nodes.append(np.full(len(signed[-1]), int.from_bytes(key[:7], "big")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(signed)), pa.array(np.concatenate(nodes))], names=["sig", "node"])

    rows = staged(texts.mapInArrow(summarise, "doc_id bigint, key binary, n bigint"))
    parts = []
    for lot in range(lots):
        parts.append(staged(_shared_by_several(texts.mapInArrow(
            partial(sign, lot=lot), "sig bigint, node bigint")).select("sig", "node").distinct()))
        free_shuffles(docs.sparkSession)
    signed = reduce(DataFrame.unionByName, parts)
    band = F.col("sig").bitwiseAND((1 << BAND_BITS) - 1).cast("int")
    needed = F.get(F.array(*map(F.lit, _bands(percent)[3])), F.col("band"))
    for _ in range(ROUNDS):
        signed = signed.withColumn("band", band)
        strong = staged(signed.groupBy("node", "band").agg(F.count("*").alias("n")).where(F.col("n") >= needed)
                        .select("node", "band"))
        few = strong.count() <= FEW_KEYS  # then signatures are not shuffled to meet them
        left = staged(_shared_by_several(signed.join(
            F.broadcast(strong) if few else strong, ["node", "band"]).select("sig", "node")))
        free(signed, strong)
        signed = left
        free_shuffles(docs.sparkSession)
    hubs = signed.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    groups = staged(components(hubs))
    free(signed)
    # Only sets that are candidates leave the task that reads their text, others by chance.
    bits = min(BITS, max(10, (8 * groups.count()).bit_length()))
    sent = bit_table(groups.select(F.shiftleft("node", 8).alias("mark")), "mark", bits)

    def sets(batches):
        hashes, seen, table = _Hashes(), set(), unpacked(sent)
        for batch in steps(batches):
            keys, nodes, found = [], [], []
            for text in batch.column("text").to_pylist():
                elements = gram_set(text, hashes, n)
                key = xxhash.xxh3_128_digest(elements.tobytes())
                number = int.from_bytes(key[:7], "big")
                if len(elements) and table[number >> (56 - bits)] and key not in seen:
                    if len(seen) > 200_000:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    nodes.append(number)
                    found.append(elements.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(nodes, pa.int64()), pa.array(found, pa.binary())],
                names=["key", "node", "elements"])

    own = texts.mapInArrow(sets, "key binary, node bigint, elements binary")
    once = staged(own.groupBy("node", "key").agg(F.first("elements").alias("elements")).join(groups, "node"))
    many = staged(once.groupBy("label").agg(F.count("*").alias("sets"), F.sum(F.length("elements")).alias("bytes"))
                  .where((F.col("sets") > FEW_SETS) | (F.col("bytes") > BLOCK_BYTES)).select("label", F.lit(True).alias("many")))
    free_shuffles(docs.sparkSession)
    if not many.isEmpty():
        again = staged(_linked_by_rare(once.join(F.broadcast(many), "label"), percent)).withColumnRenamed("label", "own")
        again = F.broadcast(again) if again.count() <= FEW_KEYS else again
        once = (once.join(F.broadcast(many), "label", "left").join(again, "node", "left")
                .where("many is null or own is not null").withColumn("label", F.coalesce("own", "label")))
    large = staged(once.groupBy("label").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum(F.length("elements")) / BLOCK_BYTES)).cast("int").alias("blocks"))
        .where("blocks > 1"))
    free_shuffles(docs.sparkSession)
    once = once.join(large, "label", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
    meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(
        F.least(j, block).alias("x"), F.greatest(j, block).alias("y")))
    placed = once.select("label", "key", "elements", block.alias("block"), F.explode(meet).alias("at"))

    def compare(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_pylist()
        # Views of what Arrow holds, no copies.
        raw = [np.frombuffer(e.as_buffer(), np.uint64) for e in table.column("elements")]
        blocks = table.column("block").to_numpy()
        order = sorted(range(len(keys)), key=lambda i: (blocks[i], keys[i]))
        split = int((blocks == blocks.min()).sum())
        labels = linked([raw[i] for i in order], percent, split if split < len(keys) else None)
        a = [keys[order[i]] for i in range(len(keys)) if labels[i] != i]
        b = [keys[order[labels[i]]] for i in range(len(keys)) if labels[i] != i]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    links = placed.groupBy("label", "at.x", "at.y").applyInArrow(compare, "a binary, b binary")
    joined = components(links)
    classes = rows.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("least"))
    named = classes.join(joined.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "label", F.coalesce("label", "key"))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    final = named.select("key", "label").join(least, "label").select("key", "component_id")
    return rows.select("doc_id", "key", F.col("n").alias("n_shingles")).join(final, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_first(docs: DataFrame, percent: int = 90, n: int = 3, lots: int = 2) -> DataFrame:
    """One document of each component: the one with the smallest id, unchanged.

    Of rows that repeat this id one stays. Documents without words all stay, and so do rows
    with a null id, which nothing can name.
    """
    spare = similar_components(docs, percent, n, lots=lots).where("doc_id <> component_id").select("doc_id").distinct()
    kept = without(docs, spare, "doc_id").select(*docs.columns)
    repeated = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    repeated = staged(repeated)
    once = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, "doc_id", "left_anti").unionByName(once).select(*docs.columns)
