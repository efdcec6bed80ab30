"""Benchmark decontamination by winnowed fingerprints.

A window is ``window`` consecutive words of a benchmark item; a shorter item is one window
by itself. From every run of ``window - gram + 1`` neighbouring word grams the one with
the smallest hash is kept, the last among equals. Any span of ``window`` words that a
document and an item share holds the same such run, so both keep the same gram of it. The
kept grams are joined and every hit is extended word by word to both sides; it counts if
the common span is as long as a window. Short items have grams of their own length, which
are looked for at every place.

Fingerprints of the benchmark become a bit table of fixed size that is sent to all tasks,
so that only grams which probably are in the benchmark leave the task that read the text.
The join compares the words themselves.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, steps, without

BITS = 22  # the bit table has 2**22 places
BROADCAST_GRAMS = 100_000  # a benchmark of more kept grams is joined by a shuffle

#: Lower-cases A-Z; all but digits, a-z and bytes of characters beyond ASCII become blanks.
_WORD_BYTES = bytes(
    b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256))
_ODD = np.array([0x9E3779B97F4A7C15 * (2 * i + 3) | 1 for i in range(64)], dtype=object)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, k, np.uint64)
    for i in range(k):
        total += words[i:i + n] * np.uint64(int(_ODD[i]) & (2**64 - 1))
        total ^= total >> np.uint64(29)
        total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def winnow(hashes: np.ndarray, run: int) -> np.ndarray:
    """Places of the smallest hash of every run of ``run``, the last among equals."""
    if len(hashes) < run:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, run)[:, ::-1]
    places = np.arange(len(views)) + (run - 1) - views.argmin(axis=1)
    return places[np.r_[True, places[1:] != places[:-1]]]


_HITS = pa.list_(pa.struct([("fp", pa.int64()), ("place", pa.int32()), ("left", pa.list_(pa.binary())),
                            ("gram", pa.binary()), ("right", pa.list_(pa.binary()))]))
_HITS_SQL = "array<struct<fp:bigint,place:int,left:array<binary>,gram:binary,right:array<binary>>>"


def _kept(words: list[bytes], hashes: _Hashes, window: int, gram: int, short: list[int], bits):
    """Hits of one text: kept grams that pass the bit table, with the words around them."""
    numbers = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    out = []
    for k in dict.fromkeys([gram, *short]):
        found = _gram_hashes(numbers, k)
        tries = []
        if k == gram:
            tries.append((winnow(found, window - gram + 1), window - gram))
        if k in short:
            tries.append((np.arange(len(found)), 0))
        for places, around in tries:
            fps = found[places] if around else found[places] ^ np.uint64(0x5851F42D4C957F2D)
            if bits is not None:
                keep = bits[fps >> np.uint64(64 - BITS)] != 0
                fps, places = fps[keep], places[keep]
            for fp, p in zip(fps.view(np.int64).tolist(), places.tolist()):
                out.append((fp, p, words[max(0, p - around):p][::-1], b" ".join(words[p:p + k]),
                            words[p + k:p + k + around]))
    return out


def _equal_run(a: str, b: str, most: int) -> Column:
    """How many leading words two lists share, up to ``most``."""
    def step(rest, i):
        same = F.get(F.col(a), F.lit(i)) == F.get(F.col(b), F.lit(i))
        return F.when(same, rest + 1).otherwise(0)
    return reduce(step, reversed(range(most)), F.lit(0))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row of ``docs``.

    Null and empty texts have no words: no hit as a document, no window as an item. A null
    item id is named ``null``; items with one id count once. Repeated documents get a row
    each. With an empty benchmark nothing is hit. Other columns are not looked at.
    """
    def fingerprints(batches):
        hashes = _Hashes()
        for batch in steps(batches):
            ids, rows = batch.column("id").to_pylist(), []
            for i, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                words = words_of(text or "")
                if words:
                    own = len(words) < window
                    hits = _kept(words, hashes, window, gram, [len(words)] if own else [], None)
                    rows += [(i, len(words) if own else 0, *h) for h in hits if not own or h[1] == 0
                             and len(h[3].split()) == len(words) and not h[2] and not h[4]]
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [batch.column("id").type, pa.int32(), pa.int64(), pa.int32(),
                     pa.list_(pa.binary()), pa.binary(), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["item_id", "short", "fp", "place", "left", "gram", "right"])

    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("id"),
                             F.col(item_text_col).alias("text"))
    kept = staged(items.mapInArrow(
        fingerprints, "item_id string, short int, fp bigint, place int, left array<binary>,"
                      " gram binary, right array<binary>"))
    summary = kept.agg(F.count("*").alias("n"), F.collect_set("short").alias("short")).first()
    short = sorted(n for n in summary["short"] if n)
    places = kept.select(F.shiftrightunsigned("fp", 64 - BITS).cast("int").alias("p")).distinct().toPandas()
    table = np.zeros(1 << BITS, np.uint8)
    table[places["p"].to_numpy(np.int64)] = 1
    sent = docs.sparkSession.sparkContext.broadcast(np.packbits(table).tobytes())

    def look(batches):
        hashes, bits = _Hashes(), np.unpackbits(np.frombuffer(sent.value, np.uint8))
        for batch in steps(batches):
            counts, hits = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text or "")
                counts.append(len(words))
                hits.append(_kept(words, hashes, window, gram, short, bits))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array([[dict(zip(("fp", "place", "left", "gram", "right"), h)) for h in one]
                           for one in hits], _HITS)],
                names=["doc_id", "n_words", "hits"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    looked = staged(texts.mapInArrow(look, f"doc_id bigint, n_words bigint, hits {_HITS_SQL}")
                    .withColumn("row", F.monotonically_increasing_id()))
    hits = (looked.where(F.size("hits") > 0).select("row", F.explode("hits").alias("h"))
            .select("row", "h.*"))
    side = kept.select("item_id", "short", "fp", F.col("left").alias("left2"),
                       F.col("gram").alias("gram2"), F.col("right").alias("right2"))
    side = F.broadcast(side) if summary["n"] <= BROADCAST_GRAMS else side
    most = window - gram
    spans = (hits.join(side, "fp").where(F.col("gram") == F.col("gram2"))
             .withColumn("l", _equal_run("left", "left2", most))
             .withColumn("r", _equal_run("right", "right2", most))
             .withColumn("k", F.when(F.col("short") > 0, F.col("short")).otherwise(gram))
             .where((F.col("short") > 0) | (F.col("l") + F.col("r") + gram >= window))
             .select("row", "item_id", (F.col("place") - F.col("l")).alias("start"),
                     (F.col("place") + F.col("k") + F.col("r")).alias("stop")))
    by_doc = spans.groupBy("row").agg(
        F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"),
        F.sort_array(F.collect_set("item_id")).alias("items"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["upto"]))).alias("n"),
            F.greatest(a["upto"], s["stop"]).alias("upto")),
        lambda a: a["n"])
    digest = by_doc.select("row", covered.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                           F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"))
    zero = F.lit(0).cast("bigint")
    return (looked.drop("hits").join(digest, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"),
                    F.coalesce("n_items", zero).alias("n_items"),
                    F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, unchanged.

    Each row is judged by its own text, whatever its id: null and repeated ids, null and empty
    texts and repeated rows need no care. Null and empty texts stay.
    """
    named = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    hit = decontaminate(named, benchmark, window, id_col="__row").where("contaminated").select(
        F.col("doc_id").alias("__row")).distinct()
    return without(named, hit, "__row").select(*docs.columns)


#: The same by joining all windows as texts.
ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
lengths AS (SELECT DISTINCT least(len(w), 10) AS k FROM bw WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS t
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM bw WHERE len(w) > 0)),
grams AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS t
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, lengths WHERE len(w) >= k)),
hits AS (SELECT doc_id, item_id, i, k FROM grams JOIN windows USING (k, t)),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, sha256(string_agg(id, ',' ORDER BY id)) AS h
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
       coalesce(items.h, sha256('')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
