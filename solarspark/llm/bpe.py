"""Encoding and decoding with a pair-merging tokenizer through a table of distinct words.

Words are split in Spark and counted over all documents. The words that occur most often,
as many as ``table_words`` allows, are each encoded once and become the word table; their
pieces come from a join with the table of ids and pieces. It has a fixed bound, so it is
sent to all tasks, which put the ids of each document together by the places of its words.
A word that is not in the table is encoded in the task that meets it, once for each batch:
most such words occur once in all, and moving every document or every rare occurrence
through a shuffle would cost more than encoding them.
"""

from __future__ import annotations

import json
import pickle
import re
import struct
import unicodedata
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, map_texts, sha256, staged, steps

TABLE_WORDS = 200_000
COUNT_BINS = 100_000  # counts are compared one by one up to here, beyond by powers of two
MAX_TAIL = 100_000  # rare words a task remembers
PLANE = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x10000)]))  # the first one


class WordTokenizer:
    """A tokenizer file whose encoding of a text is that of its words one after another.

    It must normalise by composition, white space and lower case, split by one pattern that
    matches no white space, and have no post-processing.
    """

    def __init__(self, path: str):
        import tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        assert kinds == ["NFC", "Replace", "Lowercase"] and spec["post_processor"] is None
        assert split["behavior"] == "Removed" and split["invert"] and spec["decoder"] is None
        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.normalizer, self.merges = self.library.normalizer, self.library.model
        self.pattern = re.compile(spelled_out(split["pattern"]["Regex"]))
        self.by_property = regex.compile(split["pattern"]["Regex"])
        lowered = tokenizers.normalizers.Lowercase().normalize_str("".join(c + "\r" for c in PLANE if c != "\r"))
        newer = [c for c, low in zip(PLANE.replace("\r", ""), lowered.split("\r")) if c.replace("Σ", "σ").lower() != low]
        # Characters that Python lowers otherwise, or that are outside the first plane.
        self.odd = re.compile(f"[{''.join(map(re.escape, newer))}\U00010000-\U0010ffff]")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.between = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.pieces = {i: p for p, i in self.library.get_vocab(with_added_tokens=True).items()}
        # Printable bytes stand for themselves, the others for the letters from 256 on.
        others = [b for b in range(256) if b == 32 or not chr(b).isprintable()]
        self.letters = {b: 256 + i for i, b in enumerate(others)}

    def words(self, text: str) -> list[str]:
        """Words and special tokens of a text in order."""
        if "<|" in text and self.between.search(text):
            out = []
            for part in self.between.split(text):
                out += [part] if part in self.special else self.words(part)
            return out
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if self.odd.search(text):
                return self.by_property.findall(text.lower())
        return self.pattern.findall(text.lower())

    def settled(self, word: str) -> bool:
        return (not self.odd.search(word) and self.pattern.fullmatch(word) is not None
                and self.normalizer.normalize_str(word) == word)

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; a special token has its own.

        The library merges the bytes of words that it would neither normalise nor split again.
        Others, whose characters are newer than Python's tables, it gets as a text.
        """
        out = []
        for word in words:
            if word in self.special:
                out.append([self.special[word]])
                continue
            if not (word.isascii() and word.isprintable()):
                if not self.settled(word):
                    out.append(self.library.encode(word, add_special_tokens=False).ids)
                    continue
                word = word.encode().decode("latin-1").translate(self.letters)
            out.append([token.id for token in self.merges.tokenize(word)])
        return out


def spelled_out(pattern: str) -> str:
    """The pattern with the characters listed that the library puts in each of its classes.

    Python's own ``re`` takes half the time that a search by properties takes, as long as the
    characters are those of the first plane.
    """
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        runs = [run for run, _ in Split(Regex(name + "+"), "removed", invert=True).pre_tokenize_str(PLANE)]
        pattern = pattern.replace(name, "".join(re.escape(r[0]) + "-" + re.escape(r[-1]) for r in runs))
    return pattern


def load(path: str) -> WordTokenizer:
    loaded = kept("bpe").setdefault("tokenizers", {})
    if path not in loaded:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        loaded[path] = WordTokenizer(path)
    return loaded[path]


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """``word, n`` over all documents; each task sends a word once for each batch of text."""
    def run(batches):
        tokenizer, counts = load(path), Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                names=["word", "n"])
            counts.clear()
            return batch

        for batch in steps(batches):
            for text in batch.column("text").to_pylist():
                if text:
                    counts.update(tokenizer.words(text))
                if len(counts) > 400_000:
                    yield flush()
        yield flush()

    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def word_table(docs: DataFrame, path: str, table_words: int = TABLE_WORDS) -> DataFrame:
    """``word, ids, decoded`` of the most frequent words, ``table_words`` rows at most.

    All words that occur as often are in or out together, and so are those above
    ``COUNT_BINS`` whose counts have one power of two.
    """
    spark = docs.sparkSession
    level = F.when(F.col("n") < COUNT_BINS, F.col("n")).otherwise(COUNT_BINS + F.floor(F.log2("n")))
    counts = staged(word_counts(docs, path).where("n > 1").withColumn("level", level))
    bins = counts.groupBy("level").count().collect()
    least, held = COUNT_BINS + 64, 0
    for n, rows in sorted(((r["level"], r["count"]) for r in bins), reverse=True):
        held += rows
        if held > table_words:
            break
        least = n

    def encode(batches):
        tokenizer = load(path)
        for batch in batches:
            words = batch.column("word").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(tokenizer.encode_words(words), pa.list_(pa.int32()))],
                names=["word", "ids"])

    encoded = (counts.where(F.col("level") >= least).select("word").repartition("word")
               .mapInArrow(encode, "word string, ids array<int>"))
    pieces = spark.createDataFrame(sorted(load(path).pieces.items()), "id int, piece string")
    decoded = (encoded.select("word", "ids", F.posexplode("ids").alias("at", "id"))
               .join(F.broadcast(pieces), "id")  # as many rows as the vocabulary
               .groupBy("word").agg(F.first("ids").alias("ids"),
                                    F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("p")))
    return decoded.select("word", "ids", F.concat_ws(" ", F.col("p.piece")).alias("decoded"))


def _encoder(docs: DataFrame, path: str, table_words: int):
    """A function for tasks: texts to lists of (ids as bytes, decoded text)."""
    table = word_table(docs, path, table_words).toArrow()
    ids = [np.array(i, "<u4").tobytes() for i in table.column("ids").to_pylist()]
    mark = uuid.uuid4().hex
    sent = docs.sparkSession.sparkContext.broadcast(pickle.dumps(
        (table.column("word").to_pylist(), ids, table.column("decoded").to_pylist())))

    def encode(texts):
        tokenizer, held = load(path), kept("bpe")
        if held.get("of") != mark:
            held.pop("known", None)  # an older one goes before the next is made
            words, ids, decoded = pickle.loads(sent.value)
            known = dict(zip(words, zip(ids, decoded)))
            known.update((s, (struct.pack("<I", i), s)) for s, i in tokenizer.special.items())
            held.update(of=mark, known=known, tail=[])
        known, tail, out = held["known"], held["tail"], []
        for text in texts:
            words = tokenizer.words(text)
            found = list(map(known.get, words))
            if None in found:
                rare = list({w for w, f in zip(words, found) if f is None})
                for word, ids in zip(rare, tokenizer.encode_words(rare)):
                    known[word] = struct.pack(f"<{len(ids)}I", *ids), " ".join([tokenizer.pieces[i] for i in ids])
                found = list(map(known.get, words))
                tail += rare
                if len(tail) > MAX_TAIL:
                    for word in tail:
                        del known[word]
                    tail.clear()
            out.append((b"".join([f[0] for f in found]), " ".join([f[1] for f in found])))
        return out

    return encode


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 table_words: int = TABLE_WORDS) -> DataFrame:
    """``doc_id, ids, decoded`` for every row: token ids and their decoded text.

    A null or empty text has no ids and decodes to nothing. Repeated rows give a row each, a
    null id stays null, empty input gives no rows, other columns are not looked at.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    encode = _encoder(rows, path, table_words)

    def work(texts):
        return [(np.frombuffer(ids, "<u4").astype(np.int32), decoded) for ids, decoded in encode(texts)]

    return map_texts(rows, work, ["doc_id"], "doc_id bigint, ids array<int>, decoded string")


def encode_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   table_words: int = TABLE_WORDS) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: digests of what ``encode_texts`` gives."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    encode = _encoder(rows, path, table_words)

    def work(texts):
        return [(len(ids) // 4, sha256(ids), sha256(decoded.encode())) for ids, decoded in encode(texts)]

    return map_texts(rows, work, ["doc_id"],
                     "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded`` of lists of ids through a join with the table of pieces.

    The work is spread by row and place, so one very long list is not one task's.
    """
    spark = encoded.sparkSession
    pieces = spark.createDataFrame(sorted(load(path).pieces.items()), "id int, piece string")
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"),
                          F.monotonically_increasing_id().alias("row"))
    placed = (rows.select("doc_id", "row", F.posexplode_outer("ids").alias("at", "id"))
              .join(F.broadcast(pieces), "id", "left"))
    parts = placed.groupBy("row").agg(F.first("doc_id").alias("doc_id"),
                                      F.sort_array(F.collect_list(F.struct("at", "piece"))).alias("p"))
    return parts.select("doc_id", F.concat_ws(" ", F.col("p.piece")).alias("decoded"))
