"""Spelling variants: words that differ by one letter, from a dictionary of trie node pairs.

The words are put in order, and the nodes of their trie are numbered: a prefix has one
number in all words that begin with it. The same is done for the words read backwards.
A place of a word is then a pair of integers, the node of what is before it and the
node of what follows. Leaving out a letter gives the pair around this letter, and the gap
between two letters gives a pair too:

* words of one pair around a letter differ in this letter only;
* a word whose pair around a letter is another's gap has this letter more than the other.

So near words meet in a group of equal pairs, exactly and without being compared. A group
holds at most one word for each letter of the alphabet and one more for the gap. Of a run of
equal letters only the last is left out for the second rule, so that no two words meet
twice.

Order is cut into parts of a bounded number of words. A prefix on both sides of a cut
belongs to the first cut it crosses; only the two words at each cut come to the driver.
"""

from __future__ import annotations

import os.path
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged, steps

PART_WORDS = 50_000  # words of a part of the order, about
HELD = 400_000  # distinct words counted in a task before they are handed on

#: Latin-1 bytes: A-Z become a-z, other letters stay, the rest become blanks.
_RUN_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str) -> list[bytes]:
    """Runs of A-Z, a-z and U+00C0 to U+00FF in Latin-1, A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_RUN_BYTES).split()


def count_words(docs: DataFrame, min_length: int = 5, min_count: int = 3, slip_every: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: words of at least ``min_length`` letters found ``min_count`` times or more.

    With ``slip_every``, one in so many pairs of document and word loses a letter first: where
    the crc32 of ``<doc_id>:<word>`` is a multiple, the letter at its remainder by the length
    is left out of all occurrences in the document. A null id counts as an empty one.
    """
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        held: Counter = Counter()

        def handed_on():
            words = [w.decode("latin-1") for w in held]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in steps(batches):
            for name, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                found = Counter(runs_of(text or ""))
                if slip_every is None:
                    held.update({w: n for w, n in found.items() if len(w) >= min_length})
                else:
                    start = zlib.crc32(f"{name}:".encode())
                    for w, n in found.items():
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), start)
                        if h % slip_every == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                        if len(w) >= min_length:
                            held[w] += n
                if len(held) > HELD:
                    yield handed_on()
                    held.clear()
        yield handed_on()

    counted = texts.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= min_count)


def _common(a: str, b: str) -> int:
    return len(os.path.commonprefix((a, b)))


def _cuts(ends: list[tuple[int, str, str]]) -> dict[int, tuple[list[int], str, list[int]]]:
    """For every part: nodes of its first word's prefixes that began before it, the first word
    of the next part, and nodes of that word's prefixes that occur in this part."""
    carried, out = {}, {}
    for (before, first, last), (part, start, _) in zip(ends, ends[1:]):
        own, nodes = carried.get(before, []), []
        for depth in range(_common(last, start) + 1):
            kept = depth < len(own) and first[:depth] == start[:depth]
            nodes.append(own[depth] if kept else -(part << 32 | depth))
        carried[part] = nodes
    for i, (part, _, _) in enumerate(ends):
        after, start = (ends[i + 1][0], ends[i + 1][1]) if i + 1 < len(ends) else (None, "")
        out[part] = (carried.get(part, []), start, carried.get(after, []))
    return out


def number_trie(words: DataFrame, col: str) -> DataFrame:
    """``col, number, nodes``: place of each distinct word in order and the trie node of each of
    its prefixes, the empty one and the word itself included."""
    parts = max(1, -(-words.count() // PART_WORDS))
    ordered = staged(words.select(col).repartitionByRange(parts, col).withColumn("part", F.spark_partition_id()))
    ends = ordered.groupBy("part").agg(F.min(col).alias("first"), F.max(col).alias("last")).orderBy("part").collect()
    cuts = _cuts([tuple(r) for r in ends])

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        stack, start, shared = cuts[part]
        spelled = sorted(table.column(col).to_pylist())
        stack, before, same, fresh, rows = list(stack), "", len(stack) - 1, part << 32, []
        for i, word in enumerate(spelled):
            if i:
                same = _common(before, word)
            del stack[same + 1:]
            crossing = min(_common(word, start), len(shared) - 1)
            for depth in range(same + 1, len(word) + 1):
                fresh += 1
                stack.append(shared[depth] if depth <= crossing else fresh)
            before = word
            rows.append(list(stack))
        numbers = range(part << 32, (part << 32) + len(spelled))
        return pa.table({col: pa.array(spelled, pa.string()), "number": pa.array(numbers, pa.int64()),
                         "nodes": pa.array(rows, pa.list_(pa.int64()))})

    return ordered.groupBy("part").applyInArrow(run, f"`{col}` string, number bigint, nodes array<bigint>")


def near_words(words: DataFrame) -> DataFrame:
    """``word, n, number, n_near, best_n, best``: how many words are near, the count and number of
    the most frequent (the first in order among equals), for every row of ``word, n``."""
    forward = staged(number_trie(words, "word"))
    backward = number_trie(words.select(F.reverse("word").alias("drow")), "drow")
    backward = backward.select(F.reverse("drow").alias("word"), F.col("nodes").alias("after"))
    both = staged(words.join(forward, "word").join(backward, "word"))

    size = F.char_length("word")
    letter = lambda i: F.substring("word", i + 1, 1)
    around = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.struct(
        F.get("nodes", i).alias("p"), F.get("after", size - i - 1).alias("s"),
        F.when((i == size - 1) | (letter(i) != letter(i + 1)), 2).otherwise(1).alias("kind")))
    gaps = F.transform(F.sequence(F.lit(0), size), lambda i: F.struct(
        F.get("nodes", i).alias("p"), F.get("after", size - i).alias("s"), F.lit(0).alias("kind")))
    places = both.select("n", "number", F.explode(F.concat(around, gaps)).alias("at")).select("at.*", "n", "number")

    # Members in order of descending n, then number; kind is 0 for the gap, 2 for the last of a run.
    met = places.groupBy("p", "s").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("n")).alias("minus"), "number", "kind"))).alias("m")).where(F.size("m") > 1)
    kinds = lambda least: F.filter("m", lambda x: x["kind"] >= least)
    met = met.select("m", F.get(F.filter("m", lambda x: x["kind"] == 0), F.lit(0)).alias("gap"),
                     kinds(1).alias("alike"), kinds(2).alias("more"))

    def seen(x):
        plain = lambda y: F.when(y.isNotNull(), F.struct(y["minus"], y["number"]))
        longer, ends_run = x["kind"] > 0, x["kind"] == 2
        other = F.get("alike", F.when(F.get("alike", F.lit(0))["number"] == x["number"], 1).otherwise(0))
        n = F.when(longer, F.size("alike") - 1 + F.when(ends_run & F.col("gap").isNotNull(), 1).otherwise(0)).otherwise(
            F.size("more"))
        best = F.when(longer, F.least(plain(other), F.when(ends_run, plain(F.col("gap"))))).otherwise(
            plain(F.get("more", F.lit(0))))
        return F.struct(x["number"].alias("number"), n.alias("n"), best.alias("best"))

    met = met.select(F.explode(F.transform("m", seen)).alias("x")).where("x.n > 0")
    found = met.groupBy("x.number").agg(F.sum("x.n").cast("bigint").alias("n_near"), F.min("x.best").alias("best"))
    return both.select("word", "n", "number").join(found, "number", "left").select(
        "word", "n", "number", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        (-F.col("best.minus")).alias("best_n"), F.col("best.number").alias("best"))


def spelling_variants(docs: DataFrame, min_length: int = 5, min_count: int = 3, ratio: int = 2,
                      slip_every: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of ``docs`` (see ``count_words``).

    ``form`` is the near word of largest n, the first in code-point order among equals, if it
    has at least ``ratio`` times the n of the word, else null; ``form_n`` is its n. ``root`` is
    where following forms ends, the word itself if it has none. Null and empty texts have no
    words; repeated rows count again; an empty table gives no rows. Words may be of any
    length. Other columns are not looked at.
    """
    words = staged(count_words(docs, min_length, min_count, slip_every, id_col, text_col))
    near = staged(near_words(words).withColumn("form", F.expr(f"if(best_n >= {int(ratio)} * n, best, null)")))

    # Every round doubles the steps followed. Counts double at each step, so rounds are few.
    forms = near.where("form is not null").select("number", F.col("form").alias("root"))
    while True:
        further = forms.select(F.col("number").alias("root"), F.col("root").alias("next"))
        forms = staged(forms.join(further, "root", "left").select(
            "number", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if forms.where("moved").isEmpty():
            break
        forms = forms.drop("moved")

    spelled = near.select("number", "word")
    as_form = spelled.select(F.col("number").alias("form"), F.col("word").alias("form_word"))
    as_root = spelled.select(F.col("number").alias("root"), F.col("word").alias("root_word"))
    named = near.join(forms.select("number", "root"), "number", "left").join(as_form, "form", "left").join(
        as_root, "root", "left")
    return named.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                        "n_near", F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"))
