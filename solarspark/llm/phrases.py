"""Phrases that are more frequent than their parts suggest, level by level.

Texts become arrays of word hashes once, with a break wherever a piece ends or a word is too
rare for any phrase. A seed under which two words of a language have one hash is given up
for the next, so a hash stands for its word. Then for each length from two words on:

1. positions where both shorter phrases, the one from here and the one from the next word,
   may be frequent are counted by the hash of the phrase, in one bin of each of two rows of
   bins. Their number follows that of the words, so that bins do not fill up; where a row
   would be too long, phrases are taken in lots by their hash;
2. phrases at such positions whose two bins reach the least count are the candidates. Both
   steps keep every frequent phrase: a part is as frequent as the whole, and a bin as the
   phrases in it;
3. candidates are dealt by their first word into tries of a bounded number of phrases. Each is
   built as a double array in one task and sent to all others, where numpy moves the states of
   those positions of a text on together that begin with such a word, byte by byte of the
   numbers of their words, and counts the accepting states. The counts of all tasks are summed.

So each position is walked about once for each length, however many tries there are. Frequent
phrases are looked up in bit tables, which let others pass but lose none.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bit_table, free, shuffles_go, staged, steps

BITS = 27  # bit tables have 2**27 places at most, eight for each phrase below that
BIN_BITS = 26  # a row of bins has 2**26 bytes at most
LOAD = 6  # bins count a sixth of the least count on average, at most
BLOB = 1 << 18  # bins summed together
MARKS = 1_000_000  # phrases put into bins at once, about
SEEN = 8_000_000  # phrases a task remembers to have proposed
TRIE_PHRASES = 300_000  # phrases of one trie, about
ROW_WORDS = 60_000  # words of one staged row, more only where a piece has more
HELD = 400_000  # distinct words counted in a task before they are handed on
FEW_PARTS = 300_000  # so many parts of phrases at most are sent to all tasks
ROWS_AT_ONCE = 16  # staged rows a task is handed together
TASKS_PER_CORE = 2  # tasks that go through the encoded texts
RANKED = 1_000_000  # phrases ranked in one task
NO_LANGUAGE = "und"

#: A-Z become a-z, a tab a blank, and . , ; : ! ? and U+000A to U+000D a line end.
_BYTES = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens_of(texts: list[str]) -> list[bytes]:
    """Words of all texts; pieces and texts are parted by a line end, and some tokens are empty."""
    joined = "\n".join(texts).encode("utf-8", "surrogatepass").translate(_BYTES)
    return joined.replace(b"\n", b" \n ").split(b" ")


class _Words(dict):
    """Hash of a word; a line end has 0 and an empty token 1."""

    def __init__(self, seed: int):
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        value = 0 if word == b"\n" else 1 if word == b"" else max(2, xxhash.xxh3_64_intdigest(word, self.seed))
        self[word] = value
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _marks(words: np.ndarray, lang: str, most: int) -> Iterator[np.ndarray]:
    """Hash of the phrase of 1, 2, ... words from each place on; those across breaks mean nothing."""
    mark = _mixed(words ^ np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))))
    yield mark
    for k in range(1, most):
        mark = _mixed(mark[:-1] * _MIX + words[k:])
        yield mark


def _by_language(batch: pa.RecordBatch) -> dict[str, list[str]]:
    texts: dict[str, list[str]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        texts.setdefault(lang, []).append(text or "")
    return texts


def _table(df: DataFrame):
    """Broadcast bit table of the marks of the staged ``df``."""
    return bit_table(df, "mark", min(BITS, max(10, (8 * df.count()).bit_length())))


def _bits(table) -> np.ndarray:
    return np.frombuffer(table.value, np.uint8)


def _in(places: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the bits at ``places`` are set."""
    return (bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & np.uint8(1)).view(bool)


def _held(marks: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Whether the first bits of ``marks`` are in a bit table."""
    return _in(marks >> np.uint64(65 - (8 * len(bits)).bit_length()), bits)


# --- words

def _count_words(texts: DataFrame, seed: int) -> DataFrame:
    """``lang, words, mark, text, clash, n``: hash bytes of a word, its mark and spelling, for every word."""
    def run(batches):
        held: dict[str, Counter] = {}

        def handed_on():
            for lang, counts in held.items():
                words = _Words(seed)
                names = list(counts)
                hashes = np.fromiter((words[w] for w in names), np.uint64, len(names))
                mark = next(_marks(hashes, lang, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), pa.array([h.tobytes() for h in hashes.astype("<u8")], pa.binary()),
                     pa.array(mark.view(np.int64)), pa.array(names, pa.binary()).cast(pa.string()),
                     pa.array(list(counts.values()), pa.int64())], names=["lang", "words", "mark", "text", "n"])
            held.clear()

        for batch in steps(batches):
            for lang, found in _by_language(batch).items():
                counts = held.setdefault(lang, Counter())
                counts.update(tokens_of(found))
                counts.pop(b"", None)
                counts.pop(b"\n", None)
            if sum(map(len, held.values())) > HELD:
                yield from handed_on()
        yield from handed_on()

    rows = texts.mapInArrow(run, "lang string, words binary, mark bigint, text string, n bigint")
    return _merged(rows)


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "words").agg(
        F.first("mark").alias("mark"), F.min("text").alias("text"), (F.min("text") != F.max("text")).alias("clash"),
        F.sum("n").alias("n"))


def _encoded(texts: DataFrame, frequent, seed: int) -> DataFrame:
    """``lang, words, places``: distinct word hashes of a stretch of text and, for each place, which
    of them stands there (counted from 1) or a break (0)."""
    def run(batches):
        words, table = _Words(seed), _bits(frequent)
        for batch in steps(batches):
            langs, names, places = [], [], []
            for lang, found in _by_language(batch).items():
                tokens = tokens_of(found)
                codes = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
                codes = codes[codes != 1]
                codes[~_held(next(_marks(codes, lang, 1)), table)] = 0
                # Only words next to another one can be in a phrase, and one break between them is enough.
                full = np.r_[False, codes != 0, False]
                codes = codes[(full[1:-1] & (full[:-2] | full[2:])) | (~full[1:-1] & full[:-2])]
                breaks = np.flatnonzero(codes == 0)
                start = 0
                while start < len(codes):
                    at = np.searchsorted(breaks, start + ROW_WORDS)
                    stop = int(breaks[at]) + 1 if at < len(breaks) else len(codes)
                    unique, inverse = np.unique(codes[start:stop], return_inverse=True)
                    if unique[0] == 0:
                        unique = unique[1:]
                    else:
                        inverse = inverse + 1
                    if len(unique):
                        langs.append(lang)
                        names.append(unique.astype("<u8").tobytes())
                        places.append(inverse.astype("<u4").tobytes())
                    start = stop
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(names, pa.binary()), pa.array(places, pa.binary())],
                names=["lang", "words", "places"])

    return texts.mapInArrow(run, "lang string, words binary, places binary")


def _stretches(batches) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield (batch.column("lang")[i].as_py(), np.frombuffer(batch.column("words")[i].as_buffer(), "<u8"),
                   np.frombuffer(batch.column("places")[i].as_buffer(), "<u4").astype(np.int64))


# --- candidates

@contextmanager
def _few_rows_at_once(spark: SparkSession) -> Iterator[None]:
    """Rows computed inside go to Python, and come from files, ``ROWS_AT_ONCE`` at a time.

    A row of encoded text holds up to ``ROW_WORDS`` words, so the session's thousands of them
    would be all that a task reads.
    """
    with ExitStack() as undo:
        for name in ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize"):
            before = spark.conf.get(name)
            undo.callback(spark.conf.set, name, before)
            spark.conf.set(name, ROWS_AT_ONCE)
        yield


def _in_few_tasks(coded: DataFrame) -> DataFrame:
    """The same rows in ``TASKS_PER_CORE`` tasks for each core at most.

    A task that counts or proposes hands on all bins and each phrase it meets, and frequent
    ones are met everywhere. They then grow with their number, not with that times the
    number of files. A task keeps tables of bounded sizes however much it reads.
    """
    return coded.coalesce(TASKS_PER_CORE * coded.sparkSession.sparkContext.defaultParallelism)


def _hopeful(lang: str, words: np.ndarray, places: np.ndarray, k: int, shorter: np.ndarray) -> tuple:
    """Places of phrases of k words whose both parts of k - 1 words are in the table, their hashes, all words."""
    flat = np.r_[np.uint64(0), words][places]
    if len(flat) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), flat
    *_, before, mark = _marks(flat, lang, k)
    full = places != 0
    whole = full[:len(mark)].copy()
    for j in range(1, k):
        whole &= full[j:j + len(mark)]
    at = np.flatnonzero(whole)
    if k > 2:  # words are in the table anyway
        kept = _held(before, shorter)
        at = at[kept[at] & kept[at + 1]]
    return at, mark[at], flat


def _lots(words: int, min_count: int) -> tuple[int, int]:
    """Lots of phrases, and bits of the place of a bin, for a text of so many words."""
    places = max(1, words // max(1, min_count // LOAD))
    bits = min(BIN_BITS if min_count < 256 else BIN_BITS - 2, max(10, places.bit_length()))
    return -(-places >> bits), bits


def _of_lot(marks: np.ndarray, lot: int, lots: int) -> np.ndarray:
    return (marks & np.uint64(4095)) % np.uint64(lots) == lot


def _bins_of(marks: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of phrases in both rows of bins: the first ``bits`` bits of their marks, and the next."""
    return marks >> np.uint64(64 - bits), marks << np.uint64(bits) >> np.uint64(64 - bits)


def _add_to(bins: np.ndarray, places: np.ndarray, most: int) -> None:
    """Count ``places`` in ``bins``, up to ``most``."""
    places = np.sort(places.astype(np.uint32))
    first = np.flatnonzero(np.r_[True, places[1:] != places[:-1]][:len(places)])
    at = places[first]
    bins[at] = np.minimum(bins[at] + np.diff(np.r_[first, len(places)]), most)


class _Seen:
    """Numbers that were met: sorted arrays, each at least twice as long as the next."""

    def __init__(self):
        self.parts: list[np.ndarray] = []

    def new(self, marks: np.ndarray) -> np.ndarray:
        """Which of these sorted, distinct numbers are met for the first time, or the first after very many."""
        fresh = np.ones(len(marks), bool)
        for part in self.parts:
            at = np.searchsorted(part, marks)
            fresh &= part[np.minimum(at, len(part) - 1)] != marks
        if sum(map(len, self.parts)) > SEEN:
            self.parts = []
        last = marks[fresh]
        while len(last) and self.parts and len(self.parts[-1]) < 2 * len(last):
            last = np.sort(np.concatenate([self.parts.pop(), last]))
        self.parts += [last] if len(last) else []
        return fresh


def _often(coded: DataFrame, k: int, shorter, min_count: int, lot: int, lots: int, bits: int):
    """Broadcast bits of the bins that phrases of k words reach ``min_count`` times, both rows one after the other."""
    kind, blob = np.uint8 if min_count < 256 else np.uint32, min(BLOB, 1 << bits)

    def count(batches):
        known, bins = _bits(shorter), np.zeros((2, 1 << bits), kind)
        waiting, held = [], 0

        def add():
            for row, places in zip(bins, _bins_of(np.concatenate(waiting), bits)):
                _add_to(row, places, min_count)
            waiting.clear()

        for lang, words, places in _stretches(batches):
            marks = _hopeful(lang, words, places, k, known)[1]
            waiting.append(marks[_of_lot(marks, lot, lots)] if lots > 1 else marks)
            held += len(waiting[-1])
            if held > MARKS:
                add()
                held = 0
        if waiting:
            add()
        for i, part in enumerate(bins.reshape(-1, blob)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part.tobytes()])], names=["part", "n"])

    def reached(table: pa.Table) -> pa.Table:
        total = np.zeros(blob, np.int64)
        for part in table.column("n"):
            total += np.frombuffer(part.as_buffer(), kind)
        often = np.packbits(total >= min_count, bitorder="little").tobytes()
        return pa.table({"part": table.column("part")[:1], "bits": pa.array([often])})

    with _few_rows_at_once(coded.sparkSession), shuffles_go(coded.sparkSession):
        found = coded.mapInArrow(count, "part int, n binary").groupBy("part").applyInArrow(
            reached, "part int, bits binary").toArrow()
    out = np.zeros((2 << bits) // blob * blob // 8, np.uint8).reshape(-1, blob // 8)
    for part, often in zip(found.column("part").to_pylist(), found.column("bits").to_pylist()):
        out[part] = np.frombuffer(often, np.uint8)
    return coded.sparkSession.sparkContext.broadcast(out.tobytes())


def _words_in(coded: DataFrame) -> int:
    return (coded.agg(F.sum(F.length("places"))).first()[0] or 0) // 4


def _candidates(coded: DataFrame, k: int, shorter, min_count: int, words: int | None = None) -> DataFrame:
    """``lang, words, mark``: distinct phrases of k words that may be frequent, in a text of so many words."""
    lots, bits = _lots(_words_in(coded) if words is None else words, min_count)

    def propose(batches, lot, often):
        known, seen = _bits(shorter), _Seen()
        chosen = _bits(often).reshape(2, -1)
        for batch in batches:
            langs, found, marks = [], [], []
            for lang, words, places in _stretches([batch]):
                at, mark, flat = _hopeful(lang, words, places, k, known)
                on = _of_lot(mark, lot, lots) if lots > 1 else np.ones(len(mark), bool)
                for row, places in zip(chosen, _bins_of(mark, bits)):
                    on[on] = _in(places[on], row)
                mark, first = np.unique(mark[on], return_index=True)
                langs.append(lang)
                marks.append(mark)
                found.append((flat, at[on][first]))
            if not marks:
                continue
            mark, first = np.unique(np.concatenate(marks), return_index=True)
            first = np.sort(first[seen.new(mark)])
            ends = np.cumsum([len(m) for m in marks])
            for lang, mark, (flat, at), end in zip(langs, marks, found, ends):
                own = first[slice(*np.searchsorted(first, [end - len(mark), end]))] - (end - len(mark))
                if len(own):
                    phrases = flat[at[own][:, None] + np.arange(k)].astype("<u8")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(own), pa.string()), pa.array([p.tobytes() for p in phrases], pa.binary()),
                         pa.array(mark[own].view(np.int64))], names=["lang", "words", "mark"])

    out = []
    for lot in range(lots):
        often = _often(coded, k, shorter, min_count, lot, lots, bits)
        found = coded.mapInArrow(partial(propose, lot=lot, often=often), "lang string, words binary, mark bigint")
        with _few_rows_at_once(coded.sparkSession):
            out.append(staged(found.groupBy("lang", "words").agg(F.first("mark").alias("mark"))))
        often.destroy()
    return reduce(DataFrame.unionByName, out)


# --- tries

def double_array(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base, check`` of the trie of distinct byte rows of one length, and the state that accepts each.

    The root is state 0. From state s a byte c leads to state base[s] + c if check of that is
    s. States with most children are placed first, into the first gaps that take them.
    """
    n, depth = rows.shape
    order = np.lexsort(rows.T[::-1])
    lines = rows[order]
    size = 4 * 256 + 2 * n * depth
    base, check = np.zeros(size, np.int64), np.full(size, -1, np.int64)
    check[0] = 0
    top = 1  # all places from here on are free
    state = np.zeros(n, np.int64)  # of each line's prefix
    new = np.zeros(n, bool)
    new[:1] = True
    for d in range(depth):
        starts = np.flatnonzero(new)  # first lines of the parents
        new = new.copy()
        new[1:] |= lines[1:, d] != lines[:-1, d]
        child = np.flatnonzero(new)  # first lines of the children
        bounds = np.searchsorted(child, np.r_[starts, n])
        degree = np.diff(bounds)
        if top + 256 * 2 + 2 * len(child) > size:
            grown = 2 * size + 2 * len(child)
            base, check = np.r_[base, np.zeros(grown - size, np.int64)], np.r_[check, np.full(grown - size, -1, np.int64)]
            size = grown
        spot = np.zeros(len(child), np.int64)
        low = 1
        for p in np.argsort(-degree, kind="stable")[:int((degree > 1).sum())].tolist():
            symbols = lines[child[bounds[p]:bounds[p + 1]], d].astype(np.int64)
            while check[low] >= 0:
                low += 1
            # The first child goes to a free place from which all others are free as well.
            free = low + np.flatnonzero(check[low:min(low + 2048, top)] < 0)
            free = free[free >= symbols[0]]
            fits = (check[free[:, None] + (symbols - symbols[0])] < 0).all(axis=1)
            at = int(free[fits.argmax()]) if fits.any() else max(top, int(symbols[0]))
            places = at - symbols[0] + symbols
            parent = state[starts[p]]
            base[parent] = at - symbols[0]
            check[places] = parent
            spot[bounds[p]:bounds[p + 1]] = places
            top = max(top, int(places[-1]) + 1)
            if top + 600 > size:
                base, check = np.r_[base, np.zeros(size, np.int64)], np.r_[check, np.full(size, -1, np.int64)]
                size *= 2
        # Single children take what is free, whatever their byte.
        single = np.flatnonzero(degree == 1)
        free = 256 + np.flatnonzero(check[256:top] < 0)
        end = max(top, 256)
        if len(free) < len(single):
            need = len(single) - len(free)
            free = np.r_[free, np.arange(end, end + need)]
            if end + need + 600 > size:
                extra = end + need + 600 - size
                base, check = np.r_[base, np.zeros(extra, np.int64)], np.r_[check, np.full(extra, -1, np.int64)]
                size += extra
        places, parents = free[:len(single)], state[starts[single]]
        base[parents] = places - lines[starts[single], d]
        check[places] = parents
        spot[bounds[:-1][single]] = places
        if len(places):
            top = max(top, int(places[-1]) + 1)
        state = spot[np.cumsum(new) - 1]
    out = np.zeros(n, np.int64)
    out[order] = state
    top += 256
    return base[:top].astype(np.int32), check[:top].astype(np.int32), out


def _digits(numbers: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` lowest bytes of each number, highest first."""
    return np.stack([(numbers >> (8 * i)) & 255 for i in reversed(range(width))], axis=-1).astype(np.uint8)


def _tries(candidates: DataFrame, k: int, parts: int) -> DataFrame:
    """``shard, lang, words, mark, state`` and in one row of each shard the arrays of its trie."""
    def build(table: pa.Table) -> pa.Table:
        langs = table.column("lang").to_pylist()
        phrases = np.frombuffer(b"".join(table.column("words").to_pylist()), "<u8").reshape(-1, k)
        names = sorted(set(langs))
        number = {lang: i for i, lang in enumerate(names)}
        symbols, inverse = np.unique(phrases, return_inverse=True)
        width = 1 if max(len(symbols), len(names)) <= 1 << 8 else 2 if max(len(symbols), len(names)) <= 1 << 16 else 3
        first = np.fromiter((number[x] for x in langs), np.int64, len(langs))
        lines = _digits(np.c_[first, inverse.reshape(-1, k)], width).reshape(len(langs), -1)
        base, check, state = double_array(lines)
        blobs = [base.tobytes(), check.tobytes(), symbols.astype("<u8").tobytes()]
        rest = [None] * (len(langs) - 1)
        return pa.table({
            "shard": table.column("shard"), "lang": table.column("lang"), "words": table.column("words"),
            "mark": table.column("mark"), "state": pa.array(state.astype(np.int32)),
            **{c: pa.array([b, *rest], pa.binary()) for c, b in zip(("base", "check", "symbols"), blobs)},
            "names": pa.array([names, *rest], pa.list_(pa.string()))})

    candidates = candidates.withColumn("first", F.expr("substring(words, 1, 8)"))
    # A word that begins very many phrases has them in several tries.
    common = candidates.groupBy("lang", "first").count().where(F.col("count") > TRIE_PHRASES // 8).select(
        "lang", "first", F.lit(True).alias("common"))
    dealt = candidates.join(F.broadcast(staged(common)), ["lang", "first"], "left")
    key = F.when(F.col("common"), F.xxhash64("lang", "words")).otherwise(F.xxhash64("lang", "first"))
    return dealt.select(F.pmod(key, F.lit(parts)).cast("int").alias("shard"), "lang", "words", "mark").groupBy(
        "shard").applyInArrow(build, "shard int, lang string, words binary, mark bigint, state int, base binary,"
                                     " check binary, symbols binary, names array<string>")


def _advance(base, check, state: np.ndarray, at: np.ndarray, digits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States after one more word (a row of bytes each), for those positions that go on."""
    for i in range(digits.shape[1]):
        following = base[state] + digits[:, i]
        on = check[following] == state
        state, at, digits = following[on], at[on], digits[on]
    return state, at


def _count_by_trie(coded: DataFrame, trie, k: int, min_count: int) -> DataFrame:
    """``state, n``: accepting states of a broadcast trie that are reached ``min_count`` times or more."""
    sent = coded.sparkSession.sparkContext.broadcast(
        (trie["base"], trie["check"], trie["symbols"], list(trie["names"])))

    def run(batches):
        base, check, symbols = (np.frombuffer(b, t) for b, t in zip(sent.value[:3], ("<i4", "<i4", "<u8")))
        names, total, waiting, held = sent.value[3], np.zeros(len(base), np.int64), [], 0
        width = 1 if max(len(symbols), len(names)) <= 1 << 8 else 2 if max(len(symbols), len(names)) <= 1 << 16 else 3
        roots = {}
        for i, lang in enumerate(names):
            reached, _ = _advance(base, check, np.zeros(1, np.int32), np.zeros(1, np.int64), _digits(np.array([i]), width))
            roots[lang] = int(reached[0])
        for lang, words, places in _stretches(batches):
            if lang not in roots:
                continue
            number = np.searchsorted(symbols, words)
            known = symbols[np.minimum(number, len(symbols) - 1)] == words
            digits = np.r_[np.zeros((1, width), np.uint8), _digits(number, width)]
            # Only positions whose word begins a phrase of this trie are walked, from its state on.
            at = 1 + np.flatnonzero(known)
            state, at = _advance(base, check, np.full(len(at), roots[lang], np.int32), at, digits[at])
            begun = np.full(len(words) + 1, -1, np.int32)
            begun[at] = state
            known = np.r_[False, known]
            state = begun[places[:max(0, len(places) - k + 1)]]
            at = np.flatnonzero(state >= 0)
            state = state[at]
            for j in range(1, k):
                word = places[at + j]
                on = known[word]
                state, at = _advance(base, check, state[on], at[on], digits[word[on]])
            waiting.append(state)
            held += len(state)
            if held > 1_000_000:
                total += np.bincount(np.concatenate(waiting), minlength=len(base))
                waiting, held = [], 0
        if held:
            total += np.bincount(np.concatenate(waiting), minlength=len(base))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["state", "n"])

    counts = coded.mapInArrow(run, "state int, n bigint").groupBy("state").agg(F.sum("n").alias("n"))
    with _few_rows_at_once(coded.sparkSession):
        counts = staged(counts.where(F.col("n") >= min_count))
    sent.destroy()
    return counts


def frequent_phrases(docs: DataFrame, min_count: int = 100, most: int = 5, lang_col: str = "lang",
                     text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Phrases of up to ``most`` words found ``min_count`` times or more in the texts of a language.

    Three tables: ``lang, words, k, n`` of phrases, as their word hashes of eight bytes each;
    ``lang, words, text`` of single words; ``lang, n`` of all words.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"),
                        F.col(text_col).alias("text"))
    seed = 0
    while True:
        counted = staged(_count_words(texts, seed))
        if counted.where("clash").isEmpty():
            break
        seed += 1
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    single = counted.where(F.col("n") >= min_count)
    shorter = _table(single)
    coded = _in_few_tasks(staged(_encoded(texts, shorter, seed)))
    levels = [single.select("lang", "words", F.lit(1).alias("k"), "n")]
    total = _words_in(coded)
    for k in range(2, most + 1):
        candidates = _candidates(coded, k, shorter, min_count, total)
        count = candidates.count()
        if not count:
            break
        parts = -(-count // TRIE_PHRASES)
        tries = staged(_tries(candidates, k, parts))
        free(candidates)
        found = []
        for shard in range(parts):  # one broadcast trie at a time
            rows = tries.where((F.col("shard") == shard) & F.col("base").isNotNull()).select(
                "base", "check", "symbols", "names").collect()
            if rows:
                found.append(_count_by_trie(coded, rows[0], k, min_count).withColumn("shard", F.lit(shard)))
        counts = reduce(DataFrame.unionByName, found)
        level = staged(tries.select("shard", "lang", "words", "mark", "state").join(counts, ["shard", "state"]).select(
            "lang", "words", "mark", F.lit(k).alias("k"), "n"))
        free(tries, counts)
        levels.append(level.select("lang", "words", "k", "n"))
        shorter = _table(level)
    phrases = levels[0]
    for more in levels[1:]:
        phrases = phrases.unionByName(more)
    return staged(phrases), single.select("lang", "words", "text"), totals


def collocations(docs: DataFrame, min_count: int = 100, most: int = 5, top: int = 2000, lang_col: str = "lang",
                 text_col: str = "text") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    ``a`` counts the phrase, ``l`` and ``r`` its first part and the rest at the cut of lowest
    score, ``n`` all words of the language; ``score`` is floor(1000 a n / (l r)), exact. The
    shortest first part wins among equal cuts. Phrases always found within one longer
    phrase are left out. Order is by score, a, both descending, then phrase in UTF-8 order. A
    null language is ``und``; null and empty texts have no words; repeated rows count again;
    an empty table gives no rows. Other columns are not looked at.
    """
    phrases, words, totals = frequent_phrases(docs, min_count, most, lang_col, text_col)
    longer = phrases.where("k > 2")
    inner = longer.select("lang", "n", F.explode(F.array(
        F.expr("substring(words, 1, 8 * (k - 1))"), F.expr("substring(words, 9)"))).alias("words"))
    inner = inner.groupBy("lang", "words").agg(F.max("n").alias("outer_n"))
    kept = phrases.where("k > 1").join(inner, ["lang", "words"], "left").where("outer_n is null or outer_n < n")

    parts = phrases.where(F.col("k") < most).select("lang", "words", "n")
    if parts.count() <= FEW_PARTS:
        parts = F.broadcast(parts)
    cuts = kept.select("lang", "words", "k", F.col("n").alias("a"), F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = cuts.withColumn("head", F.expr("substring(words, 1, 8 * cut)")).withColumn("tail", F.expr("substring(words, 8 * cut + 1)"))
    cuts = cuts.join(parts.select("lang", F.col("words").alias("head"), F.col("n").alias("l")), ["lang", "head"])
    cuts = cuts.join(parts.select("lang", F.col("words").alias("tail"), F.col("n").alias("r")), ["lang", "tail"])
    cuts = cuts.join(F.broadcast(totals) if totals.count() <= FEW_PARTS else totals, "lang")
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    product, over = F.lit(1000).cast("decimal(4,0)") * (wide("a") * wide("n")), wide("l") * wide("r")
    # Only the exact quotient of the multiple below is formed, so nothing is rounded.
    score = ((product - product % over) / over).cast("bigint")
    cuts = cuts.withColumn("score", score)
    scored = cuts.groupBy("lang", "words").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    scored = staged(scored.select("lang", "words", "a", "best.l", "best.r", "n", "best.score"))

    # Ranks within a share of a language can only be better than within all of it.
    shares = max(1, -(-scored.count() // RANKED))
    share = F.pmod(F.xxhash64("words"), F.lit(shares))
    order = [F.desc("score"), F.desc("a")]
    first = scored.withColumn("share", share).withColumn("at", F.rank().over(
        Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("at") <= top).drop("at")
    first = staged(first)
    named = first.select("lang", "words", F.explode(F.expr("sequence(0, cast(length(words) div 8 as int) - 1)")).alias("i"))
    spelled = words.select("lang", F.col("words").alias("one"), "text")
    named = named.withColumn("one", F.expr("substring(words, 8 * i + 1, 8)")).join(spelled, ["lang", "one"])
    named = named.groupBy("lang", "words").agg(F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("i", "text"))), lambda x: x["text"]), " ").alias("phrase"))
    full = first.join(named, ["lang", "words"])
    for by in (["lang", "share"], ["lang"]):
        full = full.withColumn("rank", F.row_number().over(
            Window.partitionBy(*by).orderBy(*order, F.asc("phrase")))).where(F.col("rank") <= top)
    return full.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
