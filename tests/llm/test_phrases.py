"""Phrase mining against brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from solarspark.llm import phrases

HARD = [None, "", " ", "a", ".", "a b", "A\tb. a  b", "\x1c\x85 x", "\x00\x01 \x00\x01", "é日本 é日本", "word " * 300, "\n\n", "a,b;c:d!e?f"]


def brute(rows, least, top=2000, most=5):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, most + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = {}
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if a >= least}
        inside = set()
        for p, a in often.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    if a >= often[p[i:i + k]]:
                        inside.add(p[i:i + k])
        found = []
        for p, a in often.items():
            if len(p) > 1 and p not in inside:
                score, _, l, r = min((1000 * a * n[lang] // (often[p[:k]] * often[p[k:]]), k, often[p[:k]], often[p[k:]])
                                     for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l, r))
        out[lang] = [(i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top])]
    return {lang: found for lang, found in out.items() if found}


def texts_of(rng, count=400):
    words = ["the", "The", "of", "é", "日本", "new", "york", "city", "hall", "x\x1cy", "\x01", *(f"w{i}" for i in range(40))]
    fixed = ["in the city of new york", "new york city hall", "a b a b a b a b", "to be or not to be", "w1 w2 w3 w4 w5 w6 w7"]
    texts, langs = HARD * 2, []
    for _ in range(count):
        out = []
        for _ in range(rng.randint(1, 12)):
            out.append(rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(words, k=rng.randint(1, 6))))
            out.append(rng.choice([" ", "\t", "  ", ". ", "\n", ",", "!"]))
        texts.append("".join(out))
    return texts, [rng.choice(["en", "fr", None, "und", ""]) for _ in texts]


def found_of(df):
    out = defaultdict(list)
    for r in df.orderBy("lang", "rank").collect():
        out[r["lang"]].append((r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]))
    return dict(out)


@pytest.mark.parametrize("least,top,tries,bits", [(20, 2000, 300_000, 24), (8, 15, 60, 10), (3, 40, 400, 7)])
def test_phrases_are_those_of_a_full_count(spark, documents, monkeypatch, least, top, tries, bits):
    for name, value in (("TRIE_PHRASES", tries), ("BITS", bits), ("ROW_WORDS", 50), ("HELD", 20), ("RANKED", 200), ("FEW_PARTS", bits * 10)):
        monkeypatch.setattr(phrases, name, value)
    texts, langs = texts_of(random.Random(least))
    docs = documents(texts, langs=langs)
    assert found_of(phrases.collocations(docs, least, top=top)) == brute(zip(langs, texts), least, top)


def test_a_hash_of_two_words_is_given_up(spark, documents, monkeypatch):
    true = phrases.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(phrases, "HELD", 20)

    class Clashing(phrases._Words):
        def __missing__(self, word):
            value = super().__missing__(word)
            if self.seed == 0 and word in (b"new", b"york"):
                value = self[word] = 77
            return value

    assert true(b"new", 0) != 77
    with monkeypatch.context() as m:
        m.setattr(phrases, "_Words", Clashing)
        assert phrases._Words(0)[b"new"] == phrases._Words(0)[b"york"] != phrases._Words(1)[b"york"]
        texts = spark.createDataFrame([("en", "new york")], "lang string, text string")
        rows = list(_run_local(phrases, texts, 0))
    assert [r["clash"] for r in rows] == [True]


def _run_local(module, texts, seed):
    """Workers import the module unpatched, so the counting is run here and only grouped by Spark."""
    words = module._Words(seed)
    rows = [("en", np.uint64(words[w]).tobytes(), 0, w.decode(), 1) for w in module.tokens_of(["new york"]) if words[w] > 1]
    table = texts.sparkSession.createDataFrame(rows, "lang string, words binary, mark bigint, text string, n bigint")
    return module._merged(table).collect()


def test_nothing(spark, documents):
    assert phrases.collocations(documents([])).count() == 0
    assert phrases.collocations(documents([None, "", "a b", "..."])).count() == 0
    assert found_of(phrases.collocations(documents(["a b"] * 5), 5)) == {"und": [(1, "a b", 5, 5, 5, 10, 2000)]}


def test_big_products(spark, documents, monkeypatch):
    """Products beyond 64 bits and 53 bits of a fraction are divided exactly."""
    big = 10 ** 12 + 7
    def made(*_):
        df = spark.createDataFrame([("en", b"A" * 8, 1, 3 * big), ("en", b"B" * 8, 1, big + 2), ("en", b"A" * 8 + b"B" * 8, 2, big)],
                                   "lang string, words binary, k int, n bigint")
        words = spark.createDataFrame([("en", b"A" * 8, "a"), ("en", b"B" * 8, "b")], "lang string, words binary, text string")
        return df, words, spark.createDataFrame([("en", 10 ** 15 + 1)], "lang string, n bigint")
    monkeypatch.setattr(phrases, "frequent_phrases", made)
    row = phrases.collocations(documents([])).first()
    assert row["score"] == 1000 * big * (10 ** 15 + 1) // (3 * big * (big + 2)) and row["phrase"] == "a b"


def test_double_array():
    rng = np.random.default_rng(0)
    for n, depth, high in ((1, 1, 256), (300, 2, 256), (5000, 4, 40), (2000, 6, 256), (4000, 3, 3)):
        rows = np.unique(rng.integers(0, high, (n, depth)).astype(np.uint8), axis=0)
        rows = rows[rng.permutation(len(rows))]
        base, check, state = phrases.double_array(rows)
        assert len(set(state.tolist())) == len(rows)

        def walk(lines):
            s, at = phrases._advance(base, check, np.zeros(len(lines), np.int32), np.arange(len(lines)), lines)
            out = np.full(len(lines), -1)
            out[at] = s
            return out

        assert (walk(rows) == state).all()
        other = np.unique(rng.integers(0, 256, (3000, depth)).astype(np.uint8), axis=0)
        inside = {r.tobytes() for r in rows}
        assert [x >= 0 for x in walk(other)] == [r.tobytes() in inside for r in other]
        assert len(base) < 1.5 * len(rows) * depth + 2000


def test_many_files_are_read_in_few_tasks(spark):
    most = phrases.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    coded = spark.range(0, 100, 1, 5 * most).select(F.spark_partition_id().alias("p"))
    few = phrases._in_few_tasks(coded).select(F.spark_partition_id().alias("p"))
    assert few.distinct().count() == most and few.count() == 100


def test_a_task_gets_few_encoded_rows_at_once(spark, monkeypatch):
    shorter = phrases.bit_table(spark.range(1).selectExpr("0L mark"), "mark", phrases.BITS)
    coded = spark.createDataFrame([("en", b"\x07" * 8 + b"\x09" * 8, b"\x01\0\0\0\x02\0\0\0")] * 400,
                                  "lang string, words binary, places binary").coalesce(1)
    real = phrases._stretches

    def counted(batches):
        def watched():
            for batch in batches:
                assert batch.num_rows <= phrases.ROWS_AT_ONCE
                yield batch
        return real(watched())

    monkeypatch.setattr(phrases, "_stretches", counted)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = phrases._candidates(phrases._in_few_tasks(coded), 2, shorter, 100).collect()
    assert len(found) == 1 and found[0].words == b"\x07" * 8 + b"\x09" * 8
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_bins_and_tries_keep_up_with_the_words(spark, documents, monkeypatch):
    """In lots, with full bins kept from filling up, and by first words: still a full count, and few candidates."""
    for name, value in (("BIN_BITS", 11), ("TRIE_PHRASES", 100), ("ROW_WORDS", 50), ("BLOB", 512), ("MARKS", 300)):
        monkeypatch.setattr(phrases, name, value)
    rng = random.Random(7)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(150)], k=60)) + " a b c d" for _ in range(500)]
    texts += [f"top w{i}" for i in range(40) for _ in range(9)]  # a word that begins more phrases than a trie should take
    counted = []
    real = phrases._candidates
    monkeypatch.setattr(phrases, "_candidates", lambda *a: counted.append(real(*a).cache()) or counted[-1])
    assert phrases._lots(32_000, 9)[0] > 10
    assert found_of(phrases.collocations(documents(texts), 9)) == brute([(None, t) for t in texts], 9)
    pairs = Counter(p for t in texts for p in zip(t.split(), t.split()[1:]))
    often = sum(n >= 9 for n in pairs.values())
    assert often <= counted[0].count() < 1.2 * often < 0.2 * len(pairs)


def test_a_position_is_walked_in_the_trie_of_its_first_word_only(spark, monkeypatch):
    monkeypatch.setattr(phrases, "TRIE_PHRASES", 80)
    candidates = spark.range(2000).select(
        F.lit("en").alias("lang"), F.col("id").alias("mark"),
        F.expr("unhex(concat(lpad(hex(if(id < 500, 1, 2 + id div 3)), 16, '0'), lpad(hex(id), 16, '0')))").alias("words"))
    dealt = phrases._tries(candidates, 2, 25).groupBy(F.expr("substring(words, 1, 8)").alias("first")).agg(
        F.countDistinct("shard").alias("shards"), F.count("*").alias("n"))
    assert {r["shards"] for r in dealt.where("n < 10").collect()} == {1}
    assert dealt.where("n = 500").first()["shards"] == 25
    assert phrases._tries(candidates, 2, 25).groupBy("shard").count().agg(F.max("count")).first()[0] < 160
