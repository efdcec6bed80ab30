"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from solarspark.llm import spelling

HARD = [None, "", " ", "a", "Hello hello HELLO hallo", "é" * 7, "ÀÉÎõü ÀÉÎõü àéîõü", "x" * 3000, "x" * 2999, "日本 Ünïcode×÷word ſtraße",
        "aaaaa aaaaaa aaaaaaa aabaa abaaa aaaab", "don't can't\x00zero"]


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, slip_every, ratio=2):
    counts = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if slip_every and h % slip_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 3}
    around = {w: [v for v in words if near(w, v)] for w in words}
    form = {}
    for w, found in around.items():
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(around[w]), words[form[w]] if form[w] else None) for w, n in words.items()}


def texts_of(rng):
    stems = ["abcde", "bbbbb", "collocate", "mississippi", "aàbéc", "xxyyzz"] + [
        "".join(rng.choices("abé", k=rng.randint(4, 7))) for _ in range(60)]
    texts = list(HARD) * 3
    for _ in range(250):
        out = []
        for _ in range(rng.randint(1, 30)):
            w = rng.choice(stems[:rng.choice([6, 66])])
            at = rng.randrange(len(w))
            w = rng.choice([w, w, w, w[:at] + w[at + 1:], w[:at] + rng.choice("abcé") + w[at:], w[:at] + "c" + w[at + 1:]])
            out.append(rng.choice([w, w.upper(), w.capitalize()]))
        texts.append(rng.choice([" ", ", ", "-"]).join(out))
    return texts


@pytest.mark.parametrize("slip_every,part_words", [(97, 50_000), (3, 7), (None, 2)])
def test_variants_are_those_of_all_pairs(spark, documents, monkeypatch, slip_every, part_words):
    monkeypatch.setattr(spelling, "PART_WORDS", part_words)
    monkeypatch.setattr(spelling, "HELD", 50)
    rng = random.Random(part_words)
    texts = texts_of(rng)
    ids = [rng.choice([None, i, 5, -i]) for i in range(len(texts))]
    found = spelling.spelling_variants(documents(texts, ids), slip_every=slip_every).collect()
    expected = brute(zip(ids, texts), slip_every)
    assert len(found) == len(expected)
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in found} == expected
    assert any(v[1] != v[0] and v[0] for v in expected.values())


def test_numbers_of_trie_nodes(spark, monkeypatch):
    rng = random.Random(3)
    words = sorted({"".join(rng.choices("ab", k=rng.randint(1, 9))) for _ in range(150)} | {"é", "z", "zz"})
    table = spark.createDataFrame([(w,) for w in words], "spelled string")
    for size in (1000, 20, 1):
        monkeypatch.setattr(spelling, "PART_WORDS", size)
        rows = sorted(spelling.number_trie(table, "spelled").collect(), key=lambda r: r["number"])
        assert [r["spelled"] for r in rows] == words
        node = {}
        for r in rows:
            assert len(r["nodes"]) == len(r["spelled"]) + 1
            for i, x in enumerate(r["nodes"]):
                assert node.setdefault(r["spelled"][:i], x) == x
        assert len(set(node.values())) == len(node)


def test_nothing(spark, documents):
    assert spelling.spelling_variants(documents([])).count() == 0
    assert spelling.spelling_variants(documents([None, "", "four five five"])).count() == 0
    assert [tuple(r) for r in spelling.spelling_variants(documents(["seven seven seven"])).collect()] == [
        ("seven", None, "seven", 3, 0, None)]
