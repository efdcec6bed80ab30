"""Circulant MinHash against brute force."""

import random

import numpy as np
import pytest

from solarspark.llm import minhash

HARD = [None, "", " \t\n", "a", "A", "a b", "a b", "one two three four five", "One two\tthree four FIVE", "word " * 3000,
        "x" * 5000, "é É", "á b \x85c"]


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in __import__("re").split("[\x20\x09-\x0d]+", lowered) if w]


def shingles(text, n=5):
    words = words_of(text)
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute(texts, percent, ids=None):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                label[root(i)] = root(j)
    least = {}
    for i in range(len(texts)):
        name = i if ids is None else ids[i]
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    return [len(s) for s in sets], [least.get(root(i)) for i in range(len(texts))]


def near_texts(rng):
    """Families of edited copies around the threshold, chains, and unrelated texts."""
    texts = list(HARD)
    for family in range(12):
        words = [f"f{family}w{rng.randrange(400)}" for _ in range(rng.choice([8, 40, 150]))]
        for _ in range(rng.choice([2, 5, 12])):
            edited = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                edited[rng.randrange(len(edited))] = f"e{rng.randrange(50)}"
            texts.append(" ".join(edited))
            if rng.random() < 0.3:
                words = edited
            if rng.random() < 0.3:
                texts.append(texts[-1].upper())
    texts += [" ".join(rng.choices("abcdefghij", k=rng.randint(1, 60))) for _ in range(30)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("percent,block", [(85, 500), (85, 3), (95, 2)])
def test_components_are_those_of_all_pairs(spark, documents, monkeypatch, percent, block):
    monkeypatch.setattr(minhash, "BLOCK_SETS", block)
    texts = near_texts(random.Random(percent * block))
    sizes, expected = brute(texts, percent)
    found = {r["doc_id"]: r for r in minhash.near_duplicates(documents(texts), percent).collect()}
    assert [found[i]["n_shingles"] for i in range(len(texts))] == sizes
    assert [found[i]["component_id"] for i in range(len(texts))] == expected
    assert all(r["kept"] == (r["component_id"] == i) for i, r in found.items())


def test_sets_beyond_the_table_of_rows_and_blocks_by_size(spark, documents, monkeypatch):
    monkeypatch.setattr(minhash, "FEW_TEXTS", 0)
    monkeypatch.setattr(minhash, "BLOCK_ELEMENTS", 300)
    texts = near_texts(random.Random(8))
    found = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts, 85)[1]


def test_repeated_and_null_ids(spark, documents):
    a = " ".join(f"w{i}" for i in range(60))
    texts, ids = [a, a + " x", a, "other text", None, a, "alone", ""], [5, 3, 3, 9, 10, None, None, 9]
    rows = minhash.near_duplicates(documents(texts, ids)).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in rows), key=str) == sorted([
        (5, 56, 3, False), (3, 57, 3, True), (3, 56, 3, True), (9, 1, 9, True), (10, 0, 10, True), (None, 56, 3, False),
        (None, 1, None, True), (9, 0, 9, True)], key=str)
    assert minhash.near_duplicates(documents([])).count() == 0


def test_coordinates_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(1)
    for percent in (50, 85):
        agree = []
        for _ in range(60):
            pool = rng.integers(0, 2**64, 400, dtype=np.uint64)
            common = 400 * percent // 100
            rest = (400 - common) // 2
            a, b = pool[:common + rest], np.r_[pool[:common], pool[common + rest:]]
            agree.append((minhash.signature(np.sort(a)) == minhash.signature(np.sort(b))).mean())
        assert abs(np.mean(agree) - percent / 100) < 0.02
        # One circulant permutation must not spread the estimates more than as many free ones do.
        assert np.std(agree) < 1.3 * np.sqrt(percent * (100 - percent) / 1e4 / (minhash.BANDS * minhash.ROWS))


def test_sets_are_joined_as_all_pairs_would():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(20, 60)).astype(np.uint64)) for _ in range(40)]
    for labels, split in (([str(i) for i in range(40)], None), ([str(i // 3) for i in range(40)], None),
                          ([str(i) for i in range(40)], 17)):
        near = [(i, j) for i in range(40) for j in range(i + 1, 40) if labels[i] != labels[j]
                and (split is None or i < split <= j)
                and 100 * len(np.intersect1d(sets[i], sets[j])) >= 52 * len(np.union1d(sets[i], sets[j]))]
        found = minhash.joined(sets, labels, 52, split)
        assert found and all(j < i for i, j in found)

        def parts(pairs):
            name = {x: x for x in labels}

            def root(x):
                while name[x] != x:
                    x = name[x]
                return x
            for i, j in pairs:
                if root(labels[i]) != root(labels[j]):
                    name[root(labels[i])] = root(labels[j])
            return sorted(sorted(i for i in range(40) if root(labels[i]) == r) for r in set(map(root, labels)))

        assert parts(found) == parts(near)
