import random
import re

import numpy as np
import pytest

from paytrail.llm import ngram_join as nj

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, size, percent):
    sets = {}
    for doc_id, text in rows:
        words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
        width = min(size, len(words))
        sets[doc_id] = {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, families=12, copies=9):
    rng = random.Random(seed)
    rows = []
    for family in range(families):
        words = [f"w{rng.randrange(40 + 400 * (family % 2))}" for _ in range(rng.choice([4, 12, 30, 90, 300]))]
        for _ in range(copies):
            new = list(words)
            for _ in range(rng.randrange(0, 1 + len(words) // 12)):
                new[rng.randrange(len(new))] = f"x{rng.randrange(9)}"
            rows.append((len(rows), " ".join(new)))
    return rows


@pytest.mark.parametrize("size,percent,block", [(3, 90, 512), (5, 80, 512), (5, 80, 6)])
def test_components_equal_brute_force(table, monkeypatch, size, percent, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    rows = near_copies(percent + block)
    found = nj.join_components(table(rows, "doc_id long, text string"), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows, size, percent)


def test_edge_cases(table):
    rows = [
        (1, None, 0), (2, "", 0), (3, " \n", 0), (4, "One two", 0), (5, "one TWO", 0), (6, "one", 0),
        (7, "É b c", 0), (8, "é b c", 0), (None, "one two", 0), (5, "one TWO", 0), (9, "a b " * 5000, 0),
    ]
    df = table(rows, "doc_id long, text string, sig int")
    found = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in nj.join_components(df, 3, 90).collect())
    assert found == sorted([
        (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (5, 1, 4), (6, 1, 6), (7, 1, 7), (8, 1, 8),
        (-1, 1, -1), (9, 2, 9),
    ])
    assert nj.join_components(df.limit(0), 3, 90).count() == 0
    kept = nj.keep_first(df, 3, 90)
    assert kept.columns == df.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 2, 3, 4, 6, 7, 8, 9]


def test_different_texts_of_one_id_stay(table):
    one, two = "a b c d e f g h", "i j k l m n o p"
    rows = [(1, one, 1), (1, two, 2), (2, two, 3), (1, one, 4), (3, None, 5), (3, "", 6), (3, None, 7)]
    for clash in ("row", "tie", "root"):
        kept = nj.keep_first(table(rows, f"doc_id int, text string, {clash} int"))
        assert kept.columns == ["doc_id", "text", clash]
        found = sorted((r.doc_id, r.text or "-") for r in kept.collect())
        assert found == sorted([(1, one), (1, two), (3, "-"), (3, "-")])


def test_linked_sets_share_a_part():
    rng = np.random.default_rng(1)
    for n in (9, 20, 57, 200, 1000):
        for _ in range(40):
            a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[rng.permutation(n)[: -(-9 * n // 10)]], a[:0]]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 90 * (len(a) + len(b) - both) and len(a) != len(b):
                assert set(nj.signatures(a, 90)) & set(nj.signatures(b, 90))


def test_texts_of_one_template_are_not_brought_together(table, monkeypatch):
    monkeypatch.setattr(nj, "BLOCK", 64)
    rng = random.Random(5)
    rows = [
        (i, " ".join(f"t{k}" for k in range(60)) + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(8)))
        for i in range(400)
    ]
    rows += [(400 + i, text + " today") for i, (_, text) in enumerate(rows[:20])]
    docs = table(rows, "doc_id long, text string")
    described = nj.describe(docs, 3, 90).cache()
    shared = nj.shared_parts(described)
    assert shared.groupBy("sig").count().agg({"count": "max"}).first()[0] > 64
    found = nj.possible(shared, docs, described, 3, 90).groupBy("sub").count().agg({"count": "max"}).first()[0]
    assert found <= 64
    result = nj.join_components(docs, 3, 90).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in result} == brute(rows, 3, 90)
