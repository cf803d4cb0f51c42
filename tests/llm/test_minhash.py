import random
import re

import numpy as np

from sonoquarry.llm import minhash as op

UP = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP))
    return {tuple(w[k : k + 2]) for k in range(len(w) - 1)} if len(w) > 1 else {tuple(w)} - {()}


def brute(rows):
    """Component of every row, by comparing all rows of distinct texts."""
    texts = {}
    for d, t in rows:
        if d is not None and (s := frozenset(shingles(t))):
            texts[s] = min(d, texts.get(s, d))
    home = {d: d for d in texts.values()}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    sets = list(texts)
    for i, a in enumerate(sets):
        for b in sets[:i]:
            n = len(a & b)
            if 100 * n >= 80 * (len(a) + len(b) - n):
                x, y = find(texts[a]), find(texts[b])
                home[max(x, y)] = min(x, y)
    out = []
    for d, t in rows:
        s = frozenset(shingles(t))
        c = None if d is None else find(texts[s]) if s else d
        out.append((d, len(s), c, d is not None and c == d))
    return sorted(out, key=str)


def copies(r, n, words, edits):
    base = [f"w{r.randint(0, 10**6)}" for _ in range(words)]
    for _ in range(n):
        w = list(base)
        for _ in range(r.randint(0, edits)):
            w[r.randrange(words)] = f"x{r.randint(0, 10**6)}"
        yield " ".join(w)


def test_like_brute_force(spark):
    r = random.Random(9)
    texts = [x for n, words, edits in ((60, 60, 6), (5, 12, 2), (40, 100, 12), (3, 400, 20), (2, 3, 0), (30, 40, 5)) for x in copies(r, n, words, edits)]
    texts += [" ".join(str(r.randint(0, 9)) for _ in range(20)) for _ in range(80)] + texts[:25] + ["one", "ONE", "one two", "One\ttwo", None, "", " \n", "é É"]
    r.shuffle(texts)
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, texts[0]), (None, None), (3, texts[3]), (10_000, "z " * 200_000)]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as n", "'y' as mark", "1 as hub")
    assert sorted(map(tuple, op.near_duplicates(d).collect()), key=str) == brute(rows)


def test_empty(spark):
    d = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    assert op.near_duplicates(d.limit(0)).collect() == []
    assert sorted(map(tuple, op.near_duplicates(d).collect()), key=str) == [(1, 1, 1, True), (None, 0, None, False)]


def test_signature_estimates_similarity():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 3000).astype(np.uint64))
    b = np.unique(np.concatenate([a[:2500], r.integers(0, 2**63, 500).astype(np.uint64)]))
    same = (op.signature(a, 200) == op.signature(b, 200)).mean()
    assert abs(same - 2500 / 3500) < 0.12


def test_blocks_find_links_across_components(spark):
    import pandas as pd

    codes = lambda *x: np.array(x, np.int64)
    block = pd.DataFrame({"hub": 1, "doc_id": [1, 2, 3, 4], "home": [1, 1, 3, 3], "open": [False, False, True, False], "i": 0, "j": 0, "codes": [codes(1, 2, 3, 4, 5), codes(7, 8), codes(1, 2, 3, 4), codes(1, 2, 3, 4)]})
    assert op._compare(80)(block).values.tolist() == [[3, 1]]
    assert op._compare(81)(block).values.tolist() == []
