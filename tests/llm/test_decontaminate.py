import hashlib
import random
import re

import pytest

from sonoquarry.llm import decontaminate as op

UP = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def brute(docs, items):
    words = lambda t: WORD.findall((t or "").translate(UP))
    windows = [(i, w[s : s + 10]) for i, t in items if (w := words(t)) for s in range(max(1, len(w) - 9))]
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, x in windows:
            for s in range(len(w) - len(x) + 1):
                if w[s : s + len(x)] == x:
                    hit.update(range(s, s + len(x)))
                    found.add(i)
        found.discard(None)
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_like_brute_force(spark, block_bytes):
    r = random.Random(5)
    text = lambda n, v: " ".join(r.choice("ab é Éa x9 The of".split()[:v]) + r.choice(["", ",", "\n"]) for _ in range(n))
    items = [(k, text(r.randint(0, 25), 6)) for k in range(12)] + [(50, "ab"), (51, "é the"), (52, None), (52, ""), (None, "of of of"), (53, " .. ")]
    docs = [(k, text(r.randint(0, 60), 7)) for k in range(40)] + [(100, items[3][1] + " " + items[4][1]), (101, None), (101, ""), (None, "of of of of"), (7, "AB"), (8, "x" * 300_000 + " ab")]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = sorted(map(tuple, op.contamination(d, b, block_bytes=block_bytes).collect()), key=str)
    assert got == brute(docs, items)


def test_empty(spark):
    d = spark.createDataFrame([(1, "a b c", 3)], "doc_id long, text string, n_hit long")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r)[:4] for r in op.contamination(d, none).collect()] == [(1, 3, 0, 0)]
    assert op.contamination(d.limit(0), none).collect() == []
