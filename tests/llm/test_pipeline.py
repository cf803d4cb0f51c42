import os
import random

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from sonoquarry.llm.registry import vocabulary_path
from tests.llm import test_decontaminate, test_lines_licences, test_minhash

pytestmark = pytest.mark.skipif(not os.path.exists(vocabulary_path()), reason="no vocabulary file here")


def test_like_brute_force_stage_by_stage(spark, tmp_path):
    r = random.Random(12)
    words = {"en": [f"the{k}" for k in range(60)], "fr": [f"où{k}é" for k in range(60)]}
    prose = lambda n, lang: " ".join("".join(c for c in r.choice(words[lang])) for _ in range(n))
    items = [(k, prose(14, "en")) for k in range(5)]
    docs = []
    for k in range(120):
        lang = r.choice(["en", "fr"])
        text = "\n".join(prose(r.randint(5, 30), lang) for _ in range(3))
        if k % 3 == 0:
            text = "site menu home\n" + text
        if k % 17 == 0:
            text += "\n" + items[k % 5][1]
        if docs and k % 6 == 0:
            text = docs[-1][1] + " tail"
        docs.append((k, text, lang, f"src{k % 2}", len(text)))
    docs += [(500, None, "en", "src0", 0), (501, "12 34", None, "src0", 5), (502, "", "fr", None, 0), (None, docs[3][1], "en", "src0", 9), (3, *docs[3][1:])]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 as kept", "2 as lines")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    taken = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        now = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert now.columns == d.columns
        taken.append([tuple(x)[:4] for x in now.collect()])
    plain = [x[:4] for x in docs]
    want = [x for x in plain if x[1] and any(c.isalpha() for c in x[1])]
    assert sorted(taken[0], key=str) == sorted(want, key=str)
    cleaned = test_lines_licences.brute_lines([(x[0], x[3], x[1]) for x in taken[0]], 0.2, 5)
    assert sorted(((x[0], x[1]) for x in taken[1]), key=str) == sorted(((x[0], x[1]) for x in cleaned), key=str)
    assert all("site menu" not in x[1] for x in taken[1] if x[3] == "src1")
    keep = {x[0] for x in test_minhash.brute([x[:2] for x in taken[1]]) if x[3]} | {None}
    assert sorted(taken[2], key=str) == sorted({x for x in taken[1] if x[0] in keep}, key=str)
    assert len(taken[2]) < len(taken[1])
    clean = {x[0] for x in test_decontaminate.brute([x[:2] for x in taken[2]], items) if not x[5]}
    assert sorted(x[0] or -1 for x in taken[3]) == sorted(x or -1 for x in clean)
    assert len(taken[3]) < len(taken[2])
    assert sorted(x[0] or -1 for x in taken[4]) == sorted(x[0] or -1 for x in taken[3])
    assert sorted(map(tuple, corpus_pipeline.run(spark, str(tmp_path)).collect()), key=str) == sorted(map(tuple, now.collect()), key=str)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
