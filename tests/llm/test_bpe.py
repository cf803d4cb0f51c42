import hashlib
import random

import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
from sonoquarry.llm import bpe as op

PATH = P.path("word_bpe_49k.json")


def texts():
    r = random.Random(3)
    latin = [chr(c) for c in [*range(1, 0x250), *range(0x2010, 0x205F)]]
    out = [None, "", " ", "a", "It's we'll 'something ''re", "<|endoftext|>x<|startoftext|><|endoftext", "ΑΣ ΣΑΣ İstanbul Straße ñandú", "x" * 5000, "日本語 テスト 12٣ ①", "éà ẛ̣", "a\x1cb\x85c d", "\U0001f600\U0001f600 hé"]
    out += ["".join(r.choice(latin) for _ in range(40)) for _ in range(150)]
    out += ["".join(r.choice("thearinogd es'") for _ in range(200)) for _ in range(150)]
    out += ["".join(chr(r.choice([r.randint(1, 0xD7FF), r.randint(0x300, 0x3FF), 97])) for _ in range(30)) for _ in range(100)]
    return out + [latin[k] + "x" + latin[k] for k in range(len(latin))]


def test_like_the_library(spark):
    rows = list(enumerate(texts()))
    t = tokenizers.Tokenizer.from_file(PATH)
    want = {}
    for k, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want[k] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as n_tokens")
    got = {r[0]: tuple(r)[1:] for r in op.digests(d, PATH).collect()}
    assert {k: rows[k][1] for k in want if got[k] != want[k]} == {}
    ids = op.encode(d, PATH)
    back = {r.doc_id: r.text for r in op.decode(ids, PATH).collect()}
    assert {k: hashlib.sha256(x.encode()).hexdigest() for k, x in back.items()} == {k: x[2] for k, x in want.items()}
    assert op.digests(d.limit(0), PATH).collect() == []


def test_small_table_changes_nothing(monkeypatch):
    v = op.Vocabulary(PATH)
    want = list(op.Encoder(v).encode(texts()))
    monkeypatch.setattr(op, "_TABLE_WORDS", 7)
    monkeypatch.setattr(op, "_SLICE_CHARS", 50)
    assert list(op.Encoder(v).encode(texts())) == want


def test_decoded_text_comes_from_the_ids(monkeypatch):
    encoder = op.Encoder(op.Vocabulary(PATH))
    whole = op.Encoder.decode
    monkeypatch.setattr(op.Encoder, "decode", lambda self, ids: whole(self, ids)[::-1])
    got = op._digests(encoder, ["some text", None])["decoded_sha256"].to_pylist()
    want = [whole(encoder, ids)[::-1] for _, ids in encoder.encode(["some text", None])]
    assert got == [hashlib.sha256(x.encode()).hexdigest() for x in want]
