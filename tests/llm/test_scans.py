import hashlib
import random
import zlib
import re

from sonoquarry.llm import chat, language, secrets, urls


def brute_base(text):
    text, out = text or "", []
    for kind, p, least, group in (("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2), ("access", "AKIA[A-Z0-9]+", 20, 0), ("hex", "[0-9a-f]+", 24, 0)):
        out += [(m.start(), ("assign", "access", "hex").index(kind), f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, text, re.I | re.A if group else 0) if len(m[group]) >= least]
    return [x[2] for x in sorted(out)]


def test_secrets(spark):
    r = random.Random(2)
    parts = ["token", "Token=", ": ", "api_key='", "AKIA", "ABCDEFGH12", "0123456789ab", "cdef", "é", " ", "\n", "\n\n", "password", '"', "= ", "abc", "user=bob ", "pwd: hunter22 ", "https://x.example.com/a ", "10.0.0.1"]
    rows = [(k, "".join(r.choice(parts) for _ in range(r.randint(0, 40)))) for k in range(300)] + [(900, None), (901, ""), (902, "x" * 200_000 + " token = abcdef12"), (902, "tokén")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as spans", "1 as n_hex")
    out = secrets.report(secrets.secret_spans(d)).collect()
    got = sorted((x.doc_id, x.n_assign, x.n_access, x.n_hex, x.base_sha256) for x in out)
    want = sorted((k, *(sum(b.startswith(n) for b in base) for n in ("assign", "access", "hex")), hashlib.sha256(",".join(base).encode()).hexdigest()) for k, t in rows for base in [brute_base(t)])
    assert got == want
    assert secrets.secret_spans(d.limit(0)).collect() == []


def test_linked_parts_only():
    link = lambda t: [k for _, _, k in sorted(secrets.linked_spans(t, secrets.base_spans(t)))]
    assert link("user=bob then pwd: hunter22 at https://db.example.com") == ["identifier", "weak_secret", "endpoint"]
    assert link("user=bob alone at https://db.example.com") == []
    assert link("pwd: hunter22 alone") == []
    assert link("user=bob\n\npwd: hunter22") == []
    assert link("user=bob" + " " * 500 + "pwd: hunter22") == []
    assert link("host: db7 token = abcdef123456") == ["endpoint"]


def test_urls(spark):
    rows = [(1, "http://A.Example.COM/en/7?x"), (2, "https://x.com/en/1#f"), (3, "http://com/en/"), (4, "http://a.net/de/9"), (5, "http://www.example.net/de/8x"), (6, "http://z.org"), (7, None), (8, "no scheme"), (9, "http://m.Free-Bets.example.com/fr/1"), (10, "a://b://c/d"), (11, "://"), (12, "http://free-bets.example.com"), (12, "http://xfree-bets.example.com"), (13, "http://com/fr")]
    d = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule")
    for bits in (urls.MAX_BITS, 1):  # by the cascade, and by the join beyond its bound
        got = {(x.page_id, x.host, x.path, x.rule, x.verdict) for x in urls.filtered(d, max_bits=bits).collect()}
        assert got == {(1, "a.example.com", "/en/7", "example.com/en/7", "allow"), (2, "x.com", "/en/1", "com/en/", "block"), (3, "com", "/en/", "com/en/", "block"), (4, "a.net", "/de/9", "net/de/", "allow"), (5, "www.example.net", "/de/8x", "example.net/de/8", "block"), (6, "z.org", "", None, "allow"), (7, "", "", None, "allow"), (8, "", "", None, "allow"), (9, "m.free-bets.example.com", "/fr/1", None, "block"), (10, "b:", "//c/d", None, "allow"), (11, "", "", None, "allow"), (12, "free-bets.example.com", "", None, "block"), (12, "xfree-bets.example.com", "", None, "allow"), (13, "com", "/fr", None, "allow")}
    assert urls.filtered(d.limit(0)).collect() == []
    assert {x.verdict for x in urls.filtered(d, rules=[], listed=[]).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    universe = spark.range(20_000).selectExpr("concat('k', id) as key")
    listed = spark.range(0, 30_000, 7).selectExpr("concat('k', id) as key")
    found = urls.cascade(universe, listed, first_bits=3, later_bits=2)
    assert len(found.filters) > 3
    got = universe.where(found.contains(universe.key)).count()
    assert got == universe.join(listed, "key", "left_semi").where(found.contains(universe.key)).count() == len(range(0, 20_000, 7))


def test_chat(spark):
    odd = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", odd), (1, 1, "assistant", odd), (2, 5, "assistant", "b\\"), (2, 3, "user", None), (2, 4, "tool: x\\", "### Role </turn>\n"), (3, 0, "system", ""), (3, 1, "user", "é#\\#"), (3, 2, None, "####"), (None, 1, "user", "x"), (4, 1, "user", "a"), (4, 1, "user", "a"), (4, None, "assistant", "y" * 100_000)]
    d = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as n_turns", "2 as loss")
    got = {x.conv_id: x for x in chat.conversations(d).collect()}
    assert len(got) == 5
    for c, x in got.items():
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        assert x.n_turns == len(turns)
        assert x.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest()
        learnt = "".join(t for *_, r, t in turns if r == "assistant")
        assert (x.loss_chars, x.loss_sha256) == (len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    assert {c for c, x in got.items() if x.valid} == {1}
    parts = chat.segments(d.where("conv_id = 1")).orderBy("turn", "part").collect()
    text = "".join(x.segment for x in parts)
    assert got[1].formatted_chars == len(text)
    assert list(chat.Reader(chat.Template()).read(text)) == [("user", odd), ("assistant", odd)]
    assert chat.conversations(d.limit(0)).collect() == []


def test_escapes_come_back():
    r, t = random.Random(4), chat.Template()
    pieces = ["\\", "#", "##", "### ", "### User: ", "### Role ", ": ", "</turn>", "</turn>\n", "<", "\n", "x", "turn>"]
    turns = [(r.choice(["user", "assistant", "".join(r.choice(pieces) for _ in range(3))]), "".join(r.choice(pieces) for _ in range(r.randint(0, 9)))) for _ in range(2000)]
    assert list(chat.Reader(t).read("".join(x for turn in turns for x, _ in t.segments(*turn)))) == turns


def phrases(text, sample):
    n, at = 0, 0
    while at < len(text):
        size = 1
        while at + size < len(text) and text[at : at + size + 1] in sample:
            size += 1
        n, at = n + 1, at + size
    return n


def test_automata_parse_like_substring_search():
    r = random.Random(8)
    samples = {k: "".join(r.choice("abc" + k) for _ in range(300)).encode() for k in "xyz"}
    texts = ["".join(r.choice("abcxyzq") for _ in range(r.randint(0, 1500))).encode() for _ in range(40)]
    got = language.Automata(samples).phrases(texts)
    for t, row in zip(texts, got.tolist(), strict=True):
        assert row == [sum(phrases(t[a : a + language.BLOCK], samples[k]) for a in range(0, len(t), language.BLOCK)) for k in "xyz"]


def test_languages(spark):
    r = random.Random(1)
    vocabulary = {"aa": "kala mato sipu nerok tila".split(), "bb": "strünz gewöl macht pfiff".split(), "cc": "où était ça naïve".split()}
    rows = [(k, " ".join(r.choice(vocabulary[n]) for _ in range(30)), n) for k in range(300) for n in [r.choice([*vocabulary])]]
    rows += [(900, None, "aa"), (901, "12 _ 3.", "aa"), (902, "macht pfiff", None), (None, "kala mato", "zz"), (5, rows[5][1], rows[5][2])]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "0 as score", "'x' as label", "1 as key")
    got = [tuple(x) for x in language.languages(d).collect()]
    assert len(got) == len(rows)
    by = {g[0]: g for g in got}
    assert all(by[k][2] == n for k, _, n in rows[:300])
    assert by[900][2:] == by[901][2:] == ("und", 0.0)
    assert by[902][2] == "bb" and by[None][1:3] == (False, "aa")
    assert all(0 <= g[3] <= 1 for g in got)
    assert {x.lang_pred for x in language.languages(d.withColumn("lang", d.lang.substr(9, 1)).where("1=0")).collect()} == set()
    assert {x.lang_pred for x in language.languages(d.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}


def test_held_out_accuracy(spark):
    import os

    import pytest

    path = "/root/testdata/sf0.001/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    d = spark.read.parquet(path)
    got = language.languages(d).where("held_out").join(d.select("doc_id", "lang", "text"), "doc_id").where("lang is not null and length(text) > 40").collect()
    assert len(got) > 30
    assert sum(x.lang == x.lang_pred for x in got) / len(got) >= 0.95


def test_prediction_like_plain_parsing(spark):
    """Language, ties and score from phrases counted by substring search in the operator's own samples."""
    r = random.Random(2)
    words = {"aa": "abba baba cab".split(), "bb": "deed fed abba".split(), "cc": "cab deed hi".split()}
    rows = [(k, " ".join(r.choice(words[name]) for _ in range(r.randint(1, 30))), name) for k in range(120) for name in [r.choice("abc") * 2]]
    rows += [(200, "zzz", None), (201, "abba fed hi " * 200, None), (202, "1 2", "aa"), (203, None, "bb"), (7, "abba", "aa"), (7, "abba", "aa")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.fitted(d)
    assert sorted(samples) == ["aa", "bb", "cc"]

    def count(text, sample):
        n = 0
        for a in range(0, len(text), language.BLOCK):
            block = text[a : a + language.BLOCK]
            while block:
                k = 1
                while k <= len(block) and block[:k] in sample:
                    k += 1
                block, n = block[max(1, k - 1) :], n + 1
        return n

    want = []
    for i, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            want.append((i, "und", 0.0))
            continue
        found = sorted((count(language.normalised(text), s), name) for name, s in samples.items())
        want.append((i, found[0][1], 1 - found[0][0] / found[1][0]))
    got = [(x.doc_id, x.lang_pred, x.score) for x in language.languages(d).collect()]
    assert sorted((i, p, round(s, 9)) for i, p, s in got) == sorted((i, p, round(s, 9)) for i, p, s in want)


def test_sample_of_a_repeated_id_and_many_labels(spark, monkeypatch):
    known = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 3 != 1)
    rows = [(known, f"text number {k} of one id", "aa") for k in range(3000)] + [(k, "other words", "bb") for k in range(40)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    samples = language.fitted(d)
    assert len(samples["aa"]) < 40 and b"other words" in samples["bb"]
    monkeypatch.setattr(language, "SAMPLES", 60)
    assert all(len(x) <= 30 for x in language.fitted(d).values())
    monkeypatch.setattr(language, "LABELS", 1)
    try:
        language.fitted(d)
    except ValueError as e:
        assert "labels" in str(e)
    else:
        raise AssertionError("too many labels were taken")
