import random

import corpus_pipeline

STAGES = dict(corpus_pipeline.STAGES)


def brute_kept(rows, words):
    """Ids that are smallest in their group of texts at 0.8 of shingles of so many words."""
    sets = {}
    for d, t in rows:
        w = t.split()
        sets[d] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)}
    home = {d: d for d in sets}

    def find(x):
        while home[x] != x:
            x = home[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                home[max(x, y)] = min(x, y)
    return {d for d in sets if find(d) == d}


def test_near_duplicates_are_of_five_words(spark):
    r = random.Random(21)
    texts = []
    for k in range(40):
        base = [f"w{r.randint(0, 10**6)}" for _ in range(40)]
        for edits in range(4):
            w = list(base)
            for _ in range(edits):
                w[r.randrange(k % 10, 40)] = f"x{r.randint(0, 10**6)}"
            texts.append(" ".join(w))
    texts += ["a b c", "a b c", "a b c d", "a b c d e", "a b d c", "a"]
    rows = list(enumerate(texts))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id for x in STAGES["near_duplicates"](spark, d, "").collect()}
    assert got == brute_kept(rows, 5)
    assert got != brute_kept(rows, 2)


def test_line_on_a_tenth_of_a_large_source_goes(spark):
    rows = [(k, f"own {k}" + "\nshared menu" * (k % 10 == 0) + "\nseldom" * (k % 25 == 0), "s", 0) for k in range(1000)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    got = STAGES["lines"](spark, d, "").collect()
    assert {x.doc_id: x.text for x in got} == {k: t.replace("\nshared menu", "") for k, t, _, _ in rows}
    assert all(x.n_chars == len(x.text) for x in got if x.doc_id % 10 == 0)


def test_texts_in_no_learned_language_go(spark):
    r = random.Random(5)
    words = {"en": "the and house water river over under where small great".split(), "fr": "le la maison rivière où petit grand sous vers été".split()}
    prose = lambda lang, n: " ".join(r.choice(words[lang]) for _ in range(n))
    rows = [(k, prose(lang, 60), lang) for k in range(120) for lang in [r.choice(["en", "fr"])]]
    strange = "".join(r.choice("bcdfgjkqvwxyz ") for _ in range(400))
    gone = [(200, "Съешь же ещё этих мягких французских булок " * 5, "en"), (201, strange, None), (202, "12 34", "en"), (203, None, "fr"), (204, "", None)]
    stay = [(300, prose("en", 900), None), (301, prose("fr", 400) + " " + prose("en", 400), None), (302, "ok", None), (None, prose("fr", 30), None), (5, rows[5][1], "en")]
    d = spark.createDataFrame(rows + gone + stay, "doc_id long, text string, lang string")
    got = STAGES["language"](spark, d, "").collect()
    assert sorted(map(tuple, got), key=str) == sorted(rows + stay, key=str)
    assert STAGES["language"](spark, d.limit(0), "").collect() == []
