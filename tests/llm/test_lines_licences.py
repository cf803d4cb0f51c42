import random
from collections import Counter

from sonoquarry.llm import licences, lines


def brute_lines(rows, ratio, least):
    pages, seen = Counter(), Counter()
    for _, h, t in rows:
        pages[h] += 1
        seen.update({(h, x.strip(" \t\r")) for x in (t or "").split("\n")} if t is not None else ())
    out = []
    for d, h, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        all_lines = t.split("\n")
        bad = lambda x: (s := x.strip(" \t\r")) != "" and seen[h, s] >= least and seen[h, s] > ratio * pages[h]  # noqa: E731,B023
        kept = [x for x in all_lines if not bad(x)]
        if not any(x.strip(" \t\r") for x in kept):
            kept = all_lines
        out.append((d, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=str)


def test_lines(spark):
    r = random.Random(3)
    some = ["menu", " menu\t", "home | about", "", "é"] + [f"line {k}" for k in range(30)]
    rows = [(k, r.choice(["a", "b", "c", None]), "\n".join(r.choice(some if r.random() < 0.5 else some[:4]) for _ in range(r.randint(1, 6)))) for k in range(200)]
    rows += [(500, "a", None), (501, "a", ""), (502, "d", "only\nonce"), (502, "d", "only\nonce"), (503, "a", "x\n" * 50_000 + "menu"), (None, None, "menu\nz")]
    d = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 as lines", "2 as _host", "3 as c0")
    got = sorted(((x.doc_id, x.text, x[6].n_lines, x[6].n_dropped) for x in lines.without_boilerplate(d).collect()), key=str)
    assert got == brute_lines(rows, lines.RATIO, lines.PAGES)
    assert any(x[3] for x in got)
    assert lines.without_boilerplate(d.limit(0)).collect() == []


def brute_licences(text, threshold):
    t = text or ""
    units = t.split("\n")
    import re

    units += [p for p in re.split(r"\n[ \t\r]*\n", t) if "\n" in p.strip(" ")]
    units.append(t)
    found = []
    for u in dict.fromkeys(units):
        g = set(licences.bigrams_of(u))
        best = max(((2 * len(g & set(b)) / (len(g) + len(b)), n) for n, x in sorted(licences.TEMPLATES.items()) if (b := licences.bigrams_of(x)) and g), key=lambda x: x[0], default=(0, ""))
        if best[0] >= threshold:
            found.append(best)
    return sorted({n for _, n in found}), len(found), round(max(d for d, _ in found), 9) if found else None


def test_licences(spark):
    r = random.Random(6)
    pieces = [*licences.TEMPLATES.values(), "some words here", "Released", "under the", "MIT license", "all RIGHTS reserved", ""]
    texts = []
    for _ in range(150):
        words = " ".join(r.choice(pieces) for _ in range(2)).split()
        texts.append("\n".join(["intro text é", " ".join(w for w in words if r.random() > 0.07), r.choice(pieces), r.choice(["", "tail"]), r.choice(pieces)]))
    texts += [None, "", "MIT", "released under\nthe mit license", "x " * 100_000, licences.TEMPLATES["MIT"]]
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[5])]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as found", "2 as licences")
    got = sorted(((x.doc_id, x.licences, x.n_found, x.best_dice) for x in licences.findings(d).collect()), key=str)
    assert got == sorted(((k, *brute_licences(t, licences.THRESHOLD)) for k, t in rows), key=str)
    assert sum(x[2] for x in got) > 100
    assert licences.findings(d.limit(0)).collect() == []
    assert {x.n_found for x in licences.findings(d, templates={}).collect()} == {0}


def test_whole_licence_texts(spark):
    mit = licences.TEMPLATES["MIT-text"].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    wrapped = lambda t: "\n".join(" ".join(t.split(" ")[k : k + 9]) for k in range(0, len(t.split(" ")), 9))
    texts = ["MIT License\n\nCopyright (c) 2020 Some One\n\n" + mit, wrapped(licences.TEMPLATES["ISC-text"]), "Intro\n\n" + wrapped(licences.TEMPLATES["BSD-3-Clause-text"]) + "\n\nmore prose here", wrapped(licences.TEMPLATES["Zlib-text"])]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.licences for x in licences.findings(d).collect()}
    assert "MIT-text" in got[0] and got[1] == ["ISC-text"] and got[2] == ["BSD-3-Clause-text"] and got[3] == ["Zlib-text"]


def test_every_match_holds_a_marker():
    r = random.Random(1)
    own = {n: licences.bigrams_of(t) for n, t in licences.TEMPLATES.items()}
    marked = licences.markers(own, licences.THRESHOLD)
    matched = 0
    for _ in range(4000):
        words = licences.words_of(r.choice(list(licences.TEMPLATES.values())))
        for _ in range(r.randint(0, max(1, len(words) // 4))):
            k = r.randrange(len(words))
            words[k : k + 1] = r.choice([[], ["x"], [words[k], "x"]])
            if not words:
                break
        text = " ".join(words)
        g = set(licences.bigrams_of(text))
        if g and max(2 * len(g & set(b)) / (len(g) + len(b)) for b in own.values()) >= licences.THRESHOLD:
            matched += 1
            assert any(m in text for m in marked)
    assert matched > 1000
