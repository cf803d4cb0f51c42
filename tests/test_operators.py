"""Operators of the engine against hand-made tables and plain loops over random inputs."""

import math
import random
from dataclasses import replace
from difflib import SequenceMatcher

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonoquarry.config import DEFAULT
from sonoquarry.functions import languages, numbers, signal
from sonoquarry.functions import text as T
from sonoquarry.operators import background, dedup, gates, graph, maintenance, reports, speakers
from sonoquarry.operators import segments as seg


def clip(**x):
    base = {"seq": 1, "utterance_id": "u", "source_id": "s", "text": "ఒక మంచి రోజు", "language": "te", "detected_language": "te", "language_probability": 0.9, "duration_sec": 5.0, "clipped_sample_ratio": 0.0, "dnsmos_ovrl": 3.5, "dnsmos_bak": 4.1, "stt_ok": True, "stt_error": None, "speaker_note": None, "cut_error": None}
    return base | x


CLIP = "seq long, utterance_id string, source_id string, text string, language string, detected_language string, language_probability double, duration_sec double, clipped_sample_ratio double, dnsmos_ovrl double, dnsmos_bak double, stt_ok boolean, stt_error string, speaker_note string, cut_error string"


def judged(spark, *rows):
    names = [c.split()[0] for c in CLIP.split(", ")]
    df = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], CLIP)
    return sorted(gates.judged(df).collect(), key=lambda x: x.seq)


def test_scenarios(spark):
    """Clean, silent, short, clipped, noisy, unsupported, borderline: one strict outcome each."""
    cases = [
        (clip(), "accepted", [], []),
        (clip(text="   "), "rejected", ["transcript:empty_transcript"], []),
        (clip(duration_sec=2.0), "rejected", ["below_min_clip_duration:2.00s"], []),
        (clip(clipped_sample_ratio=0.02), "rejected", ["clipping:2.000pct_samples_clipped"], []),
        (clip(clipped_sample_ratio=0.0005), "quarantined", [], ["clipping:0.050pct_samples_clipped"]),
        (clip(dnsmos_ovrl=2.4, dnsmos_bak=2.9), "rejected", ["dnsmos:overall_mos_2.40_below_reject_2.5", "background_music_or_noise:bak_2.90_below_reject_3.0"], []),
        (clip(dnsmos_ovrl=None, dnsmos_bak=None), "accepted", [], []),
        (clip(stt_ok=False, stt_error="503", text=""), "rejected", ["stt_failed:503"], []),
        (clip(speaker_note="speaker_borderline_match:x_sim_0.61"), "quarantined", [], ["speaker_borderline_match:x_sim_0.61"]),
        (clip(speaker_note="speaker_borderline_match:x_sim_0.61", duration_sec=25.0), "rejected", ["exceeds_hard_cap:25.00s"], ["speaker_borderline_match:x_sim_0.61"]),
        (clip(cut_error="no audio"), "rejected", ["cut_failed:no audio"], []),
        (clip(text="...", detected_language="hi"), "rejected", ["transcript:no_alphabetic_content"], []),
        (clip(detected_language="hi", language_probability=0.125), "quarantined", [], ["transcript:language_mismatch_detected_hi_target_te", "transcript:low_language_confidence_0.12"]),
        (clip(text="a\x01b"), "rejected", ["transcript:contains_control_characters"], []),
    ]
    for x, want in zip(judged(spark, *[c[0] | {"seq": k} for k, c in enumerate(cases)]), cases, strict=True):
        assert (x.status, x.rejection_reasons, x.review_reasons) == want[1:]


def test_source_integrity(spark):
    rows = [(True, True, 16000, 1, 2.0, 5000), (False, True, 16000, 1, 2.0, 5000), (True, False, 1, 1, 1.0, 5000), (True, True, 0, 1, 1.0, 5000), (True, True, 8000, 1, 1.0, 1000), (True, True, 8000, 0, 0.0, 10)]
    d = spark.createDataFrame(rows, "probe_ok boolean, has_audio_stream boolean, sample_rate int, channels int, duration_sec double, size_bytes int")
    assert [x.integrity_error for x in gates.source_integrity(d).collect()] == [None, "probe_failed", "no_audio_stream", "invalid_sample_rate", "file_too_small", "invalid_channels"]


def test_text_functions(spark):
    d = spark.createDataFrame([("తెలుగు  అక్షరాలు, A_1!", "a:b:c", 3723.0456)], "t string, r string, s double")
    x = d.select(T.dedup_text(F.col("t")).alias("t"), T.category(F.col("r")).alias("c"), T.detail(F.col("r")).alias("d"), T.detail(F.lit("a")).alias("e"), T.clock(F.col("s")).alias("s"), T.clock(F.lit(None).cast("double")).alias("n"), T.score_in(F.lit("x:bak_3.75_below_review_4.0"), "bak").alias("b"), T.safe_id(F.lit("a b/é.1")).alias("i"), T.fixed(F.lit(0.125), 2).alias("f"), T.fixed(F.lit(1.005), 2).alias("g")).first()
    import re

    want = re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", "తెలుగు  అక్షరాలు, A_1!".lower().strip()))
    assert (x.t, x.c, x.d, x.e, x.s, x.n, x.b, x.i, x.f, x.g) == (want, "a", "b:c", "", "01:02:03.046", "", 3.75, "a_b_é.1", "0.12", "1.00")


def test_repeated_ngram(spark):
    r = random.Random(1)
    rows = [[r.choice("ab") for _ in range(r.randint(0, 30))] for _ in range(400)] + [[], list("abc" * 3), list("abc" * 2)]
    got = [x[0] for x in spark.createDataFrame([(w,) for w in rows], "w array<string>").coalesce(1).select(T.repeated_ngram(F.col("w"))).collect()]
    assert got == [any(w[i : i + 3] == w[i + 3 : i + 6] == w[i + 6 : i + 9] and len(w[i : i + 9]) == 9 for i in range(len(w))) for w in rows]


def test_number_words(spark):
    assert numbers.number_words(1700) == "one thousand seven hundred".split()
    assert numbers.number_words(12_345_678) == "one crore twenty three lakh forty five thousand six hundred seventy eight".split()
    assert numbers.number_words(0) == ["zero"] and numbers.number_words(-21) == ["minus", "twenty", "one"]
    t = numbers.TELUGU
    texts = ["t20 ౧౭.", "12345678", "a5b6 7", "9 \u3000 100", "", "౨"]
    spoken = [x.spoken_text for x in numbers.with_number_words(spark.createDataFrame([(x,) for x in texts], "text string").coalesce(1)).collect()]
    assert spoken == [f"t {t['twenty']} {t['seventeen']} .", " ".join(t[w] for w in "one two three four five six seven eight".split()), f"a {t['five']} b {t['six']} {t['seven']}", f"{t['nine']} \u3000 {t['one']} {t['hundred']}", "", t["two"]]
    d = spark.createDataFrame([("no",), (None,), ("x 5",)], "text string")
    assert [tuple(x)[1:] for x in numbers.with_number_words(d).collect()] == [("no", 0, False), (None, 0, False), (f"x {t['five']}", 1, True)]
    assert all(numbers.with_number_words(d, language=x).where("changed").count() == 0 for x in ("klingon", "english"))


def test_languages(spark):
    d = spark.createDataFrame([("HIN_1",), ("eng",), ("zz_1",)], "stem string")
    assert sorted((x.code, x.name, x.recognized) for x in languages.with_language(d).collect()) == [("eng", "English", True), ("hin", "Hindi", True), ("zz", "unknown(zz)", False)]
    assert languages.forced_code("Telugu") == "tel" and languages.forced_code("french") == "fre"


def runs(levels, threshold, least):
    out, start = [], None
    for t, db in enumerate([*levels, None]):
        quiet = db is not None and db < threshold
        if quiet and start is None:
            start = t
        elif not quiet and start is not None:
            end = min(t, len(levels) - 1)
            if end - start >= least:
                out.append((float(start), float(end)))
            start = None
    return out


def test_silence_to_clips(spark):
    r = random.Random(7)
    cfg = replace(DEFAULT, min_silence_sec=2.0)
    traces = {f"f{k}": [r.choice([-60.0, -10.0]) for _ in range(r.randint(1, 60))] for k in range(25)}
    frames = spark.createDataFrame([(k, float(t), x) for k, xs in traces.items() for t, x in enumerate(xs)], "source_id string, t double, dbfs double")
    totals = spark.createDataFrame([(k, float(len(x))) for k, x in traces.items()], "source_id string, duration_sec double")
    found = seg.silence_runs(frames, cfg)
    assert sorted((x.source_id, x.run_start, x.run_end) for x in found.collect()) == sorted((k, *y) for k, x in traces.items() for y in runs(x, -38.0, 2.0))
    merged = seg.merged_pieces(seg.pieces(found, totals), cfg)
    clips = seg.padded(merged, totals, cfg)
    want = []
    for k, x in traces.items():
        edges = [0.0, *sorted((a + b) / 2 for a, b in runs(x, -38.0, 2.0)), float(len(x))]
        spans = []
        for a, b in zip(edges, edges[1:], strict=False):
            if b - a > 0.05:
                if spans and b - spans[-1][0] <= cfg.preferred_max_sec:
                    spans[-1] = (spans[-1][0], b)
                else:
                    spans.append((a, b))
        for a, b in spans:
            s, e = max(0.0, a - 0.1), min(float(len(x)), b + 0.4)
            if e - s >= 3:
                want.append((k, s, e, e - s > 20.05))
    assert sorted((x.source_id, x.start_sec, x.end_sec, x.no_pause_to_split) for x in clips.collect()) == sorted(want)


def recursive_split(w, cap, least):
    if not w or w[-1][1] - w[0][0] <= cap:
        return [w]
    best = None
    for i in range(len(w) - 1):
        gap = w[i + 1][0] - w[i][1]
        if least <= w[i][1] - w[0][0] <= cap and w[-1][1] - w[i + 1][0] >= least and gap > (best[0] if best else -1.0):
            best = (gap, i)
    return [w] if best is None else recursive_split(w[: best[1] + 1], cap, least) + recursive_split(w[best[1] + 1 :], cap, least)


def test_hard_cap_split_and_pauses(spark):
    r = random.Random(3)
    rows, words = [], {}
    for k in range(20):
        t, words[k] = 0.0, []
        for p in range(r.randint(1, 80)):
            t += r.choice([0.0, 0.1, 0.1, 1.5, 0.3])
            words[k].append((t, t + 0.5))
            rows.append((k, p, t, t + 0.5))
            t += 0.5
    d = spark.createDataFrame(rows, "group_id long, pos long, start double, end double")
    got = {}
    for x in seg.hard_cap_split(d).orderBy("group_id", "pos").collect():
        got.setdefault((x.group_id, x.chunk_no), []).append((x.start, x.end))
    assert got == {(k, n): c for k, w in words.items() for n, c in enumerate(recursive_split(w, 20.0, 3.0))}
    spans = sorted((x.group_id, x.span_no, round(x.start, 6), round(x.end, 6)) for x in seg.trimmed_pauses(d).collect())
    want = []
    for k, w in words.items():
        cursor, n = max(0.0, w[0][0] - 0.05), 0
        for (_, e), (s, _) in zip(w, w[1:], strict=False):
            if s - e > 1.2 and s - 0.2 > e + 0.2:
                want.append((k, n, round(cursor, 6), round(e + 0.2, 6)))
                cursor, n = s - 0.2, n + 1
        want.append((k, n, round(cursor, 6), round(w[-1][1] + 0.05, 6)))
    assert spans == sorted(want)


def test_leader_clusters_are_not_components(spark):
    r = random.Random(5)
    edges = {(a, b) for _ in range(160) for a, b in [sorted(r.sample(range(120), 2))]}
    used, want = set(), []
    for i in range(120):
        if i not in used:
            group = [j for j in range(i + 1, 120) if (i, j) in edges and j not in used]
            if group:
                used.update(group, [i])
                want += [(i, j) for j in group]
    for left in (200_000, 0):  # in one loop, and in rounds to the end
        got = graph.leader_clusters(spark.createDataFrame(sorted(edges), "a long, b long"), left).collect()
        assert sorted(map(tuple, got)) == sorted(want)
    assert graph.leader_clusters(spark.createDataFrame([], "a long, b long")).collect() == []


def test_registry(spark):
    r = np.random.default_rng(4)
    vectors = [v / np.linalg.norm(v) for v in r.normal(size=(60, 4))]
    rows = [(k, f"s{k}", [float(x) for x in v]) for k, v in enumerate(vectors)] + [(60, "none", None)]
    registry, want = [], []
    for k, name, v in rows:
        sims = [(float(np.dot(np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float))), -j) for j, w in registry] if v else []
        best = max(sims, default=(-2.0, 0))
        decision = "duplicate" if best[0] >= 0.9 else "review" if best[0] >= 0.6 else "new"
        want.append((k, decision, -best[1] if decision != "new" else None))
        if v and decision != "duplicate":
            registry.append((k, v))
    cfg = replace(DEFAULT, speaker_reject=0.9, speaker_review=0.6)
    d = spark.createDataFrame(rows, "seq long, source_id string, embedding array<float>")
    assert sorted((x.seq, x.decision, x.matched_seq) for x in speakers.registered(d, cfg, left=0).collect()) == want
    best = {x.seq: (x.matched_seq, round(x.similarity, 9)) for x in speakers.top_match(d, block=7).collect()}
    plain = [np.array(v, np.float32).astype(float) for v in vectors]
    assert best == {k: (-s[1], round(s[0], 9)) for k in range(1, 60) for s in [max((float(plain[k] @ plain[j]), -j) for j in range(k))]}
    out = speakers.registry_notes(speakers.registered(d, cfg))
    assert sorted((x.seq, x.decision, x.matched_seq) for x in out.collect()) == want
    assert {x.decision for x in out.where("file_reason is not null").collect()} == {"duplicate"}


def test_near_duplicates(spark):
    r = random.Random(9)
    base = ["the quick brown fox jumps over the lazy dog again and again today", "a different sentence that shares nothing much with others at all"]
    rows = []
    for k in range(40):
        t = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 3, 6])):
            t[r.randrange(len(t))] = r.choice("xyz")
        rows.append((k, f"u{k}", "".join(t), r.choice([5.0, 5.5, 7.0]), "a.wav" if k != 7 else ""))
    norm = [" ".join("".join(c for c in t if c.isalnum() or c.isspace() or c == "_").split()) for _, _, t, _, _ in rows]
    used, want = set(), []
    for i in range(40):
        if i in used or i == 7:
            continue
        group = [j for j in range(i + 1, 40) if j not in used and j != 7 and abs(rows[i][3] - rows[j][3]) <= 0.75 and SequenceMatcher(None, norm[i], norm[j]).ratio() >= 0.92]
        if group:
            used.update(group, [i])
            want += [(i, j) for j in group]
    d = spark.createDataFrame(rows, "seq long, utterance_id string, text string, duration_sec double, audio_path string").withColumns({"status": F.lit("accepted"), "rejection_reasons": F.array().cast("array<string>")})
    for sizes in ({}, {"rows": 3, "left": 0}, {"size": 200}):  # whole, and in small blocks and rounds
        found = dedup.duplicates(dedup.candidates(d), **sizes)
        assert sorted(map(tuple, found.collect())) == sorted(want)
    out = {x.seq: x for x in dedup.demoted(d, found).collect()}
    assert {k: x.rejection_reasons for k, x in out.items() if x.status == "rejected"} == {j: [f"duplicate_of:u{i}"] for i, j in want}


def test_dominance_and_overlap(spark):
    turns = spark.createDataFrame([("f", "a", 0.0, 10.0), ("f", "b", 10.0, 11.0), ("g", "a", 0.0, 5.0), ("g", "b", 5.0, 10.0), ("h", "x", 0.0, 0.0)], "source_id string, speaker string, start double, end double")
    who = speakers.dominant(turns)
    got = {x.source_id: (x.num_speakers, x.dominant_speaker, round(x.dominant_fraction, 3)) for x in who.collect()}
    assert got == {"f": (2, "a", 0.909), "g": (2, "a", 0.5), "h": (1, "x", 0.0)}
    why = who.withColumns({"speaker_ran": F.lit(True), "speaker_error": F.lit(None).cast("string")}).select("source_id", speakers.file_reason().alias("r"))
    assert {x.source_id: x.r for x in why.collect()} == {"f": None, "g": "file_level:multiple_speakers_no_dominant:2_top_0.50", "h": None}
    minority = speakers.minority_segments(turns, who)
    clips = spark.createDataFrame([("f", 0.0, 10.4), ("f", 0.0, 10.5)], "source_id string, start_sec double, end_sec double").join(minority, "source_id")
    assert sorted((x.end_sec, len(x.rejection_reasons)) for x in gates.second_speaker(gates.with_reasons(clips)).collect()) == [(10.4, 0), (10.5, 1)]


@pytest.mark.parametrize(("n", "want"), [(1, (1, 0)), (2, (2, 0)), (3, (2, 0)), (5, (4, 0)), (10, (9, 0)), (25, (22, 1)), (30, (27, 2)), (100, (90, 5))])
def test_split_sizes(n, want):
    assert reports.split_of(n) == want


def test_splits_follow_sources(spark):
    d = spark.createDataFrame([(k, f"s{k % 7}", "accepted") for k in range(50)], "seq long, source_id string, status string")
    names = [f"s{k}" for k in range(7)]
    random.Random(42).shuffle(names)
    assert {x.source_id: x.split for x in reports.source_splits(d).collect()} == {x: "train" if k < 6 else "test" for k, x in enumerate(names)}
    assert reports.hashed_splits(d).count() == 7


def test_reports(spark):
    rows = [(0, "a", "rejected", ["file_level:speaker_analysis_failed:x"], []), (1, "b", "quarantined", [], ["dnsmos:1", "clipping:1"]), (2, "b", "rejected", ["clipping:2"], ["x:1"]), (3, "c", "accepted", [], [])]
    d = spark.createDataFrame(rows, "seq long, source_id string, status string, rejection_reasons array<string>, review_reasons array<string>")
    got = {x.source_id: (x.outcome, x.file_level, x.top) for x in reports.source_outcomes(d).collect()}
    assert got == {"a": ("dropped", "speaker_analysis_failed:x", None), "b": ("held", None, "clippingx2, dnsmosx1, xx1"), "c": ("accepted", None, None)}
    label = reports.labelled(spark.createDataFrame([("dnsmos",), ("new",)], "category string")).orderBy("category").collect()
    assert label[0].label.startswith("Low audio") and label[1].label == "new"
    x = spark.range(1).select(reports.file_label(F.lit("speaker_analysis_failed:x")).alias("a"), reports.file_label(F.lit("q")).alias("b")).first()
    assert (x.a, x.b) == ("Speaker analysis could not run on this file", "q")


def test_maintenance(spark):
    d = spark.createDataFrame([("u1", "quarantined", ["clipping:1"], 0.0005), ("u2", "quarantined", ["clipping:1", "dnsmos:1"], 0.0), ("u3", "quarantined", ["clipping:1"], 0.002), ("u4", "accepted", [], None), ("u5", "quarantined", ["clipping:1"], None)], "utterance_id string, status string, review_reasons array<string>, clipped_sample_ratio double")
    assert {x.utterance_id for x in maintenance.promoted(d).where("promoted").collect()} == {"u1", "u5"}
    files = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "source_id string, utterance_id string")
    accepted = files.limit(0).unionByName(spark.createDataFrame([("a", "1")], files.schema))
    assert sorted(x.utterance_id for x in maintenance.to_package(files, accepted).collect()) == ["1", "3"]
    assert [x.utterance_id for x in maintenance.to_trim(files, accepted).collect()] == ["2"]
    once = maintenance.replaced(files, accepted)
    assert sorted(map(tuple, maintenance.replaced(once, accepted).collect())) == sorted(map(tuple, once.collect())) == [("a", "1"), ("b", "3")]


def test_background(spark):
    rows = [("a", -20.0, -40.0, 0.2, -60.0), ("b", -39.0, -40.0, 0.5, -40.5), ("c", -20.0, -40.0, 0.5, -60.0), ("d", -20.0, -55.0, 0.2, -70.0), ("e", -39.0, -40.0, 0.2, None), ("f", -20.0, -40.0, 0.7, -60.0), ("g", -47.0, -30.0, 0.2, -48.0)]
    d = spark.createDataFrame(rows, "id string, speech_level_dbfs double, clip_floor_dbfs double, flatness double, file_floor_dbfs double")
    assert {x.id: x.background_verdict for x in background.background_verdict(d).collect()} == {"a": "review", "b": "clean", "c": "clean", "d": "clean", "e": "clean", "f": "review", "g": "reject"}


def test_background_of_clips(spark):
    d = spark.createDataFrame([(0, [0.1, -0.1] * 400, 8000), (1, [], 8000), (2, None, 8000)], "id int, x array<double>, rate int")
    out = background.background_verdict(d.withColumn("b", signal.background_of("x", "rate")).select("id", "b.*", F.lit(-70.0).alias("file_floor_dbfs")))
    got = {x.id: (x.background_verdict, x.background_reasons) for x in out.collect()}
    assert got[1] == got[2] == ("reject", ["empty_audio"])
    assert got[0][0] == "review"
    quiet = spark.createDataFrame([(-47.0, -30.0, 0.2, -48.0)], "speech_level_dbfs double, clip_floor_dbfs double, flatness double, file_floor_dbfs double")
    assert background.background_verdict(quiet).first().background_reasons == ["estimated_snr_1.0dB_with_elevated_noise_floor"]


def test_bigram_ties_go_to_the_first_seen(spark):
    d = spark.createDataFrame([(2, "s", "accepted", "ba zz"), (1, "s", "accepted", "zq ba"), (0, "s", "rejected", "xx")], "seq long, source_id string, status string, text string")
    assert [(x.bigram, x.n) for x in reports.top_bigrams(d).collect()] == [("ba", 2), ("zq", 1), ("q ", 1), ("a ", 1), ("zz", 1)]
    assert [(x.bigram, x.n) for x in reports.top_bigrams(d, 2).collect()] == [("ba", 2), ("zq", 1)]
    x = reports.coverage(d).first()
    assert x.unique_letters_seen == 4 and x.letter_counts[0].letter == "z" and x.top_50_bigrams[0].n == 2


def test_signal():
    rate = 16000
    tone = np.sin(2 * np.pi * 997 * np.arange(rate * 2) / rate)
    assert abs(signal.loudness(tone, rate) - -3.01) < 0.1  # a full-scale tone near 1 kHz, by the standard
    assert abs(signal.loudness(tone * 0.1, rate) - -23.01) < 0.1
    assert signal.loudness(tone[:100], rate) is None and math.isinf(signal.loudness(tone * 0, rate))
    noise = np.random.default_rng(1).normal(size=4096)
    assert signal.flatness(tone[:512])[0] < 0.05 < 0.6 < signal.flatness(noise)[0] and signal.flatness(noise[:7])[0] == 1
    for x in (noise, noise[:200], noise[:100], np.array([0.5])):  # frame by frame, from the definition
        frames = [f for f in (x[k * 512 : (k + 1) * 512] for k in range(max(1, len(x) // 512))) if len(f) >= 256]
        spectra = [np.abs(np.fft.rfft(f * np.hanning(len(f)))) + 1e-10 for f in frames]
        want = np.mean([np.exp(np.mean(np.log(s))) / np.mean(s) for s in spectra]) if frames else 1.0
        assert abs(signal.clip_background(x, rate)[2] - want) < 1e-9
    low, high = (signal.fingerprint(np.sin(2 * np.pi * f * np.arange(rate) / rate), rate) for f in (300, 3000))
    alike = signal.fingerprint(0.9 * np.sin(2 * np.pi * 300 * np.arange(rate) / rate), rate)
    cosine = lambda a, b: float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))
    assert len(low) == 13 and cosine(low, alike) > 0.985 > cosine(low, high)
    t, db = signal.frame_levels(tone, rate)
    assert len(t) == 1 + (len(tone) - 400) // 160 and abs(db[3] - -3.01) < 0.2
    assert len(signal.padded(tone, rate, 0.5, 0.5)) == 3 * rate and len(signal.tiled(tone[:10], 25)) == 30 and len(signal.resampled(tone, rate, 8000)) == rate


def test_ratio_bounds_never_hide_a_match():
    from sonoquarry.functions import vectors

    r = random.Random(11)
    for _ in range(600):
        a = "".join(r.choice("abcd e") for _ in range(r.randint(0, 260)))
        b = list(a)
        for _ in range(r.randint(0, 8)):
            k = r.randrange(len(b) + 1)
            b[k : k + r.randint(0, 1)] = r.choice(["", "x", "ab"])
        b = "".join(b)
        shared = vectors.shared_counts([vectors.gram_codes(a), vectors.gram_codes("abcd")], [vectors.gram_codes(b)], at_once=r.choice([1, 50, 10_000]))[0, 0]
        grams = [[t[i : i + 5] for i in range(len(t) - 4)] for t in (a, b)]
        assert shared == sum(min(grams[0].count(g), grams[1].count(g)) for g in set(grams[0]))
        for least in (0.7, 0.92):
            if SequenceMatcher(None, a, b).ratio() >= least:
                assert vectors.subsequence_reaches(a, b, least)
                assert shared >= vectors.grams_needed(np.array(float(len(a))), np.array(float(len(b))), least)


def test_timestamp_lines(spark):
    d = spark.createDataFrame([("u", "f.wav", "accepted", 0.0, 4.25, 4.25, "te", " x ")], "utterance_id string, source_filename string, status string, start_sec double, end_sec double, duration_sec double, detected_language string, text string")
    assert reports.timestamp_lines(reports.timestamps(d)).first().line == "  1  00:00:00.000  00:00:04.250     4.2s   x"


def test_stt_responses(spark):
    bodies = ['{"transcript": " a ", "text": "b", "language": "te", "audio_seconds": 2, "segments": [{"start": 0, "end": 1.5, "text": "a"}]}', '{"transcript": null, "text": "b"}', '" c "', "[1]", "{}", "<html>", None]
    got = [x.r for x in spark.createDataFrame([(k, b) for k, b in enumerate(bodies)], "k int, body string").select("k", T.stt_response(F.col("body")).alias("r")).orderBy("k").collect()]
    assert [x.transcript for x in got] == ["a", "b", "c", None, None, None, None]
    assert got[0].language == "te" and got[0].audio_sec == 2.0 and got[0].segments[0].end == 1.5 and got[1].audio_sec == 0.0
    assert [x.error and x.error.split(" response")[0] for x in got] == [None, None, None, "could not find transcript in STT", "could not find transcript in STT", "STT server returned non-JSON", "STT server returned non-JSON"]


def test_title(spark):
    names = ["", "te lugu", "a-b_c'D", "ÉCOLE x1y", None]
    got = spark.createDataFrame([(k, x) for k, x in enumerate(names)], "k int, x string").select("k", T.title(F.col("x")).alias("t")).orderBy("k").collect()
    assert [x.t for x in got] == [x and x.title() for x in names]


def test_edge_checks(spark):
    rows = [("hin_normal.wav", 4, []), ("hin_corrupt.wav", 1, []), ("hin_clipped.wav", 0, ["x"]), ("hin_noisy.wav", 4, ["dnsmos"]), ("hin_twospeakers.wav", 0, ["file_level"]), ("tel_speakerX_2.wav", 0, [])]
    checked = reports.edge_checks(spark.createDataFrame(rows, "source_filename string, accepted long, categories array<string>"))
    assert {x.check for x in checked.collect() if not x.passed} == {"corrupt", "speaker first", "speaker again"}
    assert tuple(reports.edge_totals(checked).first()) == (7, 10)
