"""What grows with the tables: what leaves a task, and how often a row is sent."""

import random
from dataclasses import replace
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sonoquarry.config import DEFAULT
from sonoquarry.functions import text as T
from sonoquarry.operators import dedup, gates, reports, speakers


def _texts(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    base = ["".join(r.choice("abcd ") for _ in range(r.choice([6, 60, 300]))) for _ in range(4)]
    out = []
    for _ in range(n):
        t = list(r.choice(base))
        for _ in range(r.choice([0, 1, 3])):  # stretches go, come or move
            k, m = r.randrange(len(t) + 1), r.choice([1, 2, len(t) // 12])
            part = t[k : k + m]
            del t[k : k + m]
            if r.random() < 0.6:
                k = r.randrange(len(t) + 1)
                t[k:k] = part
        out.append("".join(t))
    return out


def test_only_alike_pairs_leave_the_blocks_with_their_ratio(spark):
    texts = _texts(3, 90)
    rows = [(k, t, [3.0, 3.2, 3.9, 4.4, 9.0][k % 5]) for k, t in enumerate(texts)]
    want = {(i, j, SequenceMatcher(None, texts[i], texts[j]).ratio()) for i in range(90) for j in range(i + 1, 90) if abs(rows[i][2] - rows[j][2]) <= 0.75}
    want = {x for x in want if x[2] >= 0.92}
    assert len(want) > 50
    d = spark.createDataFrame(rows, "seq long, text string, duration_sec double")
    for rows_, size in ((None, None), (2, None), (5, 900)):
        assert {tuple(x) for x in dedup.band_pairs(d, DEFAULT, rows_, size).collect()} == want
    # In a task whose pairs are mostly alike they are left to be dealt; none is lost.
    alike = [(k, "".join(random.Random(1).choices("abcd ", k=200)) + "xyz"[k % 3], 3.0, 0) for k in range(20)]
    own = pd.DataFrame(alike, columns=["seq", "text", "duration_sec", "c"])
    out = dedup._alike_in_reach(DEFAULT, tile=8, many=40)(own, own.iloc[:0])
    assert sorted(zip(out["p"], out["q"], strict=True)) == [(i, j) for i in range(20) for j in range(i + 1, 20)]
    assert out["ratio"].isna().sum() == 64 and (out["ratio"].dropna() > 0.99).all()  # the one pair of whole tiles


def test_registry_in_batches_and_small_blocks_is_that_in_order(spark):
    r = np.random.default_rng(8)
    v = r.normal(size=(150, 4))
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)
    v[100:110] = v[3]  # ties go to the first
    cfg = replace(DEFAULT, speaker_reject=0.93, speaker_review=0.7)
    registry, want = [], {}
    for k in range(150):
        best = max(((round(float(v[k].astype(float) @ v[j].astype(float)), 9), -j) for j in registry), default=(-2.0, 0))
        want[k] = ("duplicate", -best[1]) if best[0] >= 0.93 else ("review", -best[1]) if best[0] >= 0.7 else ("new", None)
        if best[0] < 0.93:
            registry.append(k)
    d = spark.createDataFrame([(k, [float(x) for x in v[k]]) for k in range(150)], "seq long, embedding array<float>")
    for first in (20, 1000):
        assert {x.seq: (x.decision, x.matched_seq) for x in speakers.registered(d, cfg, first=first).collect()} == want


def test_top_match_gives_a_row_a_voice_and_task(spark):
    v = np.random.default_rng(2).normal(size=(3000, 4)).astype(np.float32)
    d = spark.createDataFrame([(k, [float(x) for x in v[k]]) for k in range(3000)], "seq long, embedding array<float>")
    n = speakers._met(d, None, lambda sim: sim > -np.inf, 3000, one=True).count()
    assert n == 2999  # the first has none before it


def test_fixed_is_that_of_python_without_python(spark):
    r = random.Random(6)
    xs = [0.0, -0.0, 0.125, 0.375, 1.005, 2.675, -0.001, -2.5, 0.995, 9.995, 99.9999, 1e15 + 0.125, 2.0**52 + 0.5, 2.0**53 + 2, 9e18, 1e22, 5e-324, float("inf"), float("-inf")]
    xs += [r.uniform(-30, 30) for _ in range(2000)] + [r.randrange(-4000, 4000) / 8 for _ in range(500)] + [r.randrange(-9999, 9999) / 1000 for _ in range(2000)]
    d = spark.createDataFrame([(x,) for x in [*xs, None, float("nan")]], "x double")
    for n in (1, 2, 3):
        out = d.select(T.fixed(F.col("x"), n).alias("t"))
        assert [x.t for x in out.collect()] == [f"{x:.{n}f}" for x in xs] + [None, None]
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()


def test_reports_judge_the_clips_once_without_python(spark):
    row = "seq long, utterance_id string, source_id string, source_filename string, language string, detected_language string, text string, duration_sec double, clipped_sample_ratio double, dnsmos_ovrl double, dnsmos_bak double, language_probability double"
    texts = [None, "", " \t ", "a\x01b", "\x0b a", "a\x0bb", "12 !", "fine words", " \x1c x \x1f"]
    d = gates.judged(spark.createDataFrame([(k, f"u{k}", "s", "s.wav", "en", "en", t, 5.0, 0.0, 3.5, 4.5, 0.9) for k, t in enumerate(texts)], row))
    for report in (reports.reason_counts(d), reports.category_counts(d), reports.per_file(d)):
        plan = report._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan and plan.count("LogicalRDD") == 1
    got = {x.seq: [y.removeprefix("transcript:") for y in x.rejection_reasons] for x in d.collect()}
    assert got == {0: [], 1: ["empty_transcript"], 2: ["empty_transcript"], 3: ["contains_control_characters"], 4: [], 5: ["contains_control_characters"], 6: ["no_alphabetic_content"], 7: [], 8: []}
    assert tuple(reports.per_file(d).first()) == ("s.wav", 4, 0, 5, ["transcript"])
