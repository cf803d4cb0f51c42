"""Files in, files out, and streams against their batch results."""

import json
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonoquarry import schemas
from sonoquarry.config import DEFAULT
from sonoquarry.operators import maintenance, speakers
from sonoquarry.sources import audio, manifests
from sonoquarry.streaming import streams

RATE = 8000


def tone(seconds, level=0.3):
    return level * np.sin(2 * np.pi * 440 * np.arange(int(seconds * RATE)) / RATE)


@pytest.fixture
def recordings(tmp_path):
    for folder, name, data in (("hin", "hin_1.wav", audio.wav_bytes(tone(2), RATE)), ("hin", "hin_2.WAV", audio.wav_bytes(tone(1, 1.0), RATE)), ("tel", "tel_1.wav", b"text" * 400), ("tel", "notes.md", b"x"), (".hidden", "a.wav", audio.wav_bytes(tone(1), RATE)), ("out", "b.wav", audio.wav_bytes(tone(1), RATE))):
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / name).write_bytes(data)
    return tmp_path


def test_listing_and_keys(spark, recordings):
    files = audio.listing(spark, f"{recordings}/hin")
    assert sorted(x.name for x in files.collect()) == ["hin_1.wav", "hin_2.WAV"]
    assert sorted(x.source_id for x in audio.with_keys(files).collect()) == ["hin", "hin_2"]
    assert audio.limited(files, 1).count() == 1
    paths = spark.createDataFrame([(f"/r/{f}/{k}.wav",) for f in ("a", "b", ".x", "out") for k in range(2)], "path string")
    plan = audio.folder_plan(audio.named(paths), output="out")
    assert sorted(map(tuple, plan.collect())) == [("a", 2), ("b", 2)]
    assert [x.folder for x in audio.folder_plan(audio.named(paths), "out", only=["b"]).collect()] == ["b"]


def test_probe_levels_and_cuts(spark, recordings):
    raw = spark.read.format("binaryFile").load([f"{recordings}/hin/*", f"{recordings}/tel/tel_1.wav"])
    probe = {x.path.rpartition("/")[2]: x for x in audio.probed(raw).collect()}
    assert (probe["hin_1.wav"].duration_sec, probe["hin_1.wav"].sample_rate, probe["hin_1.wav"].probe_ok) == (2.0, RATE, True)
    assert not probe["tel_1.wav"].probe_ok and probe["tel_1.wav"].error
    good = raw.where(F.lower("path").contains("hin_"))
    level = {x.path.rpartition("/")[2]: x for x in audio.levels(good, block_sec=0.5).collect()}
    assert len(level["hin_1.wav"].block_rms_dbfs) == 4 and abs(level["hin_1.wav"].rms_dbfs - 20 * np.log10(0.3 / np.sqrt(2))) < 0.05
    assert level["hin_2.WAV"].clipped_sample_ratio > 0
    spans = raw.select("path", F.expr("array(named_struct('start', 0.5D, 'end', 1.0D), named_struct('start', 1.5D, 'end', 9.0D))").alias("spans"))
    cut = {x.path.rpartition("/")[2]: x for x in audio.cuts(spans, raw).collect()}
    assert len(cut["hin_1.wav"].samples) == RATE and cut["hin_1.wav"].cut_error is None
    assert len(cut["hin_2.WAV"].samples) == RATE // 2
    assert cut["tel_1.wav"].samples is None and cut["tel_1.wav"].cut_error
    out = manifests.write_clips(audio.cuts(spans, good).withColumns({"utterance_id": F.regexp_extract("path", r"([^/]+)\.\w+$", 1), "text": F.lit("é")}), f"{recordings}/clips")
    assert out.count() == 2 and (recordings / "clips" / "hin_1.txt").read_text() == "é"


def test_manifests(spark, tmp_path):
    folder = tmp_path / "srcA" / "manifests"
    folder.mkdir(parents=True)
    row = {"utterance_id": "u1", "source_id": "srcA", "duration_sec": 4.5, "rejection_reasons": ["a:b"], "output_lufs": float("-inf")}
    (folder / "accepted.jsonl").write_text(json.dumps(row) + "\n")
    (folder / "rejected.jsonl").write_text(json.dumps(row | {"utterance_id": "u2"}) + "\n{broken\n\n")
    assert manifests.strict(spark, f"{folder}/accepted.jsonl").first().output_lufs == float("-inf")
    with pytest.raises(Exception, match="(?i)malformed"):
        manifests.strict(spark, f"{folder}/rejected.jsonl").collect()
    assert manifests.strict(spark, f"{folder}/none.jsonl").count() == 0
    both = manifests.all_manifests(spark, str(tmp_path))
    assert sorted((x.source, x.status, x.utterance_id) for x in both.collect()) == [("srcA", "accepted", "u1"), ("srcA", "rejected", "u2")]
    bad = manifests.lenient(spark, f"{folder}/rejected.jsonl", keep_bad=True).collect()
    assert [x.bad_line for x in bad if x.bad_line] == ["{broken"]
    assert manifests.lines(spark, f"{folder}/rejected.jsonl") == 2
    clips = both.drop("source").withColumns({"rejection_reasons": F.array(F.lit("x"))})
    for _ in range(2):  # written twice, there once
        manifests.write_manifests(clips, f"{tmp_path}/table")
    assert spark.read.json(f"{tmp_path}/table").count() == 2
    (tmp_path / "voices.json").write_text(json.dumps({"speakers": [{"source_id": "a", "embedding": [1, 0]}, {"source_id": "b", "embedding": [0, 1]}]}))
    assert [x.source_id for x in manifests.speakers(spark, f"{tmp_path}/voices.json").orderBy("seq").collect()] == ["a", "b"]
    (tmp_path / "t.json").write_text('{"language": "te", "segments": [{"id": 1, "words": [{"word": "x"}]}]}\nnot json\n')
    cached = manifests.transcriptions(spark, f"{tmp_path}/t.json").collect()
    assert cached[0].segments[0].words[0].probability is None and cached[1].language is None
    assert set(schemas.CLIP.split()) >= {"utterance_id", "ARRAY<STRING>,"}


def test_states_speakers_and_caches(spark, tmp_path):
    path, schema = f"{tmp_path}/states", schemas.STATE
    names = spark.createDataFrame([], schema).columns
    of = lambda rows: spark.createDataFrame([tuple({"source_id": i, "status": s}.get(c) for c in names) for i, s in rows], schema)
    got = lambda: sorted((x.source_id, x.status) for x in manifests.states(spark, path).collect())
    assert got() == []
    manifests.write_states(of([("a", "failed"), ("007", "completed")]), path)
    manifests.write_states(of([("a", "completed")]), path)
    assert got() == [("007", "completed"), ("a", "completed")]
    (tmp_path / "states").rename(tmp_path / "lost")  # a writer lost between its renames: the backup counts
    assert got() == [("007", "completed"), ("a", "failed")]
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.json").write_text(json.dumps({"source_id": "a", "status": "completed"}, indent=2))
    (tmp_path / "one" / "b.json").write_text("{broken")
    assert [x.source_id for x in manifests.states(spark, f"{tmp_path}/one/*.json").collect()] == ["a"]
    voices = spark.createDataFrame([(0, "a", [1.0, 0.0]), (1, "b", [0.0, 1.0])], schemas.VOICE)
    manifests.write_speakers(voices, f"{tmp_path}/voices")
    assert sorted(manifests.speakers(spark, f"{tmp_path}/voices").collect()) == sorted(voices.collect())
    levels = spark.createDataFrame([("007", 1), ("b", 2)], "source_id string, n_samples long")
    manifests.write_cache(levels, f"{tmp_path}/levels")
    manifests.write_cache(levels.where("source_id = 'b'").withColumn("n_samples", F.lit(5)), f"{tmp_path}/levels")
    assert sorted((x.source_id, x.n_samples) for x in manifests.cached(spark, f"{tmp_path}/levels", schemas.LEVELS).collect()) == [("007", 1), ("b", 5)]


def test_resume(spark):
    files = spark.createDataFrame([("a", 10, 5.0), ("b", 10, 5.0), ("c", 10, 5.0), ("d", 10, 5.0)], "source_id string, size long, mtime double")
    states = spark.createDataFrame([("a", 10, 5.9, "completed"), ("b", 11, 5.0, "completed"), ("c", 10, 5.0, "failed")], "source_id string, source_size long, source_mtime double, status string")
    assert sorted(x.source_id for x in maintenance.to_process(files, states).collect()) == ["b", "c", "d"]
    assert maintenance.to_process(files, states, force=True).count() == 4


def test_streams_equal_batches(spark, tmp_path):
    events = spark.range(60).select(F.timestamp_seconds(F.col("id") * 700).alias("ts"), (F.col("id") % 3).alias("user_id"), F.col("id").cast("double").alias("value"))
    events.repartition(3).write.parquet(f"{tmp_path}/in")
    schema = "ts timestamp, user_id long, value double"
    for name, plan in (("tumbling", lambda e: streams.tumbling(e, "1 hour", "user_id")), ("sliding", lambda e: streams.sliding(e, "1 hour", "30 minutes", "user_id")), ("sessions", lambda e: streams.sessions(e, "1 hour", "user_id"))):
        query = plan(streams.timed(streams.intake(spark, f"{tmp_path}/in", schema))).writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
        query.awaitTermination()
        assert sorted(map(tuple, spark.table(name).collect())) == sorted(map(tuple, plan(spark.read.parquet(f"{tmp_path}/in")).collect()))


def test_registry_stream_equals_batch(spark, tmp_path):
    r = np.random.default_rng(3)
    rows = [(k, f"s{k}", [float(x) for x in v / np.linalg.norm(v)]) for k, v in enumerate(r.normal(size=(24, 3)))]
    schema = "seq long, source_id string, embedding array<float>"
    cfg = replace(DEFAULT, speaker_reject=0.95, speaker_review=0.7)
    progress = streams.Progress()
    spark.streams.addListener(progress)
    for part in (rows[:12], rows[12:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        streams.run_available(streams.intake(spark, f"{tmp_path}/in", schema), f"{tmp_path}/state", streams.speaker_registry(f"{tmp_path}/registry", cfg))
    got = {x.seq: x.decision for x in spark.read.parquet(f"{tmp_path}/registry").collect()}
    want = {x.seq: x.decision for x in speakers.registered(spark.createDataFrame(rows, schema), cfg).collect()}
    assert got == want and set(want.values()) == {"new", "review", "duplicate"}
    spark.streams.removeListener(progress)
    assert sum(n for _, _, n, _ in progress.lines) == 24


def test_registered_voices_come_before_smaller_numbers(spark, tmp_path):
    schema = "seq long, source_id string, embedding array<float>"
    for part in ([(10, "a", [1.0, 0.0]), (11, "b", [0.0, 1.0])], [(5, "c", [1.0, 0.0]), (10, "d", [0.8, 0.6])]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        streams.run_available(streams.intake(spark, f"{tmp_path}/in", schema), f"{tmp_path}/state", streams.speaker_registry(f"{tmp_path}/registry", replace(DEFAULT, speaker_reject=0.9, speaker_review=0.7)))
    got = {(x.batch, x.seq): (x.decision, x.matched_batch, x.matched_seq) for x in spark.read.parquet(f"{tmp_path}/registry").collect()}
    assert got == {(0, 10): ("new", None, None), (0, 11): ("new", None, None), (1, 5): ("duplicate", 0, 10), (1, 10): ("review", 0, 10)}


def test_plan_falls_back_to_the_root(spark):
    none = spark.createDataFrame([], "folder string, audio_files long")
    some = spark.createDataFrame([("a", 1)], "folder string, audio_files long")
    files = spark.createDataFrame([("/r/1.wav",), ("/r/2.wav",)], "path string")
    assert [tuple(x) for x in audio.planned(none, files, "r").collect()] == [("r", 2)]
    assert [tuple(x) for x in audio.planned(some, files, "r").collect()] == [("a", 1)]
    assert audio.planned(none, files.limit(0), "r").count() == 0
