"""A whole run over small tables, and the command line over manifests."""

import json
from dataclasses import replace

from pyspark.sql import functions as F

from sonoquarry import __main__ as cli
from sonoquarry.config import DEFAULT
from sonoquarry.plans import batch


def test_run(spark):
    names = ["hin_normal", "hin_corrupt", "hin_twospeakers", "tel_x_1", "tel_x_2", "mar_done"]
    sources = spark.createDataFrame([(k, n, n, n != "hin_corrupt", True, 16000, 1, 60.0, 9999, True, None, 9999, 1.0) for k, n in enumerate(names)], "seq long, source_id string, stem string, probe_ok boolean, has_audio_stream boolean, sample_rate int, channels int, duration_sec double, size_bytes long, speaker_ran boolean, speaker_error string, size long, mtime double")
    turns = spark.createDataFrame([(n, "a", 0.0, 30.0) for n in names] + [("hin_twospeakers", "b", 30.0, 60.0), ("hin_normal", "b", 50.0, 51.0)], "source_id string, speaker string, start double, end double")
    voices = spark.createDataFrame([("hin_normal", [1.0, 0.0, 0.0]), ("tel_x_1", [0.0, 1.0, 0.0]), ("tel_x_2", [0.0, 1.0, 0.0]), ("mar_done", [0.0, 0.0, 1.0])], "source_id string, embedding array<float>")
    rows = [(k, f"{n}__{j}", n, 45.0 + 10 * j if n == "hin_normal" and j == 0 else 10.0 * j, 5.5, f"{'నమస్తే' if n.startswith('tel') else 'नमस्ते'} {n} {'same words here' if j > 1 else j}", {"hin": "hi", "tel": "te", "mar": "mr"}[n[:3]]) for k, (n, j) in enumerate((n, j) for n in names for j in range(4))]
    clips = spark.createDataFrame(rows, "seq long, utterance_id string, source_id string, start_sec double, duration_sec double, text string, detected_language string").withColumns({"end_sec": F.col("start_sec") + F.col("duration_sec"), "clipped_sample_ratio": F.lit(0.0), "dnsmos_ovrl": F.lit(3.5), "dnsmos_bak": F.lit(4.5), "language_probability": F.lit(1.0), "stt_ok": F.lit(True), "stt_error": F.lit(None).cast("string"), "audio_path": F.lit("x")})
    states = spark.createDataFrame([("mar_done", 9999, 1.0, "completed")], "source_id string, source_size long, source_mtime double, status string")
    out = batch.run(sources, turns, voices, clips, states, replace(DEFAULT, dominant_fraction=0.85))
    why = {x.source_id: x.file_reason for x in out.sources.collect()}
    assert why == {"hin_normal": None, "hin_corrupt": "file_level:integrity:probe_failed", "hin_twospeakers": "file_level:multiple_speakers_no_dominant:2_top_0.50", "tel_x_1": None, "tel_x_2": "file_level:speaker_already_in_dataset:matches_tel_x_1_sim_1.00"}
    got = {x.utterance_id: (x.status, x.rejection_reasons) for x in out.clips.collect()}
    assert got["hin_normal__0"] == ("rejected", ["clip_overlaps_second_speaker"])
    assert got["hin_normal__1"] == ("accepted", []) and got["hin_normal__2"] == ("accepted", [])
    assert got["hin_normal__3"] == ("rejected", ["duplicate_of:hin_normal__2"])
    assert sorted(k for k in got if k.endswith("__file")) == ["hin_corrupt__file", "hin_twospeakers__file", "tel_x_2__file"]
    assert not any(k.startswith("mar") for k in got) and len(got) == 8 + 3
    r = batch.all_reports(out.clips)
    assert r["dataset_summary"].first().accepted == sum(s == "accepted" for s, _ in got.values())
    assert r["dataset_split"].count() == 2


def test_command_line(spark, tmp_path, capsys):
    for s, status, reasons in (("a", "accepted", []), ("a", "quarantined", ["clipping:0.050pct_samples_clipped"]), ("b", "rejected", ["file_level:speaker_analysis_failed:x"])):
        folder = tmp_path / s / "manifests"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{status}.jsonl").write_text(json.dumps({"utterance_id": f"{s}_{status}", "text": "5 x", "duration_sec": 4.0, "start_sec": 0.0, "end_sec": 4.0, "source_filename": f"{s}.wav", "audio_path": "p", "review_reasons" if status == "quarantined" else "rejection_reasons": reasons}) + "\n")
    for command, words in (("summary", ["accepted"]), ("sources", ["dropped"]), ("quarantine", ["Audio distortion"]), ("promote", ["a_quarantined"]), ("timestamps", ["00:00:04.000"]), ("package", ["a_accepted", "b_rejected"]), ("trim", ["a_quarantined"]), ("numbers", ["3"]), ("background", ["dnsmos_bak"])):
        cli.main([command, "--results", str(tmp_path)])
        shown = capsys.readouterr().out
        assert all(w in shown for w in words), (command, shown)
    cli.main(["sources", "--results", str(tmp_path), "--empty-only", "--out", f"{tmp_path}/report"])
    assert [x.source_id for x in spark.read.json(f"{tmp_path}/report").collect()] == ["b"]
