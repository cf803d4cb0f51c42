"""A whole curation run as one plan: sources, speakers, clips, duplicates, verdicts.

File-level decisions come first and are one row per source; clips of dropped sources never reach the
gates. All inputs are tables; models have left their scores in columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonoquarry.config import DEFAULT, Config
from sonoquarry.functions.languages import with_language
from sonoquarry.operators import dedup, gates, maintenance, reports, speakers


@dataclass
class Run:
    sources: DataFrame  # one row per source with its language and file_reason
    clips: DataFrame  # judged clips, duplicates demoted, and one record for each dropped source


def judged_sources(sources: DataFrame, turns: DataFrame, voices: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Adds language, integrity_error, speaker facts, file_reason and speaker_note.

    sources: seq, source_id, stem, probe facts, speaker_ran, speaker_error. turns: source_id, speaker,
    start, end. voices: source_id, embedding. Only files that are sound so far enter the registry.
    """
    who = speakers.dominant(turns)
    out = gates.source_integrity(with_language(sources)).join(who, "source_id", "left")
    early = F.coalesce(F.concat(F.lit("file_level:integrity:"), "integrity_error"), speakers.file_reason(cfg))
    out = out.withColumn("_early", early).join(voices.select("source_id", "embedding"), "source_id", "left")
    entering = out.where("_early is null").select("seq", "source_id", "embedding")
    decided = speakers.registry_notes(speakers.registered(entering, cfg)).select("source_id", F.col("file_reason").alias("_late"), "speaker_note", "decision")
    out = out.join(decided, "source_id", "left").withColumn("file_reason", F.coalesce("_early", "_late"))
    return out.join(speakers.minority_segments(turns, who), "source_id", "left").drop("_early", "_late", "embedding")


def dropped_records(sources: DataFrame) -> DataFrame:
    """One rejected record for each source that goes whole."""
    gone = sources.where("file_reason is not null")
    empty = F.array().cast("array<string>")
    return gone.select(
        F.concat("source_id", F.lit("__file")).alias("utterance_id"), "source_id", F.lit("rejected").alias("status"), F.lit(0.0).alias("duration_sec"), F.lit("").alias("text"),
        F.array("file_reason").alias("rejection_reasons"), empty.alias("review_reasons"),
    )


def run(sources: DataFrame, turns: DataFrame, voices: DataFrame, clips: DataFrame, states: DataFrame | None = None, cfg: Config = DEFAULT, force: bool = False) -> Run:
    """clips: seq, utterance_id, source_id, times, text and scores. Sources completed before are left out."""
    if states is not None:
        sources = maintenance.to_process(sources, states, force, cfg)
    judged = judged_sources(sources, turns, voices, cfg)
    of_source = judged.where("file_reason is null").select("source_id", F.col("whisper").alias("language"), "speaker_note", "minority_segments")
    kept = gates.judged(clips.drop("language", "speaker_note", "minority_segments").join(of_source, "source_id"), cfg)
    candidates = kept.where("status = 'accepted'")
    if "audio_path" in kept.columns:
        candidates = dedup.candidates(candidates)
    final = dedup.demoted(kept, dedup.duplicates(candidates, cfg))
    return Run(judged, final.unionByName(dropped_records(judged), allowMissingColumns=True))


def all_reports(clips: DataFrame, cfg: Config = DEFAULT) -> dict[str, DataFrame]:
    """The reports that a run ends with, by name."""
    splits = reports.source_splits(clips, cfg)
    return {
        "dataset_summary": reports.summary(clips), "reason_counts": reports.reason_counts(clips), "source_outcomes": reports.source_outcomes(clips),
        "letter_coverage": reports.letters(clips), "top_bigrams": reports.top_bigrams(clips), "dataset_split": splits, "split_counts": reports.split_counts(clips, splits),
    }
