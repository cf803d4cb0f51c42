"""Thresholds of the curation rules, as one frozen value that plan builders take."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    min_clip_sec: float = 3.0
    preferred_max_sec: float = 12.0
    hard_cap_sec: float = 20.0
    duration_slack_sec: float = 0.05
    clipping_reject: float = 0.001
    clipping_review: float = 0.0001
    dnsmos_reject: float = 2.5
    dnsmos_review: float = 3.0
    bak_reject: float = 3.0
    bak_review: float = 4.0
    min_language_probability: float = 0.6
    no_speech_threshold: float = 0.6
    avg_logprob_threshold: float = -1.0
    compression_threshold: float = 2.4
    word_confidence_reject: float = 0.25
    word_confidence_review: float = 0.5
    min_chars_per_sec: float = 3.0
    max_chars_per_sec: float = 25.0
    minority_overlap_sec: float = 0.5
    dominant_fraction: float = 0.85
    speaker_reject: float = 0.75
    speaker_review: float = 0.60
    silence_dbfs: float = -38.0
    min_silence_sec: float = 0.20
    start_pad_sec: float = 0.10
    end_pad_sec: float = 0.40
    max_merge_gap_sec: float = 0.6
    max_internal_pause_sec: float = 1.2
    pause_target_sec: float = 0.4
    word_pad_sec: float = 0.05
    text_similarity: float = 0.92
    audio_similarity: float = 0.985
    duration_tolerance_sec: float = 0.75
    noise_percentile: float = 0.15
    speech_percentile: float = 0.75
    snr_reject_db: float = 3.0
    music_flatness: float = 0.35
    broadband_flatness: float = 0.55
    target_lufs: float = -23.0
    max_gain_db: float = 12.0
    peak_ceiling: float = 0.999
    clip_amplitude: float = 0.998
    silence_block_dbfs: float = -45.0
    train_ratio: float = 0.9
    val_ratio: float = 0.05
    split_seed: int = 42
    mtime_slack_sec: float = 1.0
    digitwise_min_len: int = 8
    text_first: bool = False  # the transcript-first path: other gate order and formats
    transcript_digits_review: bool = False
    background_gate: bool = False  # whether a background verdict counts against its clip


DEFAULT = Config()
