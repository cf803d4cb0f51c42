"""Quality gates: each appends reasons to a clip and leaves the verdict to `verdict`.

A gate takes a frame with rejection_reasons and review_reasons and returns it with more of them. Cheap
gates come first. A value that a skipped stage would have measured is never read: the conditions of
later gates include that no reason to reject stands yet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoquarry.config import DEFAULT, Config
from sonoquarry.functions import text as T


def with_reasons(clips: DataFrame) -> DataFrame:
    """Adds the two empty reason lists where they are missing."""
    empty = F.array().cast("array<string>")
    return clips.withColumns({c: empty for c in ("rejection_reasons", "review_reasons") if c not in clips.columns})


def unrejected() -> Column:
    return F.size("rejection_reasons") == 0


def add(clips: DataFrame, reject: list[Column] = (), review: list[Column] = ()) -> DataFrame:
    """Appends the reasons that are not null, in this order."""
    new = {}
    for name, reasons in (("rejection_reasons", reject), ("review_reasons", review)):
        if reasons:
            new[name] = F.concat(name, F.array_compact(F.array(*reasons)))
    return clips.withColumns(new)


def _text(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def _fact(clips: DataFrame, name: str, otherwise: Column) -> Column:
    return F.col(name) if name in clips.columns else otherwise


_FACTS = ("_bare", "_repeated", "_digits", "_letters", "_control")


def with_facts(clips: DataFrame) -> DataFrame:
    """Adds what several gates ask of a text, once a row: _bare (stripped), _repeated, _digits, _letters, _control.

    The one-row generator stands between these columns and the gates, so that no gate's condition
    carries the patterns again.
    """
    bare = clips.withColumn("_stripped", T.stripped(F.col("text")))
    b = F.col("_stripped")
    facts = F.struct(b.alias("_bare"), T.repeated_ngram(T.tokens(F.col("text"))).alias("_repeated"), b.rlike(T.DIGIT).alias("_digits"), b.rlike(T.LETTER).alias("_letters"), b.rlike(T.CONTROL).alias("_control"))
    return bare.select(*clips.columns, F.inline(F.array(facts)))


def settled(clips: DataFrame) -> DataFrame:
    """Computes the reasons so far once a row; gates after it see plain columns."""
    names = ["rejection_reasons", "review_reasons"]
    return clips.select(*[c for c in clips.columns if c not in names], F.inline(F.array(F.struct(*names))))


def source_integrity(sources: DataFrame) -> DataFrame:
    """Adds integrity_error: the first fault of a probed file, or null."""
    error = (
        F.when(~F.coalesce("probe_ok", F.lit(False)), "probe_failed")
        .when(~F.coalesce("has_audio_stream", F.lit(False)), "no_audio_stream")
        .when(F.coalesce("sample_rate", F.lit(0)) <= 0, "invalid_sample_rate")
        .when(F.coalesce("channels", F.lit(0)) <= 0, "invalid_channels")
        .when(F.coalesce("duration_sec", F.lit(0.0)) <= 0, "invalid_duration")
        .when(F.coalesce("size_bytes", F.lit(0)) < 1024, "file_too_small")
    )
    return sources.withColumn("integrity_error", error)


def duration(clips: DataFrame, cfg: Config = DEFAULT, column: str = "duration_sec") -> DataFrame:
    d = F.col(column)
    over = F.when(d > cfg.hard_cap_sec + cfg.duration_slack_sec, _text("exceeds_hard_cap:", T.fixed(d, 2), "s"))
    under = F.when(d < cfg.min_clip_sec - cfg.duration_slack_sec, _text("below_min_clip_duration:", T.fixed(d, 2), "s"))
    return add(clips, [over, under])


def clipping(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    r = F.col("clipped_sample_ratio")
    tail = lambda limit: f"pct_samples_clipped_gte_{limit * 100:.3f}pct" if cfg.text_first else "pct_samples_clipped"
    shown = T.fixed(r * 100, 3)
    reject = F.when(r >= cfg.clipping_reject, _text("clipping:", shown, tail(cfg.clipping_reject)))
    review = F.when((r < cfg.clipping_reject) & (r >= cfg.clipping_review), _text("clipping:", shown, tail(cfg.clipping_review)))
    return add(clips, [reject], [review])


def quality(clips: DataFrame, cfg: Config = DEFAULT, always: bool = False, background: bool = True) -> DataFrame:
    """Overall and background scores. Both look at the state before either: the second runs though the first rejects."""
    ran = F.col("dnsmos_ovrl").isNotNull() if always else F.col("dnsmos_ovrl").isNotNull() & unrejected()
    ovrl, bak = F.col("dnsmos_ovrl"), F.col("dnsmos_bak")
    reject = [F.when(ran & (ovrl < cfg.dnsmos_reject), _text("dnsmos:overall_mos_", T.fixed(ovrl, 2), f"_below_reject_{cfg.dnsmos_reject}"))]
    review = [F.when(ran & (ovrl >= cfg.dnsmos_reject) & (ovrl < cfg.dnsmos_review), _text("dnsmos:overall_mos_", T.fixed(ovrl, 2), f"_below_review_{cfg.dnsmos_review}"))]
    if background:
        reject.append(F.when(ran & (bak < cfg.bak_reject), _text("background_music_or_noise:bak_", T.fixed(bak, 2), f"_below_reject_{cfg.bak_reject}")))
        review.append(F.when(ran & (bak >= cfg.bak_reject) & (bak < cfg.bak_review), _text("background_music_or_noise:bak_", T.fixed(bak, 2), f"_below_review_{cfg.bak_review}")))
    return add(clips, reject, review)


def background_verdict_gate(clips: DataFrame) -> DataFrame:
    """Turns the reasons of a background verdict into clip reasons; off unless asked for."""
    named = F.transform("background_reasons", lambda r: F.concat(F.lit("background:"), r))
    empty = F.array().cast("array<string>")
    pick = lambda v: F.coalesce(F.when(F.col("background_verdict") == v, named), empty)
    return clips.withColumns({"rejection_reasons": F.concat("rejection_reasons", pick("reject")), "review_reasons": F.concat("review_reasons", pick("review"))})


def second_speaker(clips: DataFrame, cfg: Config = DEFAULT, start: str = "start_sec", end: str = "end_sec") -> DataFrame:
    """A clip that any single stretch of another speaker overlaps by enough; stretches are not summed."""
    hit = F.exists("minority_segments", lambda s: F.least(F.col(end), s["end"]) - F.greatest(F.col(start), s["start"]) >= cfg.minority_overlap_sec)
    return add(clips, [F.when(F.coalesce(hit, F.lit(False)), "clip_overlaps_second_speaker")])


def transcript_reasons(text: Column, detected: Column, target: Column, probability: Column, cfg: Config = DEFAULT, facts: tuple[Column, Column, Column] | None = None) -> Column:
    """Faults of a transcript, in order. facts, if known: the stripped text, whether it has letters, and control characters."""
    if facts:
        bare, letters, control = facts
        filled = bare != ""
    else:  # the text is stripped only if it has a control character, as some of them are white space
        filled, letters = text.rlike(f"[^{T.SPACE}]"), text.rlike(T.LETTER)
        control = text.rlike(T.CONTROL) & T.stripped(text).rlike(T.CONTROL)
    return F.array_compact(
        F.array(
            F.when(~filled, "empty_transcript"),
            F.when(control, "contains_control_characters"),
            F.when(filled & ~letters, "no_alphabetic_content"),
            F.when(F.coalesce(target, F.lit("")).isin("") == F.lit(False), F.when(~detected.eqNullSafe(target), _text("language_mismatch_detected_", F.coalesce(detected, F.lit("None")), "_target_", target))),
            F.when(probability < cfg.min_language_probability, _text("low_language_confidence_", T.fixed(probability, 2))),
        )
    )


def transcript(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Routes a transcript's faults. Text first: each rejects. Audio first: hard faults reject alone, else all are for review."""
    facts = (F.col("_bare"), F.col("_letters"), F.col("_control")) if "_bare" in clips.columns else None
    found = clips.withColumn("_faults", transcript_reasons(F.col("text"), F.col("detected_language"), F.col("language"), F.col("language_probability"), cfg, facts))
    named = lambda a: F.transform(a, lambda r: F.concat(F.lit("transcript:"), r))
    empty = F.array().cast("array<string>")
    if cfg.text_first:
        out = found.withColumn("rejection_reasons", F.concat("rejection_reasons", named(F.col("_faults"))))
    else:
        hard = F.filter("_faults", lambda r: r.contains("empty") | r.contains("no_alphabetic") | r.contains("control_char"))
        ran = unrejected()
        out = found.withColumns(
            {
                "rejection_reasons": F.when(ran, F.concat("rejection_reasons", named(hard))).otherwise(F.col("rejection_reasons")),
                "review_reasons": F.concat("review_reasons", F.when(ran & (F.size(hard) == 0), named(F.col("_faults"))).otherwise(empty)),
            }
        )
    return out.drop("_faults")


def digits(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Flags transcripts with digits; a reason for review on the text-first path, or if asked for."""
    out = clips.withColumn("needs_number_review", _fact(clips, "_digits", T.stripped(F.col("text")).rlike(T.DIGIT)))
    if not (cfg.text_first or cfg.transcript_digits_review):
        return out
    reason = "transcript:contains_digits_needs_manual_number_normalization_review" if cfg.text_first else "transcript:contains_digits_needs_manual_number_review"
    return add(out, review=[F.when(F.col("needs_number_review") & unrejected(), reason)])


def transcription_failed(clips: DataFrame) -> DataFrame:
    return add(clips, [F.when(unrejected() & ~F.coalesce("stt_ok", F.lit(False)), _text("stt_failed:", F.coalesce("stt_error", F.lit(""))))])


def cut_failed(clips: DataFrame) -> DataFrame:
    """A clip that could not be cut has this reason alone."""
    failed = F.col("cut_error").isNotNull()
    only = F.array(_text("cut_failed:", F.col("cut_error")))
    empty = F.array().cast("array<string>")
    return clips.withColumns({"rejection_reasons": F.when(failed, only).otherwise(F.col("rejection_reasons")), "review_reasons": F.when(failed, empty).otherwise(F.col("review_reasons"))})


def hallucination(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Decoder signals are for review; a text that repeats itself or is empty is rejected."""
    signal = lambda c, shown, sign, limit: _text(f"hallucination:whisper_window_level_signal:{shown}_", T.fixed(F.col(c), 2), f"_{sign}_{limit}")
    review = [
        F.when(F.col("no_speech_prob") >= cfg.no_speech_threshold, signal("no_speech_prob", "no_speech_prob", "gte", cfg.no_speech_threshold)),
        F.when(F.col("avg_logprob") <= cfg.avg_logprob_threshold, signal("avg_logprob", "avg_logprob", "lte", cfg.avg_logprob_threshold)),
        F.when(F.col("compression_ratio") >= cfg.compression_threshold, signal("compression_ratio", "compression_ratio", "gte", cfg.compression_threshold)),
    ]
    reject = [
        F.when(_fact(clips, "_repeated", T.repeated_ngram(T.tokens(F.col("text")))), "hallucination:repeated_ngram_pattern_detected"),
        F.when(_fact(clips, "_bare", T.stripped(F.col("text"))) == "", "hallucination:empty_transcript_text"),
    ]
    return add(clips, reject, review)


def word_confidence(words: Column) -> Column:
    """Mean probability of an array of words; 0 without any."""
    known = F.filter(F.transform(words, lambda w: w["probability"]), lambda p: p.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda s, p: s + p)
    return F.coalesce(F.when(F.size(known) > 0, total / F.size(known)), F.lit(0.0))


def chars_per_sec(text: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, F.length(text) / seconds).otherwise(F.lit(0.0))


def alignment(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """Needs mean_word_confidence and chars_per_sec."""
    c, r = F.col("mean_word_confidence"), F.col("chars_per_sec")
    reject = F.when(c < cfg.word_confidence_reject, _text("alignment:mean_word_confidence_", T.fixed(c, 2), f"_below_hard_reject_threshold_{cfg.word_confidence_reject}"))
    low = F.when((c >= cfg.word_confidence_reject) & (c < cfg.word_confidence_review), _text("alignment:mean_word_confidence_", T.fixed(c, 2), f"_below_review_threshold_{cfg.word_confidence_review}"))
    rate = F.when((r < cfg.min_chars_per_sec) | (r > cfg.max_chars_per_sec), _text("alignment:implausible_chars_per_sec_", T.fixed(r, 1), f"_expected_{cfg.min_chars_per_sec}_to_{cfg.max_chars_per_sec}"))
    return add(clips, [reject], [low, rate])


def single_speaker(clips: DataFrame, required: bool = False) -> DataFrame:
    """speaker_count is null where no check ran."""
    many = F.when(unrejected() & F.col("speaker_count").isNotNull() & (F.col("speaker_count") != 1), _text("speaker:multiple_speakers_detected_", F.col("speaker_count").cast("string")))
    unchecked = F.when(unrejected() & F.col("speaker_count").isNull(), "speaker:verification_not_run_unverified_single_speaker")
    return add(clips, [many], [unchecked] if required else [])


def borderline_speaker(clips: DataFrame) -> DataFrame:
    """A file-level note goes to every clip of the file, rejected or not."""
    return add(clips, review=[F.col("speaker_note")])


def verdict(clips: DataFrame) -> DataFrame:
    status = F.when(F.size("rejection_reasons") > 0, "rejected").when(F.size("review_reasons") > 0, "quarantined").otherwise("accepted")
    return clips.withColumns({"status": status, "needs_human_review": status == "quarantined"})


def judged(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The whole chain of gates for which clips has the columns, in the order of its path."""
    have = set(clips.columns)
    out = with_reasons(clips)
    if cfg.text_first:
        out = hallucination(with_facts(out), cfg)
        if {"mean_word_confidence", "chars_per_sec"} <= have:
            out = alignment(out, cfg)
        out = settled(duration(transcript(out, cfg), cfg))
        heard = unrejected()
        measured = {c: F.when(heard, F.col(c)) for c in ("dnsmos_ovrl", "dnsmos_bak")} | {"clipped_sample_ratio": F.when(heard, F.col("clipped_sample_ratio")).otherwise(F.lit(0.0))}
        out = quality(clipping(out.withColumns(measured), cfg), cfg, always=True, background=False)
        if "speaker_count" in have:
            out = single_speaker(out)
        return verdict(digits(settled(out), cfg)).drop(*_FACTS)
    if "minority_segments" in have:
        out = second_speaker(out, cfg)
    out = quality(clipping(duration(out, cfg), cfg), cfg)
    if "stt_ok" in have:
        out = transcription_failed(out)
    if {"background_reasons", "background_verdict"} <= have and cfg.background_gate:
        out = background_verdict_gate(out)
    out = digits(transcript(settled(out), cfg), cfg)
    if "speaker_note" in have:
        out = borderline_speaker(out)
    if "cut_error" in have:
        out = cut_failed(out)
    return verdict(out)
