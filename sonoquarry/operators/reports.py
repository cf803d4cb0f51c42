"""Reports over judged clips: summary, reasons, coverage, outcomes, histograms, timestamps, splits.

Ties in "most common" go to what came first in the input, which the clips' seq numbers carry.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonoquarry.config import DEFAULT, Config
from sonoquarry.functions import text as T

# What reason categories and whole-file reasons say to a reader.
REASON_LABELS = {
    "background_music_or_noise": "Background music or noise detected",
    "dnsmos": "Low audio quality (muffled / distorted / noisy)",
    "clipping": "Audio distortion from clipping (recorded too loud)",
    "exceeds_hard_cap": "Clip too long (speaker didn't pause; over 20s)",
    "below_min_clip_duration": "Clip too short (under 3 seconds)",
    "transcript": "Empty or unreadable transcript (no clear speech)",
    "stt_failed": "Transcription failed (server error or unsupported language)",
    "clip_overlaps_second_speaker": "A second speaker's voice appears in this clip",
    "file_level": "Whole file rejected (multiple speakers, or speaker already in dataset)",
    "speaker_borderline_match": "Possibly the same speaker as another file (needs review)",
    "cut_failed": "Could not extract the audio for this clip",
}
FILE_LABELS = {
    "multiple_speakers_no_dominant": "Multiple speakers — no single dominant speaker (looks like a conversation/interview)",
    "speaker_already_in_dataset": "This speaker already appears in another accepted file (duplicate speaker)",
    "speaker_borderline_match": "Possibly the same speaker as another file (flagged for review)",
    "speaker_analysis_failed": "Speaker analysis could not run on this file",
}


def summary(clips: DataFrame) -> DataFrame:
    """One row: counts by status, accepted seconds and hours, distinct sources."""
    of = lambda s: F.count_if(F.col("status") == s)
    seconds = F.coalesce(F.sum(F.when(F.col("status") == "accepted", F.col("duration_sec"))), F.lit(0.0))
    return clips.agg(
        of("accepted").alias("accepted"), of("quarantined").alias("quarantined"), of("rejected").alias("rejected"), F.count("*").alias("total_candidates"),
        seconds.alias("accepted_sec"), (seconds / 3600).alias("accepted_hours"), F.count_distinct("source_id").alias("unique_source_files"),
    )


def reasons(clips: DataFrame, *columns: str) -> DataFrame:
    """One row for each reason of the named lists, in order: seq, source_id, status, reason, pos."""
    both = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in columns])
    return clips.select("seq", "source_id", "status", F.posexplode(both).alias("pos", "reason"))


def told(clips: DataFrame) -> DataFrame:
    """Reasons of rejected clips, and those for review of quarantined ones, in one pass over the clips."""
    return reasons(clips.withColumn("_told", F.when(F.col("status") == "rejected", F.col("rejection_reasons")).when(F.col("status") == "quarantined", F.col("review_reasons"))), "_told")


def reason_counts(clips: DataFrame) -> DataFrame:
    """Exact reasons: those of rejected clips, and those for review of quarantined ones."""
    return told(clips).groupBy("status", "reason").agg(F.count("*").alias("n"))


def category_counts(clips: DataFrame, *by: str) -> DataFrame:
    """Categories with counts and the place where each came first."""
    return told(clips).groupBy(*by, "status", T.category(F.col("reason")).alias("category")).agg(F.count("*").alias("n"), F.min(F.struct("seq", "pos")).alias("first_seen"))


def letters(clips: DataFrame, text: str = "text") -> DataFrame:
    """Counts of letters over accepted clips."""
    c = F.explode(F.split(F.lower(text), ""))
    return clips.where("status = 'accepted'").select(c.alias("letter")).where(F.col("letter").rlike(r"^\p{L}$")).groupBy("letter").agg(F.count("*").alias("n"))


def bigrams(clips: DataFrame, text: str = "text") -> DataFrame:
    """Counts of letter pairs, and of letters before a space, over accepted clips."""
    c = F.split(F.lower(text), "")
    pairs = F.zip_with(F.slice(c, 1, F.greatest(F.size(c) - 1, F.lit(0))), F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0))), lambda a, b: F.concat(a, b))
    rows = clips.where("status = 'accepted'").where(F.length(text) > 1).select("seq", F.explode(pairs).alias("bigram"))
    return rows.where(F.col("bigram").rlike(r"^\p{L}[\p{L} ]$")).groupBy("bigram").agg(F.count("*").alias("n"), F.min("seq").alias("first_seen"))


def top_bigrams(clips: DataFrame, k: int = 50, text: str = "text") -> DataFrame:
    """The k commonest; ties go to what came first. Where in its first clip a pair stands is looked up in that clip alone."""
    first = clips.select("seq", F.lower(text).alias("_text"))
    placed = bigrams(clips, text).join(first, F.col("first_seen") == F.col("seq")).withColumn("_at", F.expr("position(bigram, _text)"))
    return placed.orderBy(F.desc("n"), "first_seen", "_at").limit(k).select("bigram", "n")


def coverage(clips: DataFrame, text: str = "text") -> DataFrame:
    """One row: the distinct letters seen, and letters and commonest bigrams with their counts, in order."""
    ranked = lambda df, c: df.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("_o"), F.col(c), F.col("n")))).alias("_l"))
    bare = lambda c: F.transform("_l", lambda x: F.struct(x[c].alias(c), x["n"].alias("n")))
    seen = ranked(letters(clips, text), "letter").select(F.size("_l").alias("unique_letters_seen"), bare("letter").alias("letter_counts"))
    pairs = ranked(top_bigrams(clips, 50, text), "bigram").select(bare("bigram").alias("top_50_bigrams"))
    return seen.join(pairs)  # one row each


def source_outcomes(clips: DataFrame, top: int = 4) -> DataFrame:
    """Per source: counts, the first whole-file reason, outcome kind, and the commonest categories if all is held."""
    of = lambda s: F.count_if(F.col("status") == s)
    counts = clips.groupBy("source_id").agg(of("accepted").alias("accepted"), of("quarantined").alias("quarantined"), of("rejected").alias("rejected"))
    whole = reasons(clips.where("status = 'rejected'"), "rejection_reasons").where(F.col("reason").startswith("file_level:"))
    whole = whole.groupBy("source_id").agg(F.min_by(F.expr("substring(reason, 12)"), F.struct("seq", "pos")).alias("file_level"))
    cats = reasons(clips.where("status <> 'accepted'"), "rejection_reasons", "review_reasons").where(~F.col("reason").startswith("file_level:"))
    cats = cats.withColumn("held", F.when(F.col("status") == "quarantined", 0).otherwise(1)).groupBy("source_id", T.category(F.col("reason")).alias("c")).agg(F.count("*").alias("n"), F.min(F.struct("held", "seq", "pos")).alias("f"))
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy(F.desc("n"), "f"))
    best = cats.withColumn("r", rank).where(F.col("r") <= top).groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("r", F.concat("c", F.lit("x"), F.col("n").cast("string")).alias("t")))).alias("l"))
    best = best.select("source_id", F.array_join(F.transform("l", lambda x: x["t"]), ", ").alias("top"))
    out = counts.join(whole, "source_id", "left").join(best, "source_id", "left")
    outcome = F.when(F.col("accepted") > 0, "accepted").when(F.col("file_level").isNotNull(), "dropped").otherwise("held")
    return out.withColumns({"outcome": outcome, "top": F.when(outcome == "held", F.coalesce("top", F.lit("unknown")))})


def drop_kinds(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("outcome = 'dropped'").groupBy(T.category(F.col("file_level")).alias("kind")).agg(F.count("*").alias("n"))


def score_histogram(clips: DataFrame, name: str, edges: list[float]) -> DataFrame:
    """lo, hi and n of scores in review reasons, empty bins with 0."""
    spark = clips.sparkSession
    bins = spark.range(len(edges) - 1).select(F.get(F.array(*[F.lit(float(x)) for x in edges]), F.col("id").cast("int")).alias("lo"), F.get(F.array(*[F.lit(float(x)) for x in edges]), (F.col("id") + 1).cast("int")).alias("hi"))
    scores = reasons(clips.where("status = 'quarantined'"), "review_reasons").select(T.score_in(F.col("reason"), name).alias("score")).where("score is not null")
    # The bin is computed, not joined by range: one small aggregate, then the few bins without scores.
    bin_of = None
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        inside = (F.col("score") >= lo) & (F.col("score") < hi)
        bin_of = F.when(inside, lo) if bin_of is None else bin_of.when(inside, lo)
    counted = scores.groupBy(bin_of.alias("lo")).agg(F.count("*").alias("n"))
    return bins.join(counted, "lo", "left").select("lo", "hi", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def what_if(clips: DataFrame, name: str, thresholds: list[float]) -> DataFrame:
    """How many scores in review reasons would pass each lower bar."""
    scores = reasons(clips.where("status = 'quarantined'"), "review_reasons").select(T.score_in(F.col("reason"), name).alias("score")).where("score is not null")
    one = scores.agg(F.count("*").alias("of"), *[F.count_if(F.col("score") >= t).alias(f"n{k}") for k, t in enumerate(thresholds)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.col(f"n{k}").alias("cleared"), F.col("of").alias("total")) for k, t in enumerate(thresholds)])).alias("x")).select("x.*")


def per_file(clips: DataFrame, key: str = "source_filename") -> DataFrame:
    """Counts by status and the sorted set of reason categories of each file."""
    both = F.concat(*[F.coalesce(c, F.array().cast("array<string>")) for c in ("rejection_reasons", "review_reasons")])
    kinds = clips.select(F.col(key), "status", F.array_sort(F.array_distinct(F.transform(both, T.category))).alias("_k"))
    few = kinds.groupBy(key, "status", "_k").agg(F.count("*").alias("n"))  # a file's clips have few sets of categories
    of = lambda s: F.coalesce(F.sum(F.when(F.col("status") == s, F.col("n"))), F.lit(0).cast("long"))
    return few.groupBy(key).agg(
        of("accepted").alias("accepted"), of("quarantined").alias("quarantined"), of("rejected").alias("rejected"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("_k")))).alias("categories"),
    )


# Files of the edge suite and what is expected of each: fixed values. Name, file, expectation, category, file to compare with.
EDGE_CHECKS = [
    ("normal", "hin_normal.wav", "some", None, None),
    ("corrupt", "hin_corrupt.wav", "none", None, None),
    ("silent", "hin_silent.wav", "none", None, None),
    ("tiny", "hin_tiny.wav", "none", None, None),
    ("clipped", "hin_clipped.wav", "reason or none", "clipping", None),
    ("noisy", "hin_noisy.wav", "reason or fewer", "dnsmos", "hin_normal.wav"),
    ("unsupported", "mar_unsupported.wav", "reason or none", "stt_failed", None),
    ("two speakers", "hin_twospeakers.wav", "reason and none", "file_level", None),
    ("speaker first", "tel_speakerX_1.wav", "some", None, None),
    ("speaker again", "tel_speakerX_2.wav", "reason and none", "file_level", None),
]


def edge_checks(files: DataFrame, checks: list[tuple] | None = None, key: str = "source_filename", most: int = 999) -> DataFrame:
    """check, file and passed over rows of `per_file`; a file without records has nothing accepted and no reasons.

    "reason or fewer" compares with another file's accepted clips, `most` if that file has no records.
    """
    checks = EDGE_CHECKS if checks is None else checks
    asked = files.sparkSession.createDataFrame(checks, "check string, file string, expected string, category string, against string")
    named = files.where(F.col(key).isin(sorted({x for c in checks for x in (c[1], c[4]) if x})))
    one = named.select(F.col(key).alias("file"), "accepted", "categories")
    other = named.select(F.col(key).alias("against"), F.col("accepted").alias("compared"))
    rows = asked.join(one, "file", "left").join(other, "against", "left")
    n, why = F.coalesce("accepted", F.lit(0)), F.coalesce(F.array_contains("categories", F.col("category")), F.lit(False))
    passed = {"some": n > 0, "none": n == 0, "reason or none": why | (n == 0), "reason or fewer": why | (n < F.coalesce("compared", F.lit(most))), "reason and none": why & (n == 0)}
    out = F.lit(None).cast("boolean")
    for expected, holds in passed.items():
        out = F.when(F.col("expected") == expected, holds).otherwise(out)
    return rows.select("check", "file", out.alias("passed"))


def edge_totals(checked: DataFrame) -> DataFrame:
    return checked.agg(F.count_if("passed").alias("passed"), F.count("*").alias("total"))


def with_digits(clips: DataFrame) -> DataFrame:
    """How many accepted clips have a digit in their text."""
    return clips.where("status = 'accepted'").agg(F.count_if(F.rlike("text", F.lit(T.DIGIT))).alias("with_digits"), F.count("*").alias("accepted"))


def first_accepted(clips: DataFrame, n: int = 200) -> DataFrame:
    """The first n accepted clips in the order of seq: a listing, so a limit is what it is."""
    return clips.where("status = 'accepted'").orderBy("seq").limit(n)


def labelled(counts: DataFrame, column: str = "category") -> DataFrame:
    """Adds the sentence for a category; unknown ones keep their code."""
    table = F.create_map(*[F.lit(x) for kv in REASON_LABELS.items() for x in kv])
    return counts.withColumn("label", F.coalesce(F.try_element_at(table, F.col(column)), F.col(column)))


def file_label(detail: Column) -> Column:
    out = None
    for prefix, label in FILE_LABELS.items():
        out = F.when(detail.startswith(prefix), label) if out is None else out.when(detail.startswith(prefix), label)
    return out.otherwise(detail)


def timestamps(clips: DataFrame) -> DataFrame:
    """Accepted clips by file and start, numbered within their file, with clock times."""
    w = Window.partitionBy("source_filename").orderBy("start_sec", "utterance_id")
    return clips.where("status = 'accepted'").select(
        F.col("utterance_id").alias("clip_id"), F.col("source_filename").alias("source_file"), F.row_number().over(w).cast("long").alias("n"), "start_sec", "end_sec",
        T.clock(F.col("start_sec")).alias("start_hms"), T.clock(F.col("end_sec")).alias("end_hms"), "duration_sec", F.col("detected_language").alias("language"), F.col("text").alias("transcript"),
    )


def timestamp_lines(numbered: DataFrame) -> DataFrame:
    """The printed form of `timestamps`: source_file, n and a line with number, start, end, length and transcript."""
    line = F.concat_ws(
        "  ", F.lpad(F.col("n").cast("string"), 3, " "), F.lpad("start_hms", 12, " "), F.lpad("end_hms", 12, " "),
        F.lpad(F.concat(T.fixed(F.col("duration_sec"), 1), F.lit("s")), 7, " "), F.concat(F.lit(" "), T.stripped(F.coalesce("transcript", F.lit("")))),
    )
    return numbered.select("source_file", "n", line.alias("line"))


def batch_rollup(plan: DataFrame, clips: DataFrame) -> DataFrame:
    """Per planned folder: clip counts and status. plan: folder, audio_files and error (null if none)."""
    of = lambda s: F.count_if(F.col("status") == s)
    counts = clips.groupBy("folder").agg(of("accepted").alias("accepted_clips"), of("quarantined").alias("quarantined_clips"), of("rejected").alias("rejected_clips"))
    out = plan.join(counts, "folder", "left").fillna(0, ["accepted_clips", "quarantined_clips", "rejected_clips"])
    return out.withColumn("status", F.when(F.col("error").isNotNull(), "error").when(F.col("audio_files") == 0, "no_audio").otherwise("done"))


def batch_totals(rollup: DataFrame) -> DataFrame:
    of = lambda s: F.count_if(F.col("status") == s)
    return rollup.agg(F.count("*").alias("folders"), of("done").alias("done"), of("no_audio").alias("no_audio"), of("error").alias("errored"), *[F.sum(c).alias(c) for c in ("accepted_clips", "quarantined_clips", "rejected_clips")])


def split_of(n: int, cfg: Config = DEFAULT) -> tuple[int, int]:
    """How many of n sources train and validate; rounding is to even, and one source at least is left for test."""
    if n <= 2:
        return n, 0
    return min(max(1, round(n * cfg.train_ratio)), n - 1), max(0, round(n * cfg.val_ratio))


def source_splits(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """source_id and split: all clips of a source go one way. Sources are shuffled by seed in order of first sight.

    The list of sources comes to the driver, as the shuffle is one sequence; use `hashed_splits` where
    sources are too many for that.
    """
    rows = clips.where("status = 'accepted'").groupBy("source_id").agg(F.min("seq").alias("s")).orderBy("s").collect()
    names = [r.source_id for r in rows]
    random.Random(cfg.split_seed).shuffle(names)
    train, val = split_of(len(names), cfg)
    data = [(x, "train" if k < train else "val" if k < train + val else "test") for k, x in enumerate(names)]
    return clips.sparkSession.createDataFrame(data, "source_id string, split string")


def hashed_splits(clips: DataFrame, cfg: Config = DEFAULT) -> DataFrame:
    """The same kind of split by a hash of the source's name: no order, nothing at the driver."""
    u = F.pmod(F.xxhash64("source_id", F.lit(cfg.split_seed)), F.lit(10_000)) / 10_000
    out = F.when(u < cfg.train_ratio, "train").when(u < cfg.train_ratio + cfg.val_ratio, "val").otherwise("test")
    return clips.where("status = 'accepted'").select("source_id").distinct().withColumn("split", out)


def split_counts(clips: DataFrame, splits: DataFrame) -> DataFrame:
    rows = clips.where("status = 'accepted'").groupBy("source_id").agg(F.count("*").alias("n")).join(splits, "source_id")
    return rows.groupBy("split").agg(F.count("*").alias("sources"), F.sum("n").alias("clips"))


def background_holds(clips: DataFrame, least: float = 0.0) -> DataFrame:
    """Quarantined clips with a background reason and their score, best first."""
    rows = clips.where("status = 'quarantined'").where(F.exists("review_reasons", lambda r: r.startswith("background_music_or_noise"))).where(F.col("dnsmos_bak") >= least)
    return rows.select("utterance_id", "source_id", "dnsmos_bak", "text").orderBy(F.desc("dnsmos_bak"), "utterance_id")
