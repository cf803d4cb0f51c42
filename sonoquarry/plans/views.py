"""Tables of the curation domain derived from the generic test tables, in Spark and as SQL CTEs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonoquarry.config import Config
from sonoquarry.operators import gates
from sonoquarry.storage import spread

#: Voiceprints of the test tables are random, so the default thresholds would never be met.
VOICES = Config(speaker_reject=0.35, speaker_review=0.25)
BLOCKS = Config(silence_dbfs=-38.0, min_silence_sec=1.0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents"), "doc_id")
    n = F.col("doc_id")
    return d.select(
        n.alias("seq"), F.concat("source", F.lit("__"), n.cast("string")).alias("utterance_id"), F.col("source").alias("source_id"), F.concat("source", F.lit(".wav")).alias("source_filename"),
        F.col("lang").alias("language"), F.when(n % 13 == 0, "xx").otherwise(F.col("lang")).alias("detected_language"), "text", (F.col("n_chars") / 100.0).alias("duration_sec"),
        ((n % 40) / 20000.0).alias("clipped_sample_ratio"), (2.0 + (n % 25) / 10.0).alias("dnsmos_ovrl"), (2.5 + (n % 21) / 10.0).alias("dnsmos_bak"),
        (((n * 37) % 100) / 100.0).alias("language_probability"), ((n % 11) / 15.0).alias("no_speech_prob"), (-(n % 13) / 10.0).alias("avg_logprob"), (1.0 + (n % 17) / 10.0).alias("compression_ratio"),
        ((n % 50) * 10.0).alias("start_sec"), ((n % 50) * 10.0 + F.col("n_chars") / 100.0).alias("end_sec"), F.when(n % 7 != 0, F.concat(F.lit("clips/"), n.cast("string"), F.lit(".wav"))).alias("audio_path"),
    )


CLIPS = """clips AS (
    SELECT doc_id AS seq, source || '__' || doc_id AS utterance_id, source AS source_id, source || '.wav' AS source_filename, lang AS language,
        CASE WHEN doc_id % 13 = 0 THEN 'xx' ELSE lang END AS detected_language, text, n_chars / 100e0 AS duration_sec,
        (doc_id % 40) / 20000e0 AS clipped_sample_ratio, 2e0 + (doc_id % 25) / 10e0 AS dnsmos_ovrl, 2.5e0 + (doc_id % 21) / 10e0 AS dnsmos_bak,
        ((doc_id * 37) % 100) / 100e0 AS language_probability, (doc_id % 11) / 15e0 AS no_speech_prob, -(doc_id % 13) / 10e0 AS avg_logprob, 1e0 + (doc_id % 17) / 10e0 AS compression_ratio,
        (doc_id % 50) * 10e0 AS start_sec, (doc_id % 50) * 10e0 + n_chars / 100e0 AS end_sec, CASE WHEN doc_id % 7 <> 0 THEN 'clips/' || doc_id || '.wav' END AS audio_path
    FROM documents)"""

_SPACE = r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def sql_reasons(*cases: str) -> str:
    return "list_filter([" + ", ".join(cases) + "]::VARCHAR[], lambda x: x IS NOT NULL)"


DURATION = ("CASE WHEN duration_sec > 20.05e0 THEN 'exceeds_hard_cap:' || printf('%.2f', duration_sec) || 's' END", "CASE WHEN duration_sec < 2.95e0 THEN 'below_min_clip_duration:' || printf('%.2f', duration_sec) || 's' END")
CLIPPING = "'clipping:' || printf('%.3f', clipped_sample_ratio * 100) || 'pct_samples_clipped'"
CLIPPING_REJECT = f"CASE WHEN clipped_sample_ratio >= 0.001e0 THEN {CLIPPING} END"
CLIPPING_REVIEW = f"CASE WHEN clipped_sample_ratio < 0.001e0 AND clipped_sample_ratio >= 0.0001e0 THEN {CLIPPING} END"
QUALITY_REJECT = ("CASE WHEN dnsmos_ovrl < 2.5e0 THEN 'dnsmos:overall_mos_' || printf('%.2f', dnsmos_ovrl) || '_below_reject_2.5' END", "CASE WHEN dnsmos_bak < 3e0 THEN 'background_music_or_noise:bak_' || printf('%.2f', dnsmos_bak) || '_below_reject_3.0' END")
QUALITY_REVIEW = ("CASE WHEN dnsmos_ovrl >= 2.5e0 AND dnsmos_ovrl < 3e0 THEN 'dnsmos:overall_mos_' || printf('%.2f', dnsmos_ovrl) || '_below_review_3.0' END", "CASE WHEN dnsmos_bak >= 3e0 AND dnsmos_bak < 4e0 THEN 'background_music_or_noise:bak_' || printf('%.2f', dnsmos_bak) || '_below_review_4.0' END")
BARE = f"regexp_replace(text, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g')"
FAULTS = sql_reasons(
    "CASE WHEN bare = '' THEN 'empty_transcript' END",
    r"CASE WHEN regexp_matches(bare, '[\x00-\x08\x0b\x0c\x0e-\x1f]') THEN 'contains_control_characters' END",
    r"CASE WHEN bare <> '' AND NOT regexp_matches(bare, '[\p{L}\p{Nl}\p{No}]') THEN 'no_alphabetic_content' END",
    "CASE WHEN language <> '' AND detected_language IS DISTINCT FROM language THEN 'language_mismatch_detected_' || detected_language || '_target_' || language END",
    "CASE WHEN language_probability < 0.6e0 THEN 'low_language_confidence_' || printf('%.2f', language_probability) END",
)
_EMPTY = "[]::VARCHAR[]"

JUDGED = f"""{CLIPS}, g1 AS (
    SELECT *, {BARE} AS bare, {sql_reasons(*DURATION, CLIPPING_REJECT)} AS j1, {sql_reasons(CLIPPING_REVIEW)} AS v1 FROM clips
), g2 AS (
    SELECT *, CASE WHEN len(j1) = 0 THEN {sql_reasons(*QUALITY_REJECT)} ELSE {_EMPTY} END AS j2, CASE WHEN len(j1) = 0 THEN {sql_reasons(*QUALITY_REVIEW)} ELSE {_EMPTY} END AS v2, {FAULTS} AS faults FROM g1
), g3 AS (
    SELECT *, list_filter(faults, lambda x: contains(x, 'empty') OR contains(x, 'no_alphabetic') OR contains(x, 'control_char')) AS hard, len(j1) + len(j2) = 0 AS heard FROM g2
), g4 AS (
    SELECT *, list_concat(j1, j2, CASE WHEN heard THEN list_transform(hard, lambda x: 'transcript:' || x) ELSE {_EMPTY} END) AS rejection_reasons,
        list_concat(v1, v2, CASE WHEN heard AND len(hard) = 0 THEN list_transform(faults, lambda x: 'transcript:' || x) ELSE {_EMPTY} END) AS review_reasons FROM g3
), judged AS (
    SELECT *, CASE WHEN len(rejection_reasons) > 0 THEN 'rejected' WHEN len(review_reasons) > 0 THEN 'quarantined' ELSE 'accepted' END AS status FROM g4
)"""


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.judged(clips(spark, sf_dir))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations laid out in time: source_id, id, start, end and decoder signals."""
    c = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("source_id"), F.col("turn").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    size, gap = F.length("text") / 15.0, (F.col("id") % 3) * 0.4
    end = F.sum(F.col("size") + F.col("gap")).over(Window.partitionBy("source_id").orderBy("id"))
    out = c.withColumns({"size": size, "gap": gap}).withColumn("end", F.round(end, 6))
    return out.select("source_id", "id", "text", F.round(F.col("end") - F.col("size"), 6).alias("start"), "end", (-(F.col("id") % 7) / 5.0).alias("avg_logprob"), ((F.col("id") % 5) / 7.0).alias("no_speech_prob"), (1.0 + (F.col("id") % 4) / 3.0).alias("compression_ratio"))


SEGMENTS = """segments AS (
    SELECT source_id, id, text, round("end" - size, 6) AS start, "end", -(id % 7) / 5e0 AS avg_logprob, (id % 5) / 7e0 AS no_speech_prob, 1e0 + (id % 4) / 3e0 AS compression_ratio FROM (
        SELECT *, round(sum(size + gap) OVER (PARTITION BY source_id ORDER BY id), 6) AS "end" FROM (
            SELECT conv_id AS source_id, turn AS id, coalesce(text, '') AS text, length(coalesce(text, '')) / 15e0 AS size, (turn % 3) * 0.4e0 AS gap FROM conversations)))"""


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of segments, evenly spaced, with a probability each."""
    s = segments(spark, sf_dir).withColumn("w", F.filter(F.split("text", r"\s+"), lambda x: x != "")).where(F.size("w") > 0)
    step = (F.col("end") - F.col("start")) / F.size("w")
    w = s.select("source_id", "id", "start", step.alias("step"), F.posexplode("w").alias("pos", "word"))
    return w.select("source_id", "id", "pos", "word", F.round(F.col("start") + F.col("pos") * F.col("step"), 6).alias("start"), F.round(F.col("start") + (F.col("pos") + 1) * F.col("step") - F.when(F.col("pos") % 9 == 8, F.least(F.lit(1.5), F.col("step") * 0.9)).otherwise(0.0), 6).alias("end"), (((F.col("pos") * 37) % 100) / 100.0).alias("probability"))


WORDS = SEGMENTS + r""", words AS (
    SELECT source_id, id, pos, word, round(start + pos * step, 6) AS start, round(start + (pos + 1) * step - CASE WHEN pos % 9 = 8 THEN least(1.5e0, step * 0.9e0) ELSE 0e0 END, 6) AS "end", ((pos * 37) % 100) / 100e0 AS probability FROM (
        SELECT source_id, id, start, ("end" - start) / len(w) AS step, unnest(range(len(w))) AS pos, unnest(w) AS word FROM (
            SELECT *, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM segments) WHERE len(w) > 0))"""


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as level traces: t counts a user's events in time, dbfs is the level of the value."""
    e = table(spark, sf_dir, "events")
    t = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return e.select(F.col("user_id").alias("source_id"), (t * 1.0).alias("t"), (20 * F.log10(F.greatest(F.col("value") / 500.0, F.lit(1e-9)))).alias("dbfs"), "value")


BLOCKS_SQL = """blocks AS (
    SELECT user_id AS source_id, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) * 1e0 AS t, 20 * log10(greatest(value / 500e0, 1e-9)) AS dbfs, value FROM events)"""


def voices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("seq"), F.concat(F.lit("voice"), F.col("vec_id").cast("string")).alias("source_id"), "embedding")


def sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sources with size and mtime, and the states of an earlier run, from orders."""
    o = table(spark, sf_dir, "orders")
    n = F.col("o_orderkey")
    files = o.select(n.alias("source_id"), (1000 + n % 5000).alias("size"), (n * 10.0).alias("mtime"))
    states = o.where(n % 3 != 0).select(n.alias("source_id"), (1000 + n % 5000 + F.when(n % 11 == 0, 1).otherwise(0)).alias("source_size"), (n * 10.0 + F.when(n % 7 == 0, 2.5).otherwise(0.5)).alias("source_mtime"), F.when(n % 5 == 0, "failed").otherwise("completed").alias("status"))
    return files, states
