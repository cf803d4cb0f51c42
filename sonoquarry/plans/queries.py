"""One registered query per operator of the engine, with the SQL it must agree with where SQL can say it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoquarry import schemas
from sonoquarry.config import DEFAULT
from sonoquarry.functions import languages, numbers, signal
from sonoquarry.functions import text as T
from sonoquarry.functions.vectors import cosine
from sonoquarry.operators import background, dedup, gates, maintenance, reports, speakers
from sonoquarry.operators import segments as seg
from sonoquarry.plans import views as V
from sonoquarry.sources import manifests
from sonoquarry.storage import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return register


def _joined(*columns: str) -> list:
    """Reason lists as text, for comparison."""
    return [F.array_join(c, "|").alias(c) for c in columns]


_R, _V = "array_to_string(rejection_reasons, '|') AS rejection_reasons", "array_to_string(review_reasons, '|') AS review_reasons"


@query(f"WITH {V.CLIPS} SELECT utterance_id, source_id, language, duration_sec, clipped_sample_ratio, dnsmos_ovrl, dnsmos_bak FROM clips")
def q_clip_projection(spark, d):
    return V.clips(spark, d).select("utterance_id", "source_id", "language", "duration_sec", "clipped_sample_ratio", "dnsmos_ovrl", "dnsmos_bak")


@query(f"WITH {V.CLIPS} SELECT utterance_id, array_to_string({V.sql_reasons(*V.DURATION)}, '|') AS rejection_reasons FROM clips")
def q_duration_gate(spark, d):
    return gates.duration(gates.with_reasons(V.clips(spark, d))).select("utterance_id", *_joined("rejection_reasons"))


@query(f"WITH {V.CLIPS} SELECT utterance_id, array_to_string({V.sql_reasons(V.CLIPPING_REJECT)}, '|') AS rejection_reasons, array_to_string({V.sql_reasons(V.CLIPPING_REVIEW)}, '|') AS review_reasons FROM clips")
def q_clipping_gate(spark, d):
    return gates.clipping(gates.with_reasons(V.clips(spark, d))).select("utterance_id", *_joined("rejection_reasons", "review_reasons"))


@query(f"WITH {V.CLIPS} SELECT utterance_id, array_to_string({V.sql_reasons(*V.QUALITY_REJECT)}, '|') AS rejection_reasons, array_to_string({V.sql_reasons(*V.QUALITY_REVIEW)}, '|') AS review_reasons FROM clips")
def q_quality_gate(spark, d):
    return gates.quality(gates.with_reasons(V.clips(spark, d))).select("utterance_id", *_joined("rejection_reasons", "review_reasons"))


@query(f"WITH {V.CLIPS} SELECT utterance_id, array_to_string({V.FAULTS}, '|') AS faults FROM (SELECT *, {V.BARE} AS bare FROM clips)")
def q_transcript_validate(spark, d):
    faults = gates.transcript_reasons(F.col("text"), F.col("detected_language"), F.col("language"), F.col("language_probability"))
    return V.clips(spark, d).select("utterance_id", F.array_join(faults, "|").alias("faults"))


@query(rf"WITH {V.CLIPS} SELECT utterance_id, regexp_matches({V.BARE}, '\p{{Nd}}') AS needs_number_review FROM clips")
def q_number_flag(spark, d):
    return gates.digits(V.clips(spark, d)).select("utterance_id", "needs_number_review")


@query(f"WITH {V.CLIPS}, c AS (SELECT *, CASE WHEN duration_sec > 0 THEN length(text) / duration_sec ELSE 0e0 END AS r FROM clips) SELECT utterance_id, r AS chars_per_sec, CASE WHEN r < 3 OR r > 25 THEN 'alignment:implausible_chars_per_sec_' || printf('%.1f', r) || '_expected_3.0_to_25.0' ELSE '' END AS review_reasons FROM c")
def q_cps_gate(spark, d):
    c = gates.with_reasons(V.clips(spark, d)).withColumns({"chars_per_sec": gates.chars_per_sec(F.col("text"), F.col("duration_sec")), "mean_word_confidence": F.lit(1.0)})
    return gates.alignment(c).select("utterance_id", "chars_per_sec", *_joined("review_reasons"))


@query(f"WITH {V.CLIPS} SELECT utterance_id, array_to_string({V.sql_reasons(*[f'''CASE WHEN {c} {op} {limit}e0 THEN 'hallucination:whisper_window_level_signal:{c}_' || printf('%.2f', {c}) || '_{name}_{limit}' END''' for c, op, name, limit in (('no_speech_prob', '>=', 'gte', 0.6), ('avg_logprob', '<=', 'lte', -1.0), ('compression_ratio', '>=', 'gte', 2.4))])}, '|') AS review_reasons FROM clips")
def q_decoder_signals(spark, d):
    return gates.hallucination(gates.with_reasons(V.clips(spark, d))).select("utterance_id", *_joined("review_reasons"))


@query(f"WITH {V.JUDGED} SELECT utterance_id, status, {_R}, {_V} FROM judged")
def q_verdict(spark, d):
    return V.judged(spark, d).select("utterance_id", "status", *_joined("rejection_reasons", "review_reasons"))


@query(f"WITH {V.JUDGED} SELECT heard, status, count(*) AS n, count(*) FILTER (len(faults) > 0) AS faulty FROM judged GROUP BY ALL")
def q_gate_short_circuit(spark, d):
    """Transcripts of clips whose sound fails are not looked at."""
    c = gates.quality(gates.clipping(gates.duration(gates.with_reasons(V.clips(spark, d)))))
    c = c.withColumn("heard", gates.unrejected())
    faults = gates.transcript_reasons(F.col("text"), F.col("detected_language"), F.col("language"), F.col("language_probability"))
    return gates.verdict(gates.transcript(c.withColumn("faulty", F.size(faults) > 0))).groupBy("heard", "status").agg(F.count("*").alias("n"), F.count_if("faulty").alias("faulty"))


@query(f"""WITH {V.CLIPS}, f AS (SELECT *, {V.BARE} AS bare FROM clips), c AS (
    SELECT *, {V.FAULTS} AS faults, list_concat({V.sql_reasons("CASE WHEN bare = '' THEN 'x' END")}, {V.FAULTS}, {V.sql_reasons(*V.DURATION)}) AS r0,
        len({V.sql_reasons("CASE WHEN no_speech_prob >= 0.6e0 THEN 'x' END", "CASE WHEN avg_logprob <= -1e0 THEN 'x' END", "CASE WHEN compression_ratio >= 2.4e0 THEN 'x' END")}) AS v0 FROM f
), w AS (SELECT *, len(r0) = 0 AS heard, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+') AS w FROM c
), n AS (SELECT *, len(list_filter(range(1, greatest(len(w) - 7, 1)), lambda i: len(w) >= 9 AND w[i:i+2] = w[i+3:i+5] AND w[i:i+2] = w[i+6:i+8])) > 0 AS rep FROM w
), s AS (SELECT *, len(r0) + rep::INT AS nr, heard AND NOT rep AS ok FROM n)
SELECT utterance_id, CASE WHEN nr > 0 OR (ok AND (clipped_sample_ratio >= 0.001e0 OR dnsmos_ovrl < 2.5e0)) THEN 'rejected'
    WHEN v0 > 0 OR (ok AND (clipped_sample_ratio >= 0.0001e0 OR dnsmos_ovrl < 3e0 OR regexp_matches(bare, '\\p{{Nd}}'))) THEN 'quarantined' ELSE 'accepted' END AS status FROM s""".replace("\\\\", "\\"))
def q_text_first_verdict(spark, d):
    from sonoquarry.config import Config

    return gates.judged(V.clips(spark, d), Config(text_first=True)).select("utterance_id", "status")


@query(f"""WITH {V.JUDGED} SELECT count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'quarantined') AS quarantined, count(*) FILTER (status = 'rejected') AS rejected, count(*) AS total_candidates,
    round(sum(duration_sec) FILTER (status = 'accepted'), 6) AS accepted_sec, round(sum(duration_sec) FILTER (status = 'accepted') / 3600, 6) AS accepted_hours, count(DISTINCT source_id) AS unique_source_files FROM judged""")
def q_summary(spark, d):
    return reports.summary(V.judged(spark, d)).withColumns({c: F.round(c, 6) for c in ("accepted_sec", "accepted_hours")})


_REASONS = "r AS (SELECT status, source_id, seq, unnest(CASE status WHEN 'rejected' THEN rejection_reasons WHEN 'quarantined' THEN review_reasons ELSE [] END) AS reason FROM judged)"


@query(f"WITH {V.JUDGED}, {_REASONS} SELECT status, reason, count(*) AS n FROM r GROUP BY ALL")
def q_reason_counts(spark, d):
    return reports.reason_counts(V.judged(spark, d))


@query(f"WITH {V.JUDGED}, {_REASONS} SELECT status, split_part(reason, ':', 1) AS category, count(*) AS n FROM r GROUP BY ALL")
def q_category_counts(spark, d):
    return reports.category_counts(V.judged(spark, d)).drop("first_seen")


@query(f"WITH {V.JUDGED} SELECT language, status, count(*) AS n, round(sum(duration_sec), 6) AS sec FROM judged GROUP BY ALL")
def q_status_by_language(spark, d):
    return V.judged(spark, d).groupBy("language", "status").agg(F.count("*").alias("n"), F.round(F.sum("duration_sec"), 6).alias("sec"))


_FILED = V.JUDGED + """, filed AS (SELECT * REPLACE (CASE WHEN source_id IN ('src3', 'src5') AND status <> 'rejected' THEN 'rejected' ELSE status END AS status,
    CASE WHEN source_id IN ('src3', 'src5') THEN list_concat(rejection_reasons, ['file_level:' || CASE source_id WHEN 'src3' THEN 'speaker_analysis_failed:x' ELSE 'multiple_speakers_no_dominant:2_top_0.55' END]) ELSE rejection_reasons END AS rejection_reasons) FROM judged)"""


def _filed(spark, d):
    """Judged clips with two sources dropped whole."""
    c = V.judged(spark, d)
    why = F.when(F.col("source_id") == "src3", "file_level:speaker_analysis_failed:x").when(F.col("source_id") == "src5", "file_level:multiple_speakers_no_dominant:2_top_0.55")
    return gates.verdict(gates.add(c, [why]))


@query(f"""WITH {_FILED} SELECT source_id, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'quarantined') AS quarantined, count(*) FILTER (status = 'rejected') AS rejected,
    CASE WHEN count(*) FILTER (status = 'accepted') > 0 THEN 'accepted' WHEN source_id IN ('src3', 'src5') THEN 'dropped' ELSE 'held' END AS outcome FROM filed GROUP BY source_id""")
def q_source_outcome(spark, d):
    return reports.source_outcomes(_filed(spark, d)).select("source_id", "accepted", "quarantined", "rejected", "outcome")


@query("SELECT CASE source WHEN 'src3' THEN 'speaker_analysis_failed' ELSE 'multiple_speakers_no_dominant' END AS kind, count(DISTINCT source) AS n FROM documents WHERE source IN ('src3', 'src5') GROUP BY source")
def q_drop_kinds(spark, d):
    return reports.drop_kinds(reports.source_outcomes(_filed(spark, d)))


_BAK = f"{V.JUDGED}, s AS (SELECT try_cast(regexp_extract(x, 'bak_([0-9.]+)_below', 1) AS DOUBLE) AS score FROM (SELECT unnest(review_reasons) AS x FROM judged WHERE status = 'quarantined') WHERE regexp_matches(x, 'bak_([0-9.]+)_below'))"


@query(f"WITH {_BAK}, e AS (SELECT unnest([3.0, 3.25, 3.5, 3.75])::DOUBLE AS lo) SELECT lo, lo + 0.25 AS hi, count(score) AS n FROM e LEFT JOIN s ON score >= lo AND score < lo + 0.25 GROUP BY lo")
def q_bak_histogram(spark, d):
    return reports.score_histogram(V.judged(spark, d), "bak", [3.0, 3.25, 3.5, 3.75, 4.0])


@query(f"WITH {_BAK}, e AS (SELECT unnest([3.5, 3.75])::DOUBLE AS threshold) SELECT threshold, count(*) FILTER (score >= threshold) AS cleared, count(*) AS total FROM e, s GROUP BY threshold")
def q_whatif_threshold(spark, d):
    return reports.what_if(V.judged(spark, d), "bak", [3.5, 3.75])


@query(rf"WITH {V.JUDGED} SELECT letter, count(*) AS n FROM (SELECT unnest(string_split(lower(text), '')) AS letter FROM judged WHERE status = 'accepted') WHERE regexp_full_match(letter, '\p{{L}}') GROUP BY letter")
def q_letter_coverage(spark, d):
    return reports.letters(V.judged(spark, d))


@query(rf"""WITH {V.JUDGED}, c AS (SELECT seq, string_split(lower(text), '') AS c FROM judged WHERE status = 'accepted' AND length(text) > 1),
    b AS (SELECT seq, unnest(list_transform(range(1, len(c)), lambda i: {{'bigram': c[i] || c[i + 1], 'pos': i}}), recursive := true) FROM c)
    SELECT bigram, count(*) AS n FROM b WHERE regexp_full_match(bigram, '\p{{L}}[\p{{L}} ]') GROUP BY bigram ORDER BY n DESC, min(seq * 10000000 + pos) LIMIT 50""")
def q_top_bigrams(spark, d):
    return reports.top_bigrams(V.judged(spark, d))


@query(f"""WITH {V.JUDGED}, c AS (SELECT source_filename, string_agg(DISTINCT k, '|' ORDER BY k) AS categories FROM (SELECT source_filename, split_part(unnest(list_concat(rejection_reasons, review_reasons)), ':', 1) AS k FROM judged) GROUP BY 1)
    SELECT source_filename, count(*) FILTER (status = 'accepted') AS accepted, count(*) FILTER (status = 'quarantined') AS quarantined, count(*) FILTER (status = 'rejected') AS rejected, coalesce(any_value(categories), '') AS categories FROM judged LEFT JOIN c USING (source_filename) GROUP BY source_filename""")
def q_per_file_reasons(spark, d):
    return reports.per_file(V.judged(spark, d)).withColumn("categories", F.array_join("categories", "|"))


_PLAN = "plan AS (SELECT DISTINCT source AS folder, 1 AS audio_files, CASE WHEN source = 'src9' THEN 'x' END AS error FROM documents UNION ALL VALUES ('empty', 0, NULL))"


@query(f"""WITH {V.JUDGED}, {_PLAN}, c AS (SELECT source_id AS folder, count(*) FILTER (status = 'accepted') AS a, count(*) FILTER (status = 'quarantined') AS q, count(*) FILTER (status = 'rejected') AS r FROM judged GROUP BY 1)
    SELECT folder, audio_files, error, coalesce(a, 0) AS accepted_clips, coalesce(q, 0) AS quarantined_clips, coalesce(r, 0) AS rejected_clips, CASE WHEN error IS NOT NULL THEN 'error' WHEN audio_files = 0 THEN 'no_audio' ELSE 'done' END AS status FROM plan LEFT JOIN c USING (folder)""")
def q_batch_rollup(spark, d):
    c = V.judged(spark, d).withColumnRenamed("source_id", "folder")
    plan = V.table(spark, d, "documents").select(F.col("source").alias("folder")).distinct().select("folder", F.lit(1).alias("audio_files"), F.when(F.col("folder") == "src9", "x").alias("error"))
    return reports.batch_rollup(plan.unionByName(spark.range(1).selectExpr("'empty' folder", "0 audio_files", "cast(null as string) error")), c)


@query(f"""WITH {V.JUDGED}, {_PLAN} SELECT (SELECT count(*) FROM plan) AS folders, (SELECT count(*) FROM plan WHERE error IS NULL AND audio_files > 0) AS done, 1::BIGINT AS no_audio, (SELECT count(*) FROM plan WHERE error IS NOT NULL) AS errored,
    count(*) FILTER (status = 'accepted') AS accepted_clips, count(*) FILTER (status = 'quarantined') AS quarantined_clips, count(*) FILTER (status = 'rejected') AS rejected_clips FROM judged""")
def q_batch_totals(spark, d):
    return reports.batch_totals(q_batch_rollup(spark, d))


_CLOCK = "printf('%02d:%02d:%02d.%03d', (round({0} * 1000)::BIGINT // 3600000)::INT, (round({0} * 1000)::BIGINT // 60000 % 60)::INT, (round({0} * 1000)::BIGINT // 1000 % 60)::INT, (round({0} * 1000)::BIGINT % 1000)::INT)"


@query(f"WITH {V.JUDGED} SELECT utterance_id AS clip_id, source_filename AS source_file, row_number() OVER (PARTITION BY source_filename ORDER BY start_sec, utterance_id) AS n, {_CLOCK.format('start_sec')} AS start_hms, {_CLOCK.format('end_sec')} AS end_hms, duration_sec, detected_language AS language, text AS transcript FROM judged WHERE status = 'accepted'")
def q_timestamps(spark, d):
    return reports.timestamps(V.judged(spark, d)).drop("start_sec", "end_sec")


@query(f"WITH {V.JUDGED}, {_REASONS}, l AS (SELECT * FROM (VALUES {', '.join(chr(40) + chr(39) + k + chr(39) + ', ' + chr(39) + v.replace(chr(39), chr(39) * 2) + chr(39) + chr(41) for k, v in reports.REASON_LABELS.items())}) t(category, label)) SELECT category, coalesce(label, category) AS label, n FROM (SELECT split_part(reason, ':', 1) AS category, count(*) AS n FROM r GROUP BY 1) LEFT JOIN l USING (category)")
def q_reason_labels(spark, d):
    c = reports.category_counts(V.judged(spark, d)).groupBy("category").agg(F.sum("n").alias("n"))
    return reports.labelled(c)


@query(f"WITH {V.JUDGED} SELECT utterance_id, source_id, dnsmos_bak FROM judged WHERE status = 'quarantined' AND dnsmos_bak >= 3.5e0 AND len(list_filter(review_reasons, lambda x: starts_with(x, 'background_music_or_noise'))) > 0")
def q_background_holds(spark, d):
    return reports.background_holds(V.judged(spark, d), 3.5).drop("text")


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'hin' WHEN doc_id % 4 = 1 THEN 'tel' WHEN doc_id % 4 = 2 THEN 'eng' ELSE 'xx' END AS code, CASE WHEN doc_id % 4 = 0 THEN 'Hindi' WHEN doc_id % 4 = 1 THEN 'Telugu' WHEN doc_id % 4 = 2 THEN 'English' ELSE 'unknown(xx)' END AS name, doc_id % 4 <> 3 AS recognized FROM documents")
def q_language_dim(spark, d):
    stem = F.concat(F.get(F.array(*[F.lit(x) for x in ("HIN_", "tel_a_", "eng_", "xx_")]), (F.col("doc_id") % 4).cast("int")), F.col("doc_id").cast("string"))
    return languages.with_language(V.table(spark, d, "documents").select("doc_id", stem.alias("stem"))).select("doc_id", "code", "name", "recognized")


_ACC = f"{V.JUDGED}, files AS (SELECT source_id, utterance_id FROM clips WHERE audio_path IS NOT NULL), acc AS (SELECT source_id, utterance_id FROM judged WHERE status = 'accepted' AND seq % 20 < 15 AND source_id <> 'src2')"


def _files(spark, d):
    c = V.judged(spark, d)
    return V.clips(spark, d).where("audio_path is not null").select("source_id", "utterance_id"), c.where("status = 'accepted' and seq % 20 < 15 and source_id <> 'src2'").select("source_id", "utterance_id")


@query(f"WITH {_ACC} SELECT source_id, utterance_id FROM files WHERE utterance_id IN (SELECT utterance_id FROM acc) OR source_id NOT IN (SELECT source_id FROM acc)")
def q_package_semi(spark, d):
    return maintenance.to_package(*_files(spark, d))


@query(f"WITH {_ACC} SELECT source_id, utterance_id FROM files WHERE utterance_id NOT IN (SELECT utterance_id FROM clips WHERE seq % 3 = 0)")
def q_missing_transcript(spark, d):
    return maintenance.without_transcript(_files(spark, d)[0], V.clips(spark, d).where("seq % 3 = 0"))


@query(f"WITH {_ACC} SELECT source_id, utterance_id FROM files WHERE source_id IN (SELECT source_id FROM acc) AND utterance_id NOT IN (SELECT utterance_id FROM acc)")
def q_clean_anti(spark, d):
    return maintenance.to_trim(*_files(spark, d))


@query(f"WITH {V.JUDGED} SELECT utterance_id, status = 'quarantined' AND len(review_reasons) > 0 AND len(list_filter(review_reasons, lambda x: NOT starts_with(x, 'clipping'))) = 0 AND clipped_sample_ratio * 100 < 0.1e0 AS promoted FROM judged")
def q_promote_clipping(spark, d):
    return maintenance.promoted(V.judged(spark, d)).select("utterance_id", "promoted")


@query("SELECT o_orderkey AS source_id, 1000 + o_orderkey % 5000 AS size, o_orderkey * 10e0 AS mtime FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 11 = 0 OR o_orderkey % 7 = 0")
def q_resume_antijoin(spark, d):
    return maintenance.to_process(*V.sources(spark, d))


@query(f"WITH {V.SEGMENTS}, m AS (SELECT source_id, start, \"end\" FROM segments WHERE id % 4 = 3) SELECT source_id, id, EXISTS (SELECT 1 FROM m WHERE m.source_id = s.source_id AND least(s.\"end\" + 1e0, m.\"end\") - greatest(s.start, m.start) >= 0.5e0) AS overlaps FROM segments s WHERE id % 4 <> 3")
def q_interval_overlap(spark, d):
    s = V.segments(spark, d)
    turns = s.select("source_id", "start", "end", F.when(F.col("id") % 4 == 3, "b").otherwise("a").alias("speaker"))
    who = s.select("source_id").distinct().withColumn("dominant_speaker", F.lit("a"))
    c = s.where("id % 4 <> 3").withColumn("end", F.col("end") + 1.0).join(speakers.minority_segments(turns, who), "source_id", "left")
    out = gates.second_speaker(gates.with_reasons(c), start="start", end="end")
    return out.select("source_id", "id", (F.size("rejection_reasons") > 0).alias("overlaps"))


@query(f"""WITH {V.BLOCKS_SQL}, f AS (SELECT *, (t >= 5 AND t <= 20) OR (t >= 30 AND t <= 33) AS sp FROM blocks) SELECT source_id,
    round(coalesce(quantile_cont(dbfs, 0.15::DOUBLE) FILTER (NOT sp), quantile_cont(dbfs, 0.15::DOUBLE)), 6) AS noise_floor_dbfs, round(coalesce(quantile_cont(dbfs, 0.75::DOUBLE) FILTER (sp), quantile_cont(dbfs, 0.75::DOUBLE)), 6) AS speech_level_dbfs FROM f GROUP BY source_id""")
def q_noise_floor(spark, d):
    b = V.blocks(spark, d)
    regions = b.select("source_id").distinct().withColumn("regions", F.expr("array(named_struct('start', 5D, 'end', 20D), named_struct('start', 30D, 'end', 33D))"))
    out = background.noise_floor(b, regions)
    return out.select("source_id", *[F.round(c, 6).alias(c) for c in ("noise_floor_dbfs", "speech_level_dbfs")])


@query(f"WITH {V.CLIPS} SELECT utterance_id FROM clips WHERE source_id NOT IN ('src1', 'src4')")
def q_purge_source(spark, d):
    gone = spark.range(1).select(F.explode(F.array(F.lit("src1"), F.lit("src4"))).alias("source_id"))
    return maintenance.purged(V.clips(spark, d), gone).select("utterance_id")


_RUNS = f"""{V.BLOCKS_SQL}, q AS (SELECT *, dbfs < -20 AS q, lead(t) OVER w AS nt, lag(dbfs < -20, 1, false) OVER w AS pq FROM blocks WINDOW w AS (PARTITION BY source_id ORDER BY t)),
    i AS (SELECT *, sum(CASE WHEN q <> pq THEN 1 ELSE 0 END) OVER (PARTITION BY source_id ORDER BY t) AS g FROM q),
    runs AS (SELECT source_id, min(t) AS run_start, max(coalesce(nt, t)) AS run_end FROM i WHERE q GROUP BY source_id, g HAVING max(coalesce(nt, t)) - min(t) >= 1)"""


def _runs(spark, d):
    from dataclasses import replace

    return seg.silence_runs(V.blocks(spark, d), replace(V.BLOCKS, silence_dbfs=-20.0))


def _totals(spark, d):
    return V.blocks(spark, d).groupBy("source_id").agg((F.max("t") + 1.0).alias("duration_sec"))


@query(f"WITH {_RUNS} SELECT source_id, run_start, run_end, (run_start + run_end) / 2 AS cut FROM runs")
def q_silence_islands(spark, d):
    return _runs(spark, d)


_PIECES = f"""{_RUNS}, tot AS (SELECT source_id, max(t) + 1e0 AS total FROM blocks GROUP BY 1), e AS (SELECT source_id, (run_start + run_end) / 2 AS s FROM runs UNION ALL SELECT source_id, 0e0 FROM tot UNION ALL SELECT source_id, total FROM tot),
    pieces AS (SELECT * FROM (SELECT source_id, s AS start, lead(s) OVER (PARTITION BY source_id ORDER BY s) AS "end" FROM e) WHERE "end" - start > 0.05)"""


@query(f"WITH {_PIECES} SELECT source_id, start, \"end\" FROM pieces")
def q_cut_pieces(spark, d):
    return seg.pieces(_runs(spark, d), _totals(spark, d))


_MERGE = f"""RECURSIVE {_PIECES}, num AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY start) AS i FROM pieces),
    walk AS (SELECT source_id, i, start AS s, "end" AS e, 1 AS g FROM num WHERE i = 1 UNION ALL
        SELECT n.source_id, n.i, CASE WHEN n."end" - w.s <= 12 THEN w.s ELSE n.start END, n."end", CASE WHEN n."end" - w.s <= 12 THEN w.g ELSE w.g + 1 END FROM walk w JOIN num n ON n.source_id = w.source_id AND n.i = w.i + 1),
    merged AS (SELECT source_id, min(s) AS start, max(e) AS "end" FROM walk GROUP BY source_id, g)"""


@query(f"WITH {_MERGE} SELECT source_id, start, \"end\" FROM merged")
def q_greedy_merge(spark, d):
    return seg.merged_pieces(seg.pieces(_runs(spark, d), _totals(spark, d)))


@query(f"WITH {_MERGE} SELECT source_id, start_sec, end_sec, round(end_sec - start_sec, 6) AS duration_sec, end_sec - start_sec > 20.05 AS no_pause_to_split FROM (SELECT m.source_id, greatest(0e0, start - 0.1e0) AS start_sec, least(total, \"end\" + 0.4e0) AS end_sec FROM merged m JOIN tot USING (source_id)) WHERE end_sec - start_sec >= 3")
def q_pad_filter(spark, d):
    merged = seg.merged_pieces(seg.pieces(_runs(spark, d), _totals(spark, d)))
    return seg.padded(merged, _totals(spark, d)).withColumn("duration_sec", F.round("duration_sec", 6))


_SEGMERGE = f"""RECURSIVE {V.SEGMENTS}, num AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY id) AS i FROM segments),
    walk AS (SELECT source_id, id, i, start AS f, "end" AS l, 1 AS g FROM num WHERE i = 1 UNION ALL
        SELECT n.source_id, n.id, n.i, CASE WHEN n.start - w.l <= 0.6e0 AND n."end" - w.f <= 12 THEN w.f ELSE n.start END, n."end", CASE WHEN n.start - w.l <= 0.6e0 AND n."end" - w.f <= 12 THEN w.g ELSE w.g + 1 END FROM walk w JOIN num n ON n.source_id = w.source_id AND n.i = w.i + 1)"""


@query(f"WITH {_SEGMERGE} SELECT source_id, id, g::BIGINT AS group_no FROM walk")
def q_segment_merge(spark, d):
    return seg.merged_segments(V.segments(spark, d)).select("source_id", "id", "group_no")


@query(f"""WITH {_SEGMERGE} SELECT source_id, g::BIGINT AS group_no, count(*) AS n_segments, round(sum(avg_logprob * greatest(0.001e0, "end" - start)) / sum(greatest(0.001e0, "end" - start)), 6) AS avg_logprob, max(no_speech_prob) AS no_speech_prob, max(compression_ratio) AS compression_ratio
    FROM walk JOIN segments USING (source_id, id) GROUP BY source_id, g""")
def q_weighted_stats(spark, d):
    out = seg.group_stats(seg.merged_segments(V.segments(spark, d)))
    return out.select("source_id", "group_no", "n_segments", F.round("avg_logprob", 6).alias("avg_logprob"), "no_speech_prob", "compression_ratio")


def _grouped_words(spark, d):
    key = F.concat_ws("-", F.col("source_id").cast("string"), F.col("id").cast("string"))
    return V.words(spark, d).withColumn("group_id", key)


@query(f"""WITH {V.WORDS}, n AS (SELECT *, source_id || '-' || id AS group_id, lead(start) OVER w - "end" > 1.2e0 AND lead(start) OVER w - 0.2e0 > "end" + 0.2e0 AS cut FROM words WINDOW w AS (PARTITION BY source_id, id ORDER BY pos)),
    s AS (SELECT *, sum(coalesce(b, 0)) OVER (PARTITION BY group_id ORDER BY pos) AS span_no FROM (SELECT *, lag(coalesce(cut, false)::INT, 1, 0) OVER (PARTITION BY group_id ORDER BY pos) AS b FROM n))
    SELECT group_id, span_no::BIGINT AS span_no, round(CASE WHEN span_no = 0 THEN greatest(0e0, arg_min(start, pos) - 0.05e0) ELSE arg_min(start, pos) - 0.2e0 END, 6) AS start, round(arg_max("end", pos) + CASE WHEN max(coalesce(cut, false)::INT) = 1 THEN 0.2e0 ELSE 0.05e0 END, 6) AS "end" FROM s GROUP BY group_id, span_no""")
def q_pause_trim(spark, d):
    out = seg.trimmed_pauses(_grouped_words(spark, d))
    return out.select("group_id", F.col("span_no").cast("long").alias("span_no"), F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


@query()
def q_hardcap_split(spark, d):
    return seg.hard_cap_split(_grouped_words(spark, d))


@query(rf"""WITH {V.CLIPS}, w AS (SELECT utterance_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM clips)
    SELECT utterance_id, len(list_filter(range(1, greatest(len(w) - 7, 1)), lambda i: len(w) >= 9 AND w[i:i+2] = w[i+3:i+5] AND w[i:i+2] = w[i+6:i+8])) > 0 AS repeated FROM w""")
def q_repeated_ngram(spark, d):
    return V.clips(spark, d).select("utterance_id", T.repeated_ngram(T.tokens(F.col("text"))).alias("repeated"))


@query(f"WITH {V.WORDS} SELECT source_id, id, round(avg(probability), 6) AS mean_word_confidence, CASE WHEN avg(probability) < 0.25 THEN 'reject' WHEN avg(probability) < 0.5 THEN 'review' ELSE 'ok' END AS level FROM words GROUP BY source_id, id")
def q_word_confidence(spark, d):
    c = V.words(spark, d).groupBy("source_id", "id").agg(F.avg("probability").alias("c"))
    level = F.when(F.col("c") < DEFAULT.word_confidence_reject, "reject").when(F.col("c") < DEFAULT.word_confidence_review, "review").otherwise("ok")
    return c.select("source_id", "id", F.round("c", 6).alias("mean_word_confidence"), level.alias("level"))


_NORM = rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(text), '^[{V._SPACE}]+|[{V._SPACE}]+$', '', 'g'), '[^\p{{L}}\p{{N}}_{V._SPACE}]', '', 'g'), '[{V._SPACE}]+', ' ', 'g'))"


@query(f"WITH {V.CLIPS} SELECT utterance_id, md5({_NORM}) AS norm_md5 FROM clips")
def q_norm_text(spark, d):
    return V.clips(spark, d).select("utterance_id", F.md5(F.trim(T.dedup_text(F.col("text"))).cast("binary")).alias("norm_md5"))


@query(f"WITH {V.CLIPS}, n AS (SELECT seq, {_NORM} AS t FROM clips) SELECT min(seq) AS canonical, count(*) AS copies FROM n GROUP BY t HAVING count(*) > 1")
def q_exact_dups(spark, d):
    key = F.sha2(F.trim(T.dedup_text(F.col("text"))).cast("binary"), 256)
    return V.clips(spark, d).groupBy(key.alias("k")).agg(F.min("seq").alias("canonical"), F.count("*").alias("copies")).where("copies > 1").select("canonical", "copies")


@query()
def q_near_dups(spark, d):
    return dedup.duplicates(V.clips(spark, d))


@query()
def q_dedup_demote(spark, d):
    c = gates.with_reasons(V.clips(spark, d)).withColumn("status", F.lit("accepted"))
    found = dedup.duplicates(dedup.candidates(c))
    return dedup.demoted(c, found).select("utterance_id", "status", *_joined("rejection_reasons"))


_PAIRS = "v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), p AS (SELECT a.vec_id AS later, b.vec_id AS earlier, list_dot_product(a.e, b.e) AS sim FROM v a JOIN v b ON b.vec_id < a.vec_id)"


@query(f"WITH {_PAIRS} SELECT later AS seq, arg_max(earlier, (round(sim, 9), -earlier)) AS matched_seq, round(max(sim), 6) AS similarity FROM p GROUP BY later")
def q_speaker_topmatch(spark, d):
    return speakers.top_match(V.voices(spark, d)).withColumn("similarity", F.round("similarity", 6))


@query()
def q_speaker_registry(spark, d):
    return speakers.registered(V.voices(spark, d), V.VOICES).select("seq", "decision", "matched_seq", F.round("similarity", 6).alias("similarity"))


@query("""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings) SELECT a.vec_id AS seq, round(list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))), 6) AS cos FROM v a JOIN v b ON b.vec_id = a.vec_id + 1""")
def q_cosine(spark, d):
    v = V.voices(spark, d).select("seq", "embedding")
    following = v.select((F.col("seq") - 1).alias("seq"), F.col("embedding").alias("other"))
    return v.join(following, "seq").select("seq", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("cos"))


@query(f"""WITH {V.SEGMENTS}, t AS (SELECT source_id, 'sp' || id % 3 AS speaker, sum("end" - start) AS talk, min(start) AS seen FROM segments GROUP BY ALL)
    SELECT source_id, count(*) AS num_speakers, arg_max(speaker, (talk, -seen)) AS dominant_speaker, round(max(talk) / CASE WHEN sum(talk) = 0 THEN 1e0 ELSE sum(talk) END, 6) AS dominant_fraction FROM t GROUP BY source_id""")
def q_dominant_speaker(spark, d):
    turns = V.segments(spark, d).withColumn("speaker", F.concat(F.lit("sp"), (F.col("id") % 3).cast("string")))
    return speakers.dominant(turns).withColumn("dominant_fraction", F.round("dominant_fraction", 6))


@query(rf"WITH {V.CLIPS} SELECT utterance_id, len(regexp_extract_all(text, '\p{{Nd}}+')) AS numbers_found, regexp_matches(text, '\p{{Nd}}') AS changed FROM clips")
def q_number_words(spark, d):
    return numbers.with_number_words(V.clips(spark, d)).select("utterance_id", F.col("numbers_found").cast("long").alias("numbers_found"), "changed")


@query(rf"WITH {V.CLIPS}, n AS (SELECT len(regexp_extract_all(text, '\p{{Nd}}+')) AS n FROM clips) SELECT count(*) AS scanned, count(*) FILTER (n > 0) AS with_numbers, count(*) FILTER (n > 0) AS changed, sum(n)::BIGINT AS numbers_converted FROM n")
def q_translit_stats(spark, d):
    return maintenance.number_stats(V.clips(spark, d))


@query()
def q_source_split(spark, d):
    return reports.source_splits(V.judged(spark, d))


@query(f"WITH {V.JUDGED}, n AS (SELECT count(DISTINCT source_id) AS n, count(*) AS clips FROM judged WHERE status = 'accepted') SELECT n AS sources, clips FROM n")
def q_split_totals(spark, d):
    c = V.judged(spark, d)
    return reports.split_counts(c, reports.source_splits(c)).agg(F.sum("sources").alias("sources"), F.sum("clips").alias("clips"))


_SAMPLES = "s AS (SELECT user_id AS source_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i, value / 500e0 - 0.5e0 AS x FROM events)"


def _samples(spark, d):
    return V.blocks(spark, d).select("source_id", F.col("t").cast("long").alias("i"), (F.col("value") / 500.0 - 0.5).alias("x"))


@query(f"WITH {_SAMPLES} SELECT source_id, i // 8 AS block, round(20 * log10(greatest(sqrt(avg(x * x) + 1e-12), 1e-9)), 6) AS dbfs, count(*) AS n FROM s GROUP BY ALL")
def q_block_rms(spark, d):
    return background.block_levels(_samples(spark, d), 8).withColumn("dbfs", F.round("dbfs", 6))


@query(f"WITH {_SAMPLES} SELECT source_id, count(*) AS n_samples, round(20 * log10(greatest(sqrt(sum(x * x) / count(*) + 1e-12), 1e-9)), 6) AS rms_dbfs, round(20 * log10(greatest(max(abs(x)), 1e-9)), 6) AS peak_dbfs, round(avg(CASE WHEN abs(x) >= 0.998e0 THEN 1e0 ELSE 0e0 END), 6) AS clipped_sample_ratio FROM s GROUP BY source_id")
def q_file_levels(spark, d):
    out = background.file_levels(_samples(spark, d))
    return out.select("source_id", "n_samples", *[F.round(c, 6).alias(c) for c in ("rms_dbfs", "peak_dbfs", "clipped_sample_ratio")])


_BACK = "c AS (SELECT doc_id, -30e0 + doc_id % 17 AS sp, -60e0 + doc_id % 37 AS own, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE -65e0 + doc_id % 5 END AS ff, (doc_id % 20) / 20e0 AS fl FROM documents), r AS (SELECT *, coalesce(own > ff + 12 AND own > -50, false) AS up, sp - coalesce(ff, own) AS snr FROM c)"


@query(f"WITH {_BACK} SELECT doc_id, snr AS est_snr_db, CASE WHEN snr < 3 AND up THEN 'reject' WHEN up AND (fl < 0.35e0 OR fl > 0.55e0) THEN 'review' ELSE 'clean' END AS background_verdict FROM r")
def q_background_verdict(spark, d):
    n = F.col("doc_id")
    c = V.table(spark, d, "documents").select("doc_id", (-30.0 + n % 17).alias("speech_level_dbfs"), (-60.0 + n % 37).alias("clip_floor_dbfs"), F.when(n % 9 != 0, -65.0 + n % 5).alias("file_floor_dbfs"), ((n % 20) / 20.0).alias("flatness"))
    return background.background_verdict(c).select("doc_id", "est_snr_db", "background_verdict")


@query("WITH c AS (SELECT doc_id, -40e0 + doc_id % 30 AS l, (1 + doc_id % 10) / 10e0 AS p FROM documents), g AS (SELECT *, greatest(-12e0, least(12e0, -23e0 - l)) AS w FROM c), k AS (SELECT *, p * pow(10e0, w / 20) AS pk FROM g) SELECT doc_id, round(w + CASE WHEN pk > 0.999e0 THEN 20 * log10(0.999e0 / pk) ELSE 0e0 END, 6) AS gain_db FROM k")
def q_loudness_gain(spark, d):
    n = F.col("doc_id")
    c = V.table(spark, d, "documents").select("doc_id", (-40.0 + n % 30).alias("input_lufs"), ((1 + n % 10) / 10.0).alias("peak"))
    return background.gain(c).select("doc_id", F.round("gain_db", 6).alias("gain_db"))


@query()
def q_integrated_loudness(spark, d):
    """Loudness and background of short tones, one for each nation."""
    tone = F.transform(F.sequence(F.lit(0), F.lit(3999)), lambda i: F.sin(i * (0.05 + F.col("n_nationkey") * 0.01)) * 0.4)
    t = V.table(spark, d, "nation").repartition(8, "n_nationkey").select("n_nationkey", tone.alias("x"), F.lit(8000).alias("rate"))
    out = t.withColumns({"lufs": signal.loudness_of("x", "rate"), "b": signal.background_of("x", "rate")})
    return out.select("n_nationkey", F.round("lufs", 4).alias("lufs"), F.round("b.speech_level_dbfs", 4).alias("speech_level_dbfs"), F.round("b.flatness", 6).alias("flatness"))


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def q_tumbling_windows(spark, d):
    from sonoquarry.streaming import streams

    out = streams.tumbling(V.table(spark, d, "events"), "1 hour", "event_type")
    return out.select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOUR THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
    SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def q_session_windows(spark, d):
    from sonoquarry.streaming import streams

    out = streams.sessions(V.table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "6 hours", "user_id")
    return out.select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query(rf"WITH {V.JUDGED} SELECT count(*) FILTER (regexp_matches(text, '\p{{Nd}}')) AS with_digits, count(*) AS accepted FROM judged WHERE status = 'accepted'")
def q_accepted_with_digits(spark, d):
    return reports.with_digits(V.judged(spark, d))


@query(f"WITH {V.JUDGED} SELECT utterance_id, text FROM judged WHERE status = 'accepted' ORDER BY seq LIMIT 200")
def q_first_accepted(spark, d):
    return reports.first_accepted(V.judged(spark, d)).select("utterance_id", "text")


_CHECKS = [("a", "src1", "some", None, None), ("b", "src2", "none", None, None), ("c", "src3", "reason or none", "clipping", None), ("d", "src4", "reason or fewer", "too_short", "src1"), ("e", "src5", "reason and none", "file_level", None), ("f", "absent", "none", None, None)]


@query(f"""WITH {V.JUDGED}, f AS (SELECT source_id, count(*) FILTER (status = 'accepted') AS n, count(*) FILTER (len(list_filter(list_concat(rejection_reasons, review_reasons), lambda x: split_part(x, ':', 1) = 'clipping')) > 0) AS clipping,
    count(*) FILTER (len(list_filter(list_concat(rejection_reasons, review_reasons), lambda x: split_part(x, ':', 1) = 'too_short')) > 0) AS too_short, count(*) FILTER (len(list_filter(list_concat(rejection_reasons, review_reasons), lambda x: split_part(x, ':', 1) = 'file_level')) > 0) AS file_level FROM judged GROUP BY source_id),
    g AS (SELECT coalesce(max(n) FILTER (source_id = 'src1'), 0) AS n1, coalesce(max(n) FILTER (source_id = 'src1'), 999) AS most, coalesce(max(n) FILTER (source_id = 'src2'), 0) AS n2, coalesce(max(n) FILTER (source_id = 'src3'), 0) AS n3, coalesce(max(clipping) FILTER (source_id = 'src3'), 0) AS c3,
    coalesce(max(n) FILTER (source_id = 'src4'), 0) AS n4, coalesce(max(too_short) FILTER (source_id = 'src4'), 0) AS s4, coalesce(max(n) FILTER (source_id = 'src5'), 0) AS n5, coalesce(max(file_level) FILTER (source_id = 'src5'), 0) AS f5 FROM f)
    SELECT unnest([{{'check': 'a', 'passed': n1 > 0}}, {{'check': 'b', 'passed': n2 = 0}}, {{'check': 'c', 'passed': c3 > 0 OR n3 = 0}}, {{'check': 'd', 'passed': s4 > 0 OR n4 < most}}, {{'check': 'e', 'passed': f5 > 0 AND n5 = 0}}, {{'check': 'f', 'passed': true}}], recursive := true) FROM g""")
def q_edge_checks(spark, d):
    return reports.edge_checks(reports.per_file(V.judged(spark, d), "source_id"), _CHECKS, "source_id").select("check", "passed")


_SAID = r"regexp_replace(coalesce(text, ''), '^\s+|\s+$', '', 'g')"


@query(f"""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN {_SAID} WHEN 1 THEN {_SAID} WHEN 2 THEN 'a bare reply' END AS transcript, CASE doc_id % 4 WHEN 0 THEN coalesce(lang, '') WHEN 1 THEN '' WHEN 2 THEN '' END AS language,
    CASE doc_id % 4 WHEN 0 THEN n_chars::DOUBLE WHEN 1 THEN 0.0 WHEN 2 THEN 0.0 END AS audio_sec, CASE WHEN doc_id % 4 = 3 THEN 'STT server returned non-JSON response: <' || substring(coalesce(text, ''), 1, 199) END AS error FROM documents""")
def q_stt_response(spark, d):
    text = F.coalesce("text", F.lit(""))
    reply = F.when(F.col("doc_id") % 4 == 0, F.to_json(F.struct(text.alias("transcript"), F.col("lang").alias("language"), F.col("n_chars").alias("audio_seconds"))))
    reply = reply.when(F.col("doc_id") % 4 == 1, F.to_json(F.struct(text.alias("text")))).when(F.col("doc_id") % 4 == 2, F.lit('" a bare reply"')).otherwise(F.concat(F.lit("<"), text))
    return V.table(spark, d, "documents").select("doc_id", T.stt_response(reply).alias("r")).select("doc_id", "r.transcript", "r.language", "r.audio_sec", "r.error")


@query("SELECT source AS source_id, count(*) AS source_size, CASE WHEN count(*) % 2 = 1 THEN 'failed' ELSE 'completed' END AS status FROM documents WHERE source IS NOT NULL GROUP BY source")
def q_states_written(spark, d):
    path = f"{shared_folder(spark)}/states-{uuid.uuid4().hex}"
    sources = V.table(spark, d, "documents").where("source is not null").groupBy(F.col("source").alias("source_id")).agg(F.count("*").alias("source_size"))
    state = sources.select(*[(F.col(x.name) if x.name in sources.columns else F.lit(None).cast(x.dataType)).alias(x.name) for x in spark.createDataFrame([], schemas.STATE).schema])
    manifests.write_states(state.withColumn("status", F.lit("completed")), path)
    manifests.write_states(state.where("source_size % 2 = 1").withColumn("status", F.lit("failed")), path)
    return manifests.states(spark, path).select("source_id", "source_size", "status")


@query("SELECT source AS source_id, CASE WHEN count(*) % 2 = 1 THEN count(*) ELSE 0 END AS n_samples FROM documents WHERE source IS NOT NULL GROUP BY source")
def q_levels_cached(spark, d):
    root = f"{shared_folder(spark)}/levels-{uuid.uuid4().hex}"
    sources = V.table(spark, d, "documents").where("source is not null").groupBy(F.col("source").alias("source_id")).agg(F.count("*").alias("n_samples"))
    manifests.write_cache(sources.withColumn("n_samples", F.lit(0).cast("long")), root)
    manifests.write_cache(sources.where("n_samples % 2 = 1"), root)
    return manifests.cached(spark, root, schemas.LEVELS).select("source_id", "n_samples")
