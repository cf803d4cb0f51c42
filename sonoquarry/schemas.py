"""Schemas of the tables that are read from files, as Spark DDL."""

CLIP = """utterance_id STRING, status STRING, source_id STRING, source_filename STRING,
start_sec DOUBLE, end_sec DOUBLE, duration_sec DOUBLE, text STRING, audio_path STRING,
detected_language STRING, language_probability DOUBLE, avg_logprob DOUBLE, no_speech_prob DOUBLE,
compression_ratio DOUBLE, mean_word_confidence DOUBLE, chars_per_sec DOUBLE, est_snr_db DOUBLE,
background_verdict STRING, clipped_sample_ratio DOUBLE, speaker_verification_method STRING,
speaker_verified BOOLEAN, loudness_applied BOOLEAN, input_lufs DOUBLE, output_lufs DOUBLE,
internal_pauses_trimmed INT, needs_human_review BOOLEAN, needs_number_review BOOLEAN,
rejection_reasons ARRAY<STRING>, review_reasons ARRAY<STRING>,
dnsmos_sig DOUBLE, dnsmos_bak DOUBLE, dnsmos_ovrl DOUBLE, pipeline_version STRING"""

TRANSCRIPTION = """language STRING, language_probability DOUBLE, duration_sec DOUBLE,
segments ARRAY<STRUCT<id: INT, start: DOUBLE, `end`: DOUBLE, text: STRING, avg_logprob: DOUBLE,
no_speech_prob: DOUBLE, compression_ratio: DOUBLE,
words: ARRAY<STRUCT<word: STRING, start: DOUBLE, `end`: DOUBLE, probability: DOUBLE>>>>,
model_name STRING, device STRING, compute_type STRING,
vad_speech_regions ARRAY<ARRAY<DOUBLE>>, elapsed_sec DOUBLE"""

LEVELS = """duration_sec DOUBLE, sample_rate INT, rms_dbfs DOUBLE, peak_dbfs DOUBLE, clipped_sample_ratio DOUBLE,
silence_ratio DOUBLE, block_rms_dbfs ARRAY<DOUBLE>, block_hop_sec DOUBLE, n_samples BIGINT"""

PROBE = """path STRING, codec STRING, channels INT, sample_rate INT, bits_per_sample INT,
duration_sec DOUBLE, size_bytes BIGINT, has_audio_stream BOOLEAN"""

STATE = """source_path STRING, source_size BIGINT, source_mtime DOUBLE, source_id STRING,
stages MAP<STRING, STRING>, status STRING, error STRING, updated_at DOUBLE, schema_version INT"""

SPEAKERS = "speakers ARRAY<STRUCT<source_id: STRING, embedding: ARRAY<FLOAT>>>"

VOICE = "seq INT, source_id STRING, embedding ARRAY<FLOAT>"
