"""The queries of this subpackage, one per operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoquarry.llm import bpe, chat, decontaminate, images, language, licences, lines, minhash, secrets, urls

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public tokenizer files of this installation lie."""
    try:
        import public_tokenizers

        return str(public_tokenizers.path(name))
    except ImportError:
        return str(Path("/opt/tokenizers") / name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"))
    return chat.conversations(turns.unionByName(extra)).drop("error")


def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filtered(_table(spark, sf_dir, "pages"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(secrets.secret_spans(_table(spark, sf_dir, "documents")))


def op5_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return images.copies(images.drawn(_table(spark, sf_dir, "embeddings")))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return lines.without_boilerplate(docs).select("doc_id", "source", "lines.n_lines", "lines.n_dropped", "text")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), vocabulary_path())


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(_table(spark, sf_dir, "documents"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.findings(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("licences", ",").alias("licences"), "n_found", "best_dice")


def queries() -> dict[str, Query]:
    return {
        "op1_minhash": op1_minhash,
        "op2_chat": op2_chat,
        "op3_urls": op3_urls,
        "op4_secrets": op4_secrets,
        "op5_images": op5_images,
        "op6_lines": op6_lines,
        "op7_decontaminate": op7_decontaminate,
        "op8_bpe": op8_bpe,
        "op9_language": op9_language,
        "op10_licences": op10_licences,
    }


OP2_SQL = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), t AS (
    SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn) AS before,
        lead(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn) AS after,
        replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>') AS escaped,
        CASE role WHEN 'system' THEN '### System: ' WHEN 'user' THEN '### User: ' WHEN 'assistant' THEN '### Assistant: '
            ELSE '### Role ' || replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), ': ', '\: ') || ': ' END AS head
    FROM c
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length(head) + length(escaped) + 8)::BIGINT AS formatted_chars,
    bool_and(CASE before WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END)
        AND bool_and(after <> '' OR role = 'assistant') AS valid
FROM t GROUP BY conv_id
"""

OP3_SQL = r"""
WITH p AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
    SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p
), r AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/de/8') THEN 'example.net/de/8'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/7') THEN 'example.com/en/7'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/en/') THEN 'com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/de/') THEN 'net/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/es/') THEN 'org/es/' END AS rule,
        regexp_matches(host, '(^|\.)(casino-win\.example\.com|cheap-pills\.example\.com|free-bets\.example\.com|spam\.example\.net)$') AS listed
    FROM h
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN listed THEN 'block' ELSE 'allow' END AS verdict, listed
FROM r
"""


OP6_SQL = """
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents
), l AS (
    SELECT DISTINCT r, source, trim(x, ' ' || chr(9) || chr(13)) AS line FROM (SELECT r, source, unnest(ls) AS x FROM d)
), t AS (
    SELECT source, count(*) AS pages FROM d GROUP BY source
), b AS (
    SELECT l.source, list(line) AS bad FROM (SELECT source, line, count(*) AS n FROM l WHERE line <> '' GROUP BY ALL HAVING n >= 5) l
    JOIN t ON l.source IS NOT DISTINCT FROM t.source WHERE n > 0.06 * pages GROUP BY l.source
), k AS (
    SELECT d.*, list_filter(ls, lambda x: trim(x, ' ' || chr(9) || chr(13)) = '' OR NOT list_contains(coalesce(bad, []), trim(x, ' ' || chr(9) || chr(13)))) AS kept
    FROM d LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source
), m AS (
    SELECT *, len(list_filter(kept, lambda x: trim(x, ' ' || chr(9) || chr(13)) <> '')) > 0 AS has_text FROM k
)
SELECT doc_id, source, coalesce(len(ls), 0)::BIGINT AS n_lines, (CASE WHEN has_text THEN len(ls) - len(kept) ELSE 0 END)::BIGINT AS n_dropped,
    CASE WHEN has_text THEN array_to_string(kept, chr(10)) ELSE text END AS text
FROM m
"""


def _licence_sql() -> str:
    values = ", ".join("('" + n + "', '" + t.replace("'", "''") + "')" for n, t in licences.TEMPLATES.items())
    return f"""
WITH t AS (
    SELECT name, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
    FROM (SELECT name, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM (VALUES {values}) v(name, text))
), d AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents
), p AS (
    SELECT r, doc_id, list_distinct(list_concat(string_split(text, chr(10)),
        list_filter(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), lambda x: contains(trim(x), chr(10))), [text])) AS units FROM d
), u AS (
    SELECT r, w, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
    FROM (SELECT r, regexp_extract_all(lower(x), '[\\p{{L}}\\p{{N}}]+') AS w FROM (SELECT r, unnest(units) AS x FROM p)) WHERE len(w) >= 2
), s AS (
    SELECT r, w, name, 2.0::DOUBLE * len(list_intersect(u.g, t.g)) / (len(u.g) + len(t.g)) AS dice, row_number() OVER () AS i
    FROM u JOIN t ON 3 * len(u.g) >= 2 * len(t.g) AND 2 * len(u.g) <= 3 * len(t.g)
), f AS (
    SELECT r, w, max(dice) AS dice, arg_min(name, (-dice, name)) AS name FROM s WHERE dice >= 0.8 GROUP BY r, w
), n AS (
    SELECT r, list_sort(list(DISTINCT name)) AS names, max(dice) AS best FROM f GROUP BY r
), c AS (
    SELECT r, count(*) AS n FROM (SELECT r, unnest(units) AS x FROM p) x JOIN (SELECT DISTINCT r, w FROM f) f USING (r)
    WHERE regexp_extract_all(lower(x), '[\\p{{L}}\\p{{N}}]+') = f.w GROUP BY r
)
SELECT doc_id, coalesce(array_to_string(names, ','), '') AS licences, coalesce(n, 0)::BIGINT AS n_found, round(best, 9) AS best_dice
FROM d LEFT JOIN n USING (r) LEFT JOIN c USING (r)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_chat": OP2_SQL, "op3_urls": OP3_SQL, "op6_lines": OP6_SQL, "op10_licences": _licence_sql()}
