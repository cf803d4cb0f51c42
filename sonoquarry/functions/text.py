"""Text and reason-code expressions. All are Catalyst expressions.

Java's and Python's character classes differ, so classes are spelt out: a word character is a letter,
any number or the underscore; combining marks are not. White space follows Python's str.strip().
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
LETTER = r"[\p{L}\p{Nl}\p{No}]"
DIGIT = r"\p{Nd}"


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def dedup_text(text: Column) -> Column:
    """Lower case, without punctuation and combining marks, single spaces: the form that duplicates share."""
    bare = F.regexp_replace(stripped(F.lower(text)), f"[^{WORD}{SPACE}]", "")
    return F.regexp_replace(bare, f"[{SPACE}]+", " ")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]+"), 0)


def language_prefix(stem: Column) -> Column:
    return F.lower(F.substring_index(stem, "_", 1))


def safe_id(stem: Column) -> Column:
    """A source id from a file name's stem: letters, numbers, - _ . stay."""
    out = F.regexp_replace(stem, r"[^\p{L}\p{N}\-_.]", "_")
    return F.when(out == "", "source").otherwise(out)


def utterance_id(source: Column, start: Column, end: Column) -> Column:
    """The same clip always gets the same id."""
    return F.concat(source, F.lit("__"), F.substring(F.sha2(F.concat_ws("|", source, start.cast("string"), end.cast("string")).cast("binary"), 256), 1, 12))


def category(reason: Column) -> Column:
    return F.substring_index(reason, ":", 1)


def detail(reason: Column) -> Column:
    """What follows the first colon, empty without one."""
    return F.coalesce(F.get(F.split(reason, ":", 2), 1), F.lit(""))


def score_in(reason: Column, name: str) -> Column:
    """The score that a reason text carries, as in name_2.41_below; null if there is none."""
    return F.regexp_extract(reason, rf"{name}_([\d.]+)_below", 1).try_cast("double")


def clock(seconds: Column) -> Column:
    """HH:MM:SS.mmm; empty for null. Milliseconds are rounded first, so 59.9996 s is a full minute."""
    ms = F.round(seconds * 1000).cast("long")
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    hours = F.floor(ms / 3600000)
    shown = F.concat(F.when(hours < 10, two(hours)).otherwise(hours.cast("string")), F.lit(":"), two(F.floor(ms / 60000) % 60), F.lit(":"), two(F.floor(ms / 1000) % 60), F.lit("."), F.lpad((ms % 1000).cast("string"), 3, "0"))
    return F.coalesce(shown, F.lit(""))


def repeated_ngram(words: Column, n: int = 3, times: int = 3) -> Column:
    """Whether some n words stand `times` times in a row: then n * (times - 1) words in a row equal those n places on.

    One pass: each place gives a sign, and the signs are searched for a run. (A lambda over places would
    make the words anew for each.)
    """

    def found(w: Column) -> Column:
        rest = F.greatest(F.size(w) - n, F.lit(0))
        signs = F.zip_with(F.slice(w, 1, rest), F.slice(w, n + 1, rest), lambda a, b: F.when(a == b, "=").otherwise("."))
        return F.contains(F.array_join(signs, ""), F.lit("=" * (n * (times - 1))))

    return F.coalesce(bound(words, found), F.lit(False))


def title(text: Column) -> Column:
    """Each run of letters with a capital first and small ones after it."""
    runs = F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), 0)
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 1 << 30)))), "")


def stt_response(body: Column) -> Column:
    """A transcription server's reply as a struct: transcript, segments, language, audio_sec and error.

    The transcript is the document's `transcript`, else its `text`, else the document itself if it is a
    string; without one, or if the reply is no JSON, only error is set. Null bodies are no JSON.
    """
    doc = F.try_parse_json(body)
    of = lambda path, kind: F.try_variant_get(doc, path, kind)
    bare = F.when(F.schema_of_variant(doc) == "STRING", of("$", "string"))
    transcript = stripped(F.coalesce(of("$.transcript", "string"), of("$.text", "string"), bare))
    shown = F.substring(F.coalesce(body, F.lit("")), 1, 200)
    error = F.when(doc.isNull(), F.concat(F.lit("STT server returned non-JSON response: "), shown)).when(transcript.isNull(), F.concat(F.lit("could not find transcript in STT response: "), shown))
    ok = error.isNull()
    return F.struct(
        transcript.alias("transcript"), F.when(ok, of("$.segments", "array<struct<start: double, end: double, text: string>>")).alias("segments"),
        F.when(ok, F.coalesce(of("$.language", "string"), F.lit(""))).alias("language"), F.when(ok, F.coalesce(of("$.audio_seconds", "double"), F.lit(0.0))).alias("audio_sec"), error.alias("error"),
    )


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value computed once, however often f uses it inside lambdas."""
    return F.get(F.transform(F.array(value), f), 0)


def fixed(x: Column, digits: int) -> Column:
    """A number with so many decimals, rounded by its exact binary value (Java rounds its shortest text); NaN gives null.

    The fraction times the power of ten is taken as two doubles whose sum is exact (Dekker), so only a half
    needs the second one. From 2^63 on, digits after the 17th are zeros.
    """
    scale = 10**digits

    def halves(v: Column) -> tuple[Column, Column]:
        high = v * 134217729.0 - (v * 134217729.0 - v)
        return high, v - high

    def rounded(z: Column) -> Column:
        product = z["f"] * float(scale)
        (a, b), (c, d) = halves(z["f"]), halves(F.lit(float(scale)))
        error = ((a * c - product) + a * d + b * c) + b * d
        low = F.floor(product)
        part, last = product - low, low if digits else z["w"]
        up = (part > 0.5) | ((part == 0.5) & ((error > 0) | ((error == 0) & (last % 2 == 1))))
        return F.struct(z["w"].alias("w"), (low + F.when(up, 1).otherwise(0)).alias("r"))

    def shown(v: Column) -> Column:
        size = F.when(F.abs(v) < 2.0**63, F.abs(v)).otherwise(0.0)
        parts = bound(F.struct(size.cast("long").alias("w"), (size - size.cast("long")).alias("f")), rounded)

        def told(z: Column) -> Column:
            whole = z["w"] + F.when(z["r"] == scale, 1).otherwise(0)
            rest = [F.lit("."), F.lpad((z["r"] % scale).cast("string"), digits, "0")] if digits else []
            return F.concat(whole.cast("string"), *rest)

        large = F.when(F.abs(v) == float("inf"), "inf").otherwise(F.format_string(f"%.{digits}f", F.abs(v)))
        sign = F.when((v < 0) | (v.cast("string") == "-0.0"), "-").otherwise("")
        return F.when(v.isNotNull() & ~F.isnan(v), F.concat(sign, F.when(F.abs(v) < 2.0**63, bound(parts, told)).otherwise(large)))

    return bound(x.cast("double"), shown)
