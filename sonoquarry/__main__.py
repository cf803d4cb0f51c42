"""python -m sonoquarry COMMAND --results ROOT: reports and maintenance over ROOT/<source>/manifests/*.jsonl."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonoquarry.operators import maintenance, reports
from sonoquarry.sources import manifests


def loaded(spark: SparkSession, root: str) -> DataFrame:
    """All records with seq numbers in the order of their sources and files."""
    clips = manifests.all_manifests(spark, root).withColumn("source_id", F.coalesce("source", "source_id"))
    empty = F.array().cast("array<string>")
    clips = clips.withColumns({c: F.coalesce(c, empty) for c in ("rejection_reasons", "review_reasons")})
    return clips.withColumn("seq", F.struct("source_id", "status", "start_sec", "utterance_id"))


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="sonoquarry", description=__doc__)
    p.add_argument("command", choices=["summary", "quarantine", "sources", "background", "promote", "numbers", "timestamps", "package", "trim"])
    p.add_argument("--results", required=True)
    p.add_argument("--out", help="folder to write to; without it the result is shown")
    p.add_argument("--empty-only", action="store_true", help="sources: those without accepted clips")
    p.add_argument("--min-bak", type=float, default=0.0, help="background: lowest score")
    p.add_argument("--max-clip-pct", type=float, default=0.1, help="promote: clipped samples below this")
    p.add_argument("--language", default="telugu", help="numbers: target language")
    p.add_argument("--style", default="english", help="numbers: kind of number words")
    p.add_argument("--limit", type=int, default=50, help="rows shown")
    a = p.parse_args(argv)
    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    clips = loaded(spark, a.results)
    accepted = clips.where("status = 'accepted'").select("source_id", "utterance_id")
    if a.command == "sources":
        out = reports.source_outcomes(clips).orderBy("source_id")
        out = out.where("accepted = 0") if a.empty_only else out
    elif a.command == "quarantine":
        out = reports.labelled(reports.category_counts(clips)).orderBy("status", F.desc("n"), "first_seen").drop("first_seen")
    elif a.command == "numbers":
        out = maintenance.number_stats(clips, a.language, a.style)
    else:
        files = clips.where("audio_path is not null").select("source_id", "utterance_id", "audio_path")
        out = {
            "summary": lambda: reports.summary(clips), "background": lambda: reports.background_holds(clips, a.min_bak),
            "promote": lambda: maintenance.promoted(clips, a.max_clip_pct).where("promoted").drop("seq"),
            "timestamps": lambda: reports.timestamps(clips).orderBy("source_file", "n"),
            "package": lambda: maintenance.to_package(files, accepted), "trim": lambda: maintenance.to_trim(files, accepted),
        }[a.command]()
    if a.out:
        manifests.write_report(out, a.out, "json")
    else:
        out.show(a.limit, truncate=False)


if __name__ == "__main__":
    main()
