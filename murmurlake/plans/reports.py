"""Outputs of a run: partitioned JSON, samples, statistics and short reports in Markdown."""

from __future__ import annotations

import json
import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurlake import config
from murmurlake.operators import mining, review
from murmurlake.plans import pipeline
from murmurlake.sources import files


def run_folder(base: str) -> str:
    return f"{str(base).rstrip('/')}/run_{datetime.now(UTC):%Y%m%d_%H%M%S}"


def output_record(blocks: DataFrame) -> DataFrame:
    """Blocks as they are written: with the decision, and scores and metrics as objects."""
    decision = F.when(F.col("bucket") == "rejected", F.lit("reject")).otherwise(F.lit("keep"))
    return blocks.withColumn("decision", decision).drop("manual_keep")


def debug_sessions(blocks: DataFrame) -> DataFrame:
    return blocks.select(
        "block_id", "session_id", "source_file", "bucket", F.substring("my_text", 1, 200).alias("my_text"), "reasons", "metrics", "scores", "style_tags"
    )


def _table(rows: list, columns: list[str]) -> str:
    head = "| " + " | ".join(columns) + " |\n|" + "-|" * len(columns) + "\n"
    return head + "".join("| " + " | ".join(str(r[c]) for c in columns) + " |\n" for r in rows)


def phrase_report(mined: DataFrame, s: config.Settings) -> str:
    lists = mining.review_lists(mined, s, 30).join(mined.select("phrase", "freq", "min_pmi", "min_entropy", "style_keyness", "suggested_action"), "phrase")
    out = "# Mined phrases\n\n"
    for name in ("review_phrases_top", "review_privacy_terms", "review_chaos_terms", "review_stopword_candidates"):
        rows = lists.where(F.col("list") == name).orderBy("place").limit(30 if name == "review_phrases_top" else 20).collect()
        out += f"## {name}\n\n{_table(rows, ['phrase', 'freq', 'min_pmi', 'min_entropy', 'style_keyness', 'suggested_action'])}\n"
    return out


def audit_report(audited: DataFrame, summary: DataFrame) -> str:
    totals = summary.orderBy("metric", F.desc("value"), "item").limit(200).collect()
    top = audited.orderBy(F.desc("freq_total"), "ord").limit(50).collect()
    return f"# Lexicon audit\n\n{_table(totals, ['metric', 'item', 'value'])}\n## Most frequent terms\n\n" + _table(
        top, ["term", "old_category", "freq_total", "candidate_rate", "rejected_rate", "style_keyness", "suggested_status"]
    )


def ratios(blocks: DataFrame) -> DataFrame:
    """(bucket, n, ratio): the shares that tuning looks at."""
    counts = pipeline.bucket_counts(blocks)
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("bucket", "n", F.round(F.when(F.col("total") > 0, F.col("n") / F.col("total")).otherwise(F.lit(0.0)), 6).alias("ratio"))


def tuning_notes(stats: dict, s: config.Settings) -> list[str]:
    """What the output ratios and leading reasons suggest; advice only."""
    total, out = stats["my_blocks"], stats["outputs"]
    if not total:
        return ["there are no blocks"]
    share = {b: n / total for b, n in out.items()}
    leading = {r["reason"]: r["count"] for r in stats["top_reject_reasons"][:5]}
    by = lambda start: sum(n for r, n in leading.items() if r.startswith(start))
    notes = []
    if share["candidates"] < s.candidate_ratio_target_min:
        notes.append(f"candidates are {share['candidates']:.1%}, below {s.candidate_ratio_target_min:.0%}: lower candidate_min_style_score ({s.candidate_min_style_score})")
    elif share["candidates"] > s.candidate_ratio_target_max:
        notes.append(f"candidates are {share['candidates']:.1%}, above {s.candidate_ratio_target_max:.0%}: raise candidate_min_style_score ({s.candidate_min_style_score})")
    if share["chaos_style"] > s.chaos_style_ratio_max:
        notes.append(f"chaos_style is {share['chaos_style']:.1%}, above {s.chaos_style_ratio_max:.0%}: raise chaos_separate_score ({s.chaos_separate_score})")
    if by("too_few_chars:") > 0.1 * total:
        notes.append(f"too_few_chars: {by('too_few_chars:')} blocks; try min_my_block_chars {max(s.min_my_block_chars - 5, 5)}")
    if by("low_style_but_has_tone"):
        notes.append(f"low_style_but_has_tone: {by('low_style_but_has_tone')} blocks; micro_style_min_style_score is {s.micro_style_min_style_score}")
    if by("rejected_fallback"):
        notes.append(f"rejected_fallback: {by('rejected_fallback')} blocks; see the leading reasons")
    copies = sum(n for r, n in leading.items() if "duplicate" in r)
    if copies > max(0.01 * total, 5):
        notes.append(f"duplicates: {copies} blocks; duplicate_keep_limit is {s.duplicate_keep_limit}")
    return notes or ["the output ratios are within the expected ranges"]


def stages(s: dict) -> list[dict]:
    """What each stage of a run took in and gave, in order."""
    named = (
        ("parse_files", ("total_files_found", "total_files_parsed")),
        ("read_messages", ("total_messages", "own_messages")),
        ("build_turns", ("turns",)),
        ("split_sessions", ("sessions",)),
        ("extract_blocks", ("my_blocks",)),
        ("mine_phrases", ("phrases_mined", "phrase_clusters", "phrases_promoted")),
        ("dedup", ("exact_duplicates", "near_duplicates")),
        ("decide_buckets", ("outputs",)),
        ("tag_blocks", ("style_tags",)),
    )
    return [{"name": name, "counts": {k: s[k] for k in keys}} for name, keys in named]


def write_run(r: pipeline.Result, folder: str, files_found: int, files_parsed: int, started: float) -> dict:
    """Everything a run writes, below ``folder``; large outputs stay distributed, reports are small files."""
    from murmurlake.operators import lexicon

    spark = r.blocks.sparkSession
    text = lambda name, content: files.write_text(spark, f"{folder}/{name}", content)
    rows = output_record(r.blocks)
    if not r.settings.keep_rejected:
        rows = rows.where(F.col("bucket") != "rejected")
    rows.write.mode("overwrite").option("ignoreNullFields", False).partitionBy("bucket").json(f"{folder}/blocks")
    debug_sessions(r.blocks).write.mode("overwrite").json(f"{folder}/debug_sessions")
    samples = pipeline.cut(r.samples, "samples")
    output_record(samples).write.mode("overwrite").partitionBy("stratum").json(f"{folder}/review_samples")
    review.decision_template(samples).coalesce(1).write.mode("overwrite").json(f"{folder}/review_decisions_template")
    s = pipeline.stats(r, files_found, files_parsed)
    if r.mined is not None:
        r.mined.write.mode("overwrite").partitionBy("length").json(f"{folder}/phrases")
        for n in range(r.settings.min_n, r.settings.max_n + 1):
            r.mined.where(F.col("length") == n).orderBy("rank").coalesce(1).write.mode("overwrite").json(f"{folder}/phrase_freq_{n}gram")
        mining.candidates(r.mined).write.mode("overwrite").json(f"{folder}/phrase_candidates")
        mining.review_lists(r.mined, r.settings).write.mode("overwrite").partitionBy("list").json(f"{folder}/phrase_reviews")
        text("phrase_report.md", phrase_report(r.mined, r.settings))
        text("phrase_mining_stats.json", json.dumps({k: s[k] for k in ("phrases_mined", "phrase_clusters", "phrases_promoted")}, ensure_ascii=False, indent=2))
    if r.phrase_clusters is not None:
        r.phrase_clusters.coalesce(1).write.mode("overwrite").json(f"{folder}/phrase_clusters")
    if r.audit is not None:
        audited = pipeline.cut(r.audit, "audit")
        audited.write.mode("overwrite").json(f"{folder}/lexicon_audit")
        text("lexicon_audit_report.md", audit_report(audited, lexicon.audit_summary(audited)))
    text("stats.json", json.dumps(s, ensure_ascii=False, indent=2))
    text("settings.toml", config.snapshot(r.settings))
    text("tuning_advice.md", "# Tuning advice\n\n" + "".join(f"- {n}\n" for n in tuning_notes(s, r.settings)))
    trace = {"stages": stages(s), "outputs": s["outputs"], "total_blocks": s["my_blocks"], "promoted": r.promoted, "warnings": r.warnings[:20], "elapsed_seconds": round(time.time() - started, 2)}
    text("trace.json", json.dumps(trace, ensure_ascii=False, indent=2))
    return s
