"""The filter run: messages → blocks → mined phrases → scored, filtered and bucketed blocks.

One lazy plan with two cuts – after extraction, since three branches read the blocks, and
after the decision – and one barrier, where at most thirty promoted phrases come to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurlake.config import BUCKETS, Settings, Words
from murmurlake.operators import blocks as bl
from murmurlake.operators import dedup, filters, lexicon, mining, review, scoring
from murmurlake.operators.clusters import clusters
from murmurlake.session import cut


@dataclass
class Result:
    messages: DataFrame
    turns: DataFrame
    sessions: DataFrame
    blocks: DataFrame
    mined: DataFrame | None
    phrase_clusters: DataFrame | None
    promoted: list[str]
    audit: DataFrame | None
    samples: DataFrame
    words: Words
    settings: Settings
    warnings: list[str] = field(default_factory=list)


def scan_rows(blocks: DataFrame, s: Settings) -> DataFrame:
    """Blocks as texts to mine, from the sources of the settings, with their rough buckets."""
    return mining.scan_texts(blocks, s.scan_sources)


def finish_blocks(blocks: DataFrame, words: Words, s: Settings, decisions: DataFrame | None, key: list[str], copies_bucket: F.Column) -> DataFrame:
    """Score, id, mask, dedup, filter, decide and tag blocks, in this order: ids and scores see the unmasked text."""
    rows = filters.with_review_ids(scoring.score_blocks(blocks, words, s))
    rows = filters.privacy_mode(rows, s)
    rows = dedup.limit_copies(rows, copies_bucket, key, s.duplicate_keep_limit)
    if s.near_duplicate_enable:
        rows = dedup.reject_near(rows.withColumn("ord", F.struct(*key)), "ord", s.near_duplicate_threshold).drop("ord")
    rows = filters.apply_filters(rows, words, s)
    if decisions is not None:
        rows = filters.apply_decisions(rows, decisions)
    return scoring.tag_blocks(scoring.decide_buckets(rows, key, s), words, s)


def run(
    messages: DataFrame,
    s: Settings,
    words: Words,
    decisions: DataFrame | None = None,
    archived: DataFrame | None = None,
    stoplist: DataFrame | None = None,
    keep: DataFrame | None = None,
    drop: DataFrame | None = None,
) -> Result:
    """The whole run over messages of the common shape with is_me; all results are lazy or written tables."""
    spark = messages.sparkSession
    turns = bl.build_turns(messages, s)
    sessions = bl.split_sessions(turns, s)
    key = ["source_file", "session_no", "block_no"]
    extracted = cut(bl.number_sources(bl.extract_blocks(sessions, s), messages), "blocks")
    mined = groups = None
    promoted: list[str] = []
    if s.mining_enabled:
        phrases = lambda listed: spark.createDataFrame([(w,) for w in listed], "phrase string")
        rough = extracted.select("my_text", "fragments", "my_turns", F.struct(*key).alias("ord"), scoring.structural_bucket(F.col("metrics"), s).alias("bucket"))
        mined = cut(
            mining.mine(
                scan_rows(rough, s),
                s,
                stoplist if stoplist is not None else phrases(words.stoplist),
                keep if keep is not None else phrases(words.manual_keep),
                drop if drop is not None else phrases(words.manual_drop),
            ),
            "mined",
        )
        if s.clustering_enabled:
            groups = cut(clusters(mining.candidates(mined), s.min_surface_overlap), "clusters")
        promoted = [r["phrase"] for r in mining.promote(mined, s, [*words.analysis, *words.tone]).collect()]
        words = words.promoted(promoted)
    final = cut(finish_blocks(extracted, words, s, decisions, key, F.col("source_file")), "final")
    audited = lexicon.audit(final, archived) if archived is not None else None
    samples = review.stratified_sample(final, s.human_review_sample_size, s.sample_seed)
    return Result(messages, turns, sessions, final, mined, groups, promoted, audited, samples, words, s)


def bucket_counts(blocks: DataFrame) -> DataFrame:
    """(bucket, n) of all six buckets, those without blocks included."""
    all_six = blocks.sparkSession.createDataFrame([(b,) for b in BUCKETS], "bucket string")
    counted = blocks.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return all_six.join(counted, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def top_reasons(blocks: DataFrame, k: int = 20) -> DataFrame:
    return blocks.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(k)


def stats(r: Result, files_found: int, files_parsed: int) -> dict:
    """The numbers of a run; each is one aggregate, and only single rows come to the driver."""
    m = r.messages.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_me").alias("own")).first()
    t = r.sessions.agg(F.count(F.lit(1)).alias("turns"), F.countDistinct("source_file", "session_no").alias("sessions")).first()
    outputs = {x["bucket"]: x["n"] for x in bucket_counts(r.blocks).collect()}
    copies = lambda start: F.count_if(F.exists("reasons", lambda x: x.startswith(start)))
    d = r.blocks.agg(copies("exact_duplicate").alias("exact"), copies("near_duplicate").alias("near")).first()
    tags = r.blocks.select(F.explode("style_tags").alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "tag").limit(50).collect()
    mined = {} if r.mined is None else {x["length"]: x["n"] for x in r.mined.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a length
    return {
        "total_files_found": files_found,
        "total_files_parsed": files_parsed,
        "total_messages": m["n"],
        "own_messages": m["own"],
        "sessions": t["sessions"],
        "turns": t["turns"],
        "my_blocks": sum(outputs.values()),
        "outputs": {b: outputs[b] for b in BUCKETS},
        "top_reject_reasons": [{"reason": x["reason"], "count": x["n"]} for x in top_reasons(r.blocks).collect()],
        "exact_duplicates": d["exact"],
        "near_duplicates": d["near"],
        "style_tags": {x["tag"]: x["n"] for x in tags},
        "phrases_mined": {f"{n}gram": mined[n] for n in sorted(mined)},
        "phrase_clusters": 0 if r.phrase_clusters is None else r.phrase_clusters.count(),
        "phrases_promoted": len(r.promoted),
        "warnings": r.warnings[:50],
        "warnings_truncated": len(r.warnings) > 50,
    }
