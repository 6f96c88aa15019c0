"""Queries of the block pipeline's operators over the stored tables, and the same in SQL.

Two inputs: ``documents`` as blocks of one speaker, and ``messages``, whose blocks are
extracted. Word lists come from the stored lexicon; thresholds are the tuned preset.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurlake.config import BUCKETS, MINED_BUCKETS, TUNED, Settings, Words
from murmurlake.operators import blocks as bl
from murmurlake.operators import clusters as cl
from murmurlake.operators import dedup, filters, lexicon, mining, review, scoring
from murmurlake.plans import pipeline, reports
from murmurlake.session import cut
from murmurlake.sources import messages as src
from murmurlake.sources.tables import spread, table

S = TUNED
#: Promotion is off in the preset; here it is on, with thresholds that some phrases reach.
PROMOTING = S.with_(auto_promote_enabled=True, promote_min_style_keyness=1.0, promote_min_pmi=2.0)


def _lexicon(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.active(table(spark, d, "lexicon"))


def _words(spark: SparkSession, d: str) -> Words:
    return lexicon.word_lists(_lexicon(spark, d))


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return src.owned_by_file(src.from_table(table(spark, d, "messages")), table(spark, d, "chat_files"))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    return bl.build_turns(_messages(spark, d), S)


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    return bl.split_sessions(_turns(spark, d), S)


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return bl.extract_blocks(_sessions(spark, d), S)


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return scoring.from_documents(spread(table(spark, d, "documents")))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return scoring.score_blocks(_docs(spark, d), _words(spark, d), S)


def _scored_messages(spark: SparkSession, d: str) -> DataFrame:
    """Single messages as blocks: they hold more private data and noise than the documents."""
    rows = table(spark, d, "messages").select(
        F.col("row_id").alias("doc_id"), "source_file", F.col("msg_idx").alias("block_ord"), F.col("chat_id").alias("source"), F.lit(None).cast("string").alias("bucket"), "text"
    )
    return scoring.score_blocks(scoring.from_documents(rows), _words(spark, d), S)


def _decided(spark: SparkSession, d: str) -> DataFrame:
    return scoring.decide_buckets(_scored(spark, d), ["doc_id"], S)


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """Documents to mine: their given bucket, in order of doc_id."""
    rows = spread(table(spark, d, "documents").select(F.col("bucket"), F.col("doc_id").alias("ord"), F.col("text").alias("my_text")))
    return mining.scan_texts(rows)


def _manual(spark: SparkSession, d: str) -> DataFrame:
    return lexicon.manual_phrases(_lexicon(spark, d), filters.latest_decisions(table(spark, d, "review_decisions")))


def _mined(spark: SparkSession, d: str, s: Settings = S) -> DataFrame:
    listed = _manual(spark, d)
    pick = lambda decision: listed.where(F.col("decision") == decision).select("phrase")
    stop = _lexicon(spark, d).where("kind = 'phrase_stoplist'").select("phrase")
    return mining.mine(_texts(spark, d), s, stop, pick("keep"), pick("drop"))


def _joined(c: str) -> F.Column:
    return F.array_join(c, "|").alias(c)


def scan_messages(spark, d):
    rows = src.from_table(table(spark, d, "messages"))
    return rows.select("row_id", "source_file", "timestamp_ms", "uid", "uin", "name", "nickname", "msg_type", "is_system", "is_recalled")


def first_present_field(spark, d):
    return src.from_table(table(spark, d, "messages")).select("row_id", "text")


def message_type_map(spark, d):
    return src.from_table(table(spark, d, "messages")).groupBy("msg_type", "is_system").agg(F.count(F.lit(1)).alias("n"))


def text_strip(spark, d):
    return src.stripped(src.from_table(table(spark, d, "messages"))).select("row_id", F.length("text").alias("n_chars"))


def own_message_counts(spark, d):
    return _messages(spark, d).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_messages"), F.count_if("is_me").alias("n_own"), F.count_if("is_recalled").alias("n_recalled")
    )


def identity_by_name(spark, d):
    """Identity lists: the five owners of most files by uid, and the name of the largest."""
    files = table(spark, d, "chat_files")
    lead = files.where("self_uid is not null").groupBy("self_uid").agg(F.countDistinct("source_file").alias("n"), F.min("self_name").alias("name")).orderBy(F.desc("n"), "self_uid").limit(5).collect()
    rows = src.owned_by_identity(src.from_table(table(spark, d, "messages")), tuple(r["self_uid"] for r in lead), (lead[0]["name"].upper(),) if lead and lead[0]["name"] else ())
    return rows.where("is_me").select("row_id")


def turn_merge(spark, d):
    return _turns(spark, d).select(
        "source_file", "turn_no", "is_me", F.size("fragments").alias("n_fragments"), "char_count", "start_ms", "end_ms", "is_system", "msg_type"
    )


def turn_texts(spark, d):
    return _turns(spark, d).select("source_file", "turn_no", F.md5("text").alias("text_md5"))


def session_split(spark, d):
    return _sessions(spark, d).groupBy("source_file", "session_no").agg(
        F.count(F.lit(1)).alias("n_turns"), F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")
    )


def block_extract(spark, d):
    return _blocks(spark, d).select("source_file", "session_id", "block_id", "first_turn", "last_turn")


def block_metrics(spark, d):
    return _blocks(spark, d).select("source_file", "block_id", "metrics.*").drop("my_char_ratio", "short_fragment_ratio")


def block_texts(spark, d):
    return _blocks(spark, d).select("source_file", "block_id", F.md5("my_text").alias("text_md5"), F.size("fragments").alias("n_fragments"))


def block_reject_reasons(spark, d):
    return _blocks(spark, d).where("bucket = 'rejected'").select("source_file", "block_id", _joined("reasons"))


def block_context(spark, d):
    sessions = cut(_sessions(spark, d), "sessions")
    return bl.block_context(bl.extract_blocks(sessions, S), sessions).select("source_file", "block_id", F.size("context").alias("n_context"))


def block_numbers(spark, d):
    m = _messages(spark, d)
    return bl.number_sources(bl.blocks_of(m, S), m).select("source_file", "block_id")


def pre_bucket_structural(spark, d):
    return _docs(spark, d).select("doc_id", scoring.structural_bucket(F.col("metrics"), S).alias("bucket"))


def score_documents(spark, d):
    return _scored(spark, d).select("doc_id", "scores.*")


def score_messages(spark, d):
    return _scored_messages(spark, d).select("doc_id", "scores.*")


def classify_documents(spark, d):
    return _decided(spark, d).select("doc_id", "bucket", _joined("reasons"))


def debatable_cap(spark, d):
    return scoring.decide_buckets(_scored(spark, d), ["doc_id"], S.with_(debatable_max_per_run=10)).where("array_contains(reasons, 'debatable_overflow_prioritized') or bucket = 'debatable'").select("doc_id", "bucket")


def bucket_counts(spark, d):
    return pipeline.bucket_counts(_decided(spark, d))


def top_reasons(spark, d):
    return pipeline.top_reasons(_decided(spark, d))


def style_tags(spark, d):
    return scoring.tag_blocks(_scored(spark, d), _words(spark, d), S).select("doc_id", _joined("style_tags"))


def privacy_strict(spark, d):
    return filters.privacy_mode(_scored_messages(spark, d), S.with_(privacy_mode="strict")).where("bucket is not null").select("doc_id", "bucket", _joined("reasons"))


def privacy_recall(spark, d):
    return filters.privacy_mode(_scored_messages(spark, d), S.with_(privacy_mode="recall")).where("bucket is not null").select("doc_id", "bucket", _joined("reasons"))


def mask_words(spark, d):
    return filters.mask_words(_docs(spark, d), _words(spark, d).mask).where("size(reasons) > 0").select("doc_id", F.md5("my_text").alias("text_md5"), _joined("reasons"))


def drop_words(spark, d):
    return filters.drop_sentences(_docs(spark, d), _words(spark, d).drop_sentence).where("bucket = 'rejected'").select("doc_id", _joined("reasons"))


def exact_dedup_keep2(spark, d):
    rows = dedup.limit_copies(_docs(spark, d), F.floor(F.col("doc_id") / 65536), ["doc_id"], 2)
    return rows.where("bucket = 'rejected'").select("doc_id", _joined("reasons"))


def near_dup_pairs(spark, d):
    classes = cut(dedup.text_classes(table(spark, d, "documents"), "doc_id", "text"), "classes")
    return dedup.similar_pairs(classes.where("key = rep"), 0.8).select("a", "b", F.round("similarity", 6).alias("similarity"))


def near_dup_classes(spark, d):
    """The class of each document: near_dup_pairs holds for all members of its two classes."""
    return dedup.text_classes(table(spark, d, "documents"), "doc_id", "text").select(F.col("key").alias("doc_id"), F.col("rep").alias("class_id"))


def near_dup_greedy(spark, d):
    return dedup.near_duplicates(spread(table(spark, d, "documents").select("doc_id", "text")), "doc_id", "text", 0.8).select("doc_id", F.round("similarity", 4).alias("similarity"))


def review_ids(spark, d):
    return filters.with_review_ids(_docs(spark, d)).select("doc_id", "review_id")


def review_decisions(spark, d):
    return filters.latest_decisions(table(spark, d, "review_decisions")).select("kind", "key", "decision", "reason")


def review_apply(spark, d):
    decisions = filters.latest_decisions(table(spark, d, "review_decisions"))
    rows = dedup.limit_copies(_docs(spark, d), F.floor(F.col("doc_id") / 65536), ["doc_id"], 1)
    return filters.apply_decisions(rows, decisions, "doc_id").where("size(reasons) > 0").select("doc_id", "bucket", "manual_keep", _joined("reasons"))


def stratified_sample(spark, d):
    rows = filters.with_review_ids(_decided(spark, d))
    return review.stratified_sample(rows, 20, S.sample_seed).groupBy("stratum", "review_id").agg(F.count(F.lit(1)).alias("n"))


def ngram_freq(spark, d):
    return mining.count_phrases(_texts(spark, d), S).select("n", "phrase", "freq")


def ngram_bucket_freq(spark, d):
    rows = mining.count_phrases(_texts(spark, d), S)
    return rows.select("n", "phrase", *[F.element_at("bucket_freq", b).alias(b) for b in MINED_BUCKETS])


def ngram_pmi(spark, d, s=S):
    texts = _texts(spark, d)
    counts = cut(mining.count_phrases(texts, s, characters=True), "counts")
    lead, _ = mining.leading_phrases(counts, texts, s)
    return mining.phrase_information(lead, counts).select("phrase", F.round("pmi", 4).alias("pmi"))


def ngram_entropy(spark, d, s=S):
    texts = _texts(spark, d)
    lead, around = mining.leading_phrases(mining.count_phrases(texts, s), texts, s)
    rows = mining.neighbour_entropy(cut(lead, "lead"), around)
    return rows.select("phrase", F.round("left_entropy", 4).alias("left_entropy"), F.round("right_entropy", 4).alias("right_entropy"))


def ngram_mined(spark, d, s=S):
    return _mined(spark, d, s).select("phrase", "length", "freq", "suggested_label", "suggested_action", _joined("reasons"), F.round("style_keyness", 1).alias("style_keyness"))


def ngram_candidates(spark, d, s=S):
    return mining.candidates(_mined(spark, d, s)).select("length", "rank", "phrase")


def review_lists(spark, d, s=S):
    return mining.review_lists(cut(_mined(spark, d, s), "mined"), s)


def auto_promote(spark, d, s=PROMOTING):
    w = _words(spark, d)
    return mining.promote(_mined(spark, d, s), s, [*w.analysis, *w.tone]).select("length", "rank", "phrase")


def candidate_append(spark, d, s=S):
    return mining.new_candidates(_mined(spark, d, s), table(spark, d, "ngram_stats").select(F.trim("phrase").alias("phrase"))).select("phrase", "length")


def phrase_clusters(spark, d, s=S):
    rows = mining.candidates(_mined(spark, d, s)).select("phrase", "freq", "style_keyness")
    return cl.clusters(cut(rows, "candidates"), 0.5).select("cluster_id", "canonical_phrase", "size", _joined("link_types"))


def phrase_links(spark, d):
    rows = table(spark, d, "ngram_stats").select(F.trim("phrase").alias("phrase")).where("length(phrase) >= 2").distinct()
    return cl.links(rows, 0.5)


def lexicon_lists(spark, d):
    return _lexicon(spark, d).select("kind", "phrase", "label", "severity", "risk")


def manual_phrases(spark, d):
    return _manual(spark, d)


def stoplist_diagnostics(spark, d):
    entries = table(spark, d, "lexicon")
    return lexicon.diagnose_stoplist(entries.where("kind = 'phrase_stoplist'"), entries.where("kind = 'phrase_bank'"))


def archive_terms(spark, d):
    rows = lexicon.terms(lexicon.archive(table(spark, d, "lexicon")))
    return rows.select("term", "old_category", _joined("all_categories"), "source_file", _joined("labels"))


def _audit(spark, d):
    rows = spread(table(spark, d, "documents").select("bucket", F.col("text").alias("my_text")))
    return lexicon.audit(rows, lexicon.archive(table(spark, d, "lexicon")))


def audit_terms(spark, d):
    return _audit(spark, d).select("term", "old_category", "freq_total", "my_block_count", "candidate_rate", "rejected_rate", F.round("style_keyness", 1).alias("style_keyness"), "suggested_status", _joined("reasons"))


def audit_summary(spark, d):
    return lexicon.audit_summary(cut(_audit(spark, d), "audit"))


def active_lexicon(spark, d, s=S):
    return lexicon.next_active(cut(_audit(spark, d), "audit"), lexicon.archive(table(spark, d, "lexicon")), cut(_mined(spark, d, s), "mined"))


def tuning_ratios(spark, d):
    return reports.ratios(_decided(spark, d))


def pipeline_run(spark, d):
    """The whole run over messages, as bucketed blocks with ids and reasons."""
    decisions = filters.latest_decisions(table(spark, d, "review_decisions"))
    r = pipeline.run(cut(_messages(spark, d), "messages"), S, _words(spark, d), decisions)
    return r.blocks.select("block_id", "source_file", "review_id", "bucket", _joined("reasons"), _joined("style_tags"), "scores.*")


def event_sessions(spark, d):
    from murmurlake.streaming.session_timers import timer_sessions

    rows = table(spark, d, "events").select(F.col("user_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("t"))
    return timer_sessions(rows, "user_id", "t", gap_ms=720 * 60_000, bucket_ms=7 * 86_400_000)


def event_types_map(spark, d):
    """Accounts' first and last event by type: the aggregate form of first and last values."""
    return table(spark, d, "events").groupBy("user_id").agg(
        F.min_by("event_type", F.struct("ts", "event_id")).alias("first_type"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.count(F.lit(1)).alias("n")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        scan_messages, first_present_field, message_type_map, text_strip, own_message_counts, identity_by_name, turn_merge, turn_texts, session_split,
        block_extract, block_metrics, block_texts, block_reject_reasons, block_context, block_numbers, pre_bucket_structural, score_documents, score_messages,
        classify_documents, debatable_cap, bucket_counts, top_reasons, style_tags, privacy_strict, privacy_recall, mask_words, drop_words,
        exact_dedup_keep2, near_dup_pairs, near_dup_classes, near_dup_greedy, review_ids, review_decisions, review_apply, stratified_sample, ngram_freq,
        ngram_bucket_freq, ngram_pmi, ngram_entropy, ngram_mined, ngram_candidates, review_lists, auto_promote, candidate_append, phrase_clusters,
        phrase_links, lexicon_lists, manual_phrases, stoplist_diagnostics, archive_terms, audit_terms, audit_summary, active_lexicon,
        tuning_ratios, pipeline_run, event_sessions, event_types_map,
    )
}
