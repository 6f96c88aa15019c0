"""Filters on blocks: masks, dropped sentences, privacy modes, review ids and decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurlake.config import Settings, Words
from murmurlake.functions import text as tx

MASK = "[MASKED]"


def _rejected() -> Column:
    return F.coalesce(F.col("bucket") == "rejected", F.lit(False))


def _reject(blocks: DataFrame, condition: Column, reason: Column) -> DataFrame:
    return blocks.withColumn("__hit", F.coalesce(condition, F.lit(False))).withColumns(
        {
            "reasons": F.when(F.col("__hit"), F.array_append("reasons", reason)).otherwise(F.col("reasons")),
            "bucket": F.when(F.col("__hit"), F.lit("rejected")).otherwise(F.col("bucket")),
        }
    ).drop("__hit")


def mask_text(text: Column, words: Sequence[str]) -> Column:
    """struct<text, counts>: words masked one after the other, whatever their case, and the hits of each that had some."""
    zero = F.struct(text.alias("text"), F.expr("cast(array() as array<int>)").alias("counts"))
    patterns = F.array(*[F.lit(tx.quoted(w)) for w in words])

    def one(a: Column, p: Column) -> Column:
        n = F.regexp_count(a["text"], p)
        done = F.struct(F.regexp_replace(a["text"], p, F.lit(MASK.replace("$", r"\$"))).alias("text"), F.array_append(a["counts"], n).alias("counts"))
        return F.when(n > 0, done).otherwise(a)

    # Most texts have none of the words: one pattern tells, and only the others are worked through.
    touched = text.rlike("|".join(tx.quoted(w) for w in words))
    return F.when(touched, F.aggregate(patterns, zero, one)).otherwise(zero)


def mask_words(blocks: DataFrame, words: Sequence[str], nested: bool = False) -> DataFrame:
    """Masks the words in my_text of blocks that aren't rejected; with ``nested`` in fragments too.

    Each word that hit adds the reason masked_word:<hits>. Null texts stay null.
    """
    words = [w for w in words if w]
    if not words:
        return blocks
    work = blocks.withColumn("__m", F.when(~_rejected() & F.col("my_text").isNotNull(), mask_text(F.col("my_text"), words)))
    notes = F.transform(F.col("__m.counts"), lambda n: F.concat(F.lit("masked_word:"), n.cast("string")))
    columns = {
        "my_text": F.coalesce(F.col("__m.text"), F.col("my_text")),
        "reasons": F.when(F.col("__m").isNotNull(), F.concat("reasons", notes)).otherwise(F.col("reasons")),
    }
    if nested and "fragments" in blocks.columns:
        columns["fragments"] = F.when(F.col("__m").isNotNull(), F.transform("fragments", lambda f: mask_text(f, words)["text"])).otherwise(F.col("fragments"))
    return work.withColumns(columns).select(*blocks.columns)


def drop_sentences(blocks: DataFrame, words: Sequence[str]) -> DataFrame:
    """Rejects blocks with a drop word; the reason names the first word of the list that is there."""
    words = [w for w in words if w]
    if not words:
        return blocks
    first = F.coalesce(*[F.when(F.col("my_text").rlike(tx.quoted(w)), F.lit(w)) for w in words])
    work = blocks.withColumn("__w", F.when(~_rejected(), first))
    return _reject(work, F.col("__w").isNotNull(), F.concat(F.lit("dropped_by_sentence_word:"), F.col("__w"))).drop("__w")


def privacy_mode(blocks: DataFrame, s: Settings) -> DataFrame:
    """Masks private names and places, then applies the mode: strict rejects, recall rescues, balanced leaves."""
    masked = mask_words(blocks, [*s.private_names, *s.private_places], s.mask_nested)
    privacy, style = F.col("scores.privacy_score"), F.col("scores.style_score")
    unset = F.coalesce(F.col("bucket"), F.lit("")) == ""
    score = tx.number_text(privacy)
    if s.privacy_mode == "strict":
        open_ = unset | F.col("bucket").isin("candidates", "micro_style")
        return _reject(masked, (privacy > 3) & open_, F.concat(F.lit("strict_privacy:score="), score))
    if s.privacy_mode == "recall":
        hit = unset & (privacy >= 5) & (privacy < 10) & (style >= 2)
        return masked.withColumns(
            {
                "reasons": F.when(hit, F.array_append("reasons", F.concat(F.lit("recall_privacy:score="), score))).otherwise(F.col("reasons")),
                "bucket": F.when(hit, F.lit("need_anonymize")).otherwise(F.col("bucket")),
            }
        )
    return masked


def apply_filters(blocks: DataFrame, w: Words, s: Settings) -> DataFrame:
    """Drop words, then mask words and once more the private ones; lexicon lists win over the settings' own."""
    dropped = drop_sentences(blocks, w.drop_sentence or s.drop_sentence_words)
    masks = [*(w.mask or s.mask_words), *s.private_names, *s.private_places]
    return mask_words(dropped, masks, s.mask_nested)


def review_id() -> Column:
    source = F.when(F.coalesce("source_file", F.lit("")) == "", F.lit("unknown-source")).otherwise(F.col("source_file"))
    return F.substring(F.sha2(F.concat_ws("\u0000", source, F.col("session_id"), F.coalesce("my_text", F.lit(""))), 256), 1, 24)


def with_review_ids(blocks: DataFrame) -> DataFrame:
    return blocks.withColumn("review_id", review_id())


def latest_decisions(decisions: DataFrame, line: str = "line_no", key: str = "decision_key") -> DataFrame:
    """(kind, key, decision, reason): the last valid line of each kind and trimmed key.

    Kinds other than phrase and block, blank keys and decisions that aren't exactly
    keep or drop are no decisions.
    """
    d = decisions.select("kind", tx.strip(F.col(key)).alias("key"), "decision", "reason", F.col(line).alias("line")).where(
        F.col("kind").isin("phrase", "block") & (F.length("key") > 0) & F.col("decision").isin("keep", "drop")
    )
    return d.groupBy("kind", "key").agg(F.max_by(F.struct("decision", "reason"), "line").alias("d")).select("kind", "key", "d.decision", "d.reason")


def apply_decisions(blocks: DataFrame, decisions: DataFrame, on: str = "review_id") -> DataFrame:
    """Applies block decisions: drops reject, keeps set manual_keep unless a filter came first.

    The join takes its way from the tables' sizes; nothing is forced to be broadcast.
    """
    d = decisions.where(F.col("kind") == "block").select(F.col("key").alias("__key"), F.col("decision").alias("__d"))
    joined = blocks.join(d, F.col(on).cast("string") == F.col("__key"), "left")
    preset = F.coalesce(F.col("bucket"), F.lit("")) != ""
    drop, keep = F.coalesce(F.col("__d") == "drop", F.lit(False)), F.coalesce(F.col("__d") == "keep", F.lit(False))
    note = F.when(drop, F.lit("manual_review_drop")).when(keep & preset, F.lit("manual_review_keep_blocked_by_prior_filter")).when(keep, F.lit("manual_review_keep_requested"))
    return joined.withColumns(
        {
            "__note": note,
            "manual_keep": keep & ~preset,
        }
    ).withColumns(
        {
            "reasons": F.when(F.col("__note").isNotNull(), F.array_append("reasons", F.col("__note"))).otherwise(F.col("reasons")),
            "bucket": F.when(drop, F.lit("rejected")).otherwise(F.col("bucket")),
        }
    ).drop("__key", "__d", "__note")
