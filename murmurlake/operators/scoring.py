"""Scores, buckets and tags of blocks: native columns only, no shuffle but for the one top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurlake.config import Settings, Words
from murmurlake.functions import text as tx

SCORES = ("style_score", "privacy_score", "junk_score", "chaos_score")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is computed once a row.

    A long expression that later columns refer to many times would be copied into each of
    them when projections are merged; the optimizer doesn't merge over a generator.
    """
    return df.withColumn(name, F.explode(F.array(value)))


def _points(condition: Column, value: float) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), F.lit(float(value))).otherwise(F.lit(0.0))


def style_score(t: Column, m: Column, w: Words, s: Settings) -> Column:
    chars, turns = m["my_char_count"], m["my_turn_count"]
    size = F.when(chars >= s.good_my_block_chars, F.lit(2.0)).when(chars >= s.min_my_block_chars, F.lit(1.0)).otherwise(F.lit(0.0))
    sentences = F.size(F.filter(F.split(t, tx.SENTENCE_END, -1), lambda x: tx.strip(x) != ""))
    total = (
        size
        + _points(turns >= 3, 1.0)
        + _points(turns >= 5, 0.5)
        + F.least(tx.hits(t, w.analysis) * 2.0, F.lit(6.0))
        + F.least(tx.hits(t, w.tone) * 1.0, F.lit(3.0))
        + _points(t.rlike(tx.NOT_X_BUT_Y), 2.0)
        + _points(t.rlike(tx.FIRST_THEN), 1.5)
        + _points(t.rlike(tx.ANALYSIS_KEY), 1.5)
        + _points(t.rlike(tx.I_FEEL), 1.0)
        + _points(sentences >= 3, 1.0)
        + _points((m["my_msg_count"] >= 5) & (chars >= 100), 1.5)
    )
    return F.round(F.least(total, F.lit(15.0)), 1)


def privacy_score(t: Column, w: Words) -> Column:
    numbers = F.size(F.filter(F.regexp_extract_all(t, F.lit(tx.LONG_NUMBER.replace("[0-9]", r"\d")), F.lit(0)), lambda x: F.length(x) >= 8))
    total = (
        tx.hits(t, w.high_risk, ignore_case=True) * 3.0
        + tx.hits(t, w.medium_risk, ignore_case=True) * 1.5
        + _points(t.rlike(tx.EMAIL), 4.0)
        + _points(t.rlike("(?U)" + tx.PHONE), 4.0)
        + _points(t.rlike("(?U)" + tx.ID_CARD), 5.0)
        + _points(t.rlike(tx.URL), 2.0)
        + numbers * 2.0
    )
    return F.round(F.least(total, F.lit(15.0)), 1)


def junk_score(t: Column, m: Column, non_text_turns: Column, w: Words, s: Settings) -> Column:
    length = F.length(t)
    distinct = F.size(F.array_distinct(F.split(t, "")))
    light = tx.total_occurrences(t, w.light_interruption)
    total = (
        _points((m["my_msg_count"] > 0) & (non_text_turns / m["my_msg_count"] > 0.5), 3.0)
        + _points(t.rlike(tx.PUNCTUATION_ONLY), 5.0)
        + _points(m["short_fragment_ratio"] > s.max_short_fragment_ratio, 3.0)
        + _points((length >= 10) & (distinct / length < 0.2), 4.0)
        + _points(m["total_char_count"] > s.max_block_chars, 3.0)
        + F.when(light >= 3, F.least(light * 0.5, F.lit(3.0))).otherwise(F.lit(0.0))
    )
    return F.round(F.least(total, F.lit(10.0)), 1)


def chaos_score(t: Column, w: Words) -> Column:
    lines = F.split(t, "\n", -1)
    total = (
        F.least(tx.hits(t, w.mild, ignore_case=True) * 1.0, F.lit(3.0))
        + F.least(tx.hits(t, w.strong, ignore_case=True) * 2.0, F.lit(6.0))
        + _points((F.size(lines) >= 5) & (F.size(F.array_distinct(lines)) / F.size(lines) < 0.5), 2.0)
    )
    return F.round(F.least(total, F.lit(10.0)), 1)


def score_blocks(blocks: DataFrame, w: Words, s: Settings) -> DataFrame:
    """Adds the struct ``scores``. A null or empty my_text scores 0 four times."""
    t, m = F.col("my_text"), F.col("metrics")
    if "my_turns" in blocks.columns:
        non_text = F.size(F.filter("my_turns", lambda x: ~x["msg_type"].isin("text", "reply")))
    else:
        non_text = F.lit(0)
    empty = F.coalesce(t, F.lit("")) == ""
    columns = {"style_score": style_score(t, m, w, s), "privacy_score": privacy_score(t, w), "junk_score": junk_score(t, m, non_text, w, s), "chaos_score": chaos_score(t, w)}
    return once(blocks, "scores", F.struct(*[F.when(empty, F.lit(0.0)).otherwise(c).alias(n) for n, c in columns.items()]))


def structural_bucket(m: Column, s: Settings) -> Column:
    """A rough bucket from sizes alone, for phrase mining before any scores exist."""
    chars, short = m["my_char_count"], m["short_fragment_ratio"]
    return (
        F.when((chars >= s.good_my_block_chars) & (m["my_turn_count"] >= 3) & (short <= s.max_short_fragment_ratio), F.lit("candidates"))
        .when(chars >= s.min_my_block_chars, F.lit("micro_style"))
        .when((chars < 10) | (short > 0.8), F.lit("rejected"))
        .otherwise(F.lit("need_anonymize"))
    )


def classify(s: Settings) -> Column:
    """struct<bucket, reason> of a scored block: ordered rules, the first that applies counts."""
    style, privacy, junk, chaos = (F.col("scores")[n] for n in SCORES)
    m = F.col("metrics")
    empty = F.coalesce(F.col("my_text"), F.lit("")) == ""
    shown = lambda c: F.when(empty, F.lit("0")).otherwise(tx.number_text(c))
    out = lambda bucket, reason: F.struct(F.lit(bucket).alias("bucket"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason"))
    styled = style >= s.need_anonymize_min_style_score
    gates = F.array_compact(
        F.array(
            F.when(chaos >= s.max_chaos_ratio_for_candidate * 10, F.lit("chaos")),
            F.when(junk >= 3, F.lit("junk")),
            F.when(m["my_char_ratio"] < 1 - s.max_other_char_ratio_inside_my_block, F.lit("ratio")),
        )
    )
    debatable = F.lit(s.debatable_enable) & (style >= s.debatable_min_style_score)
    failed = (
        F.when(debatable, out("debatable", F.concat(F.lit("debatable_gate_failures:"), F.array_join(gates, ","))))
        .when(chaos >= 2, out("rejected", F.concat(F.lit("candidate_chaotic:"), shown(chaos))))
        .when(junk >= 3, out("rejected", F.concat(F.lit("candidate_junky:"), shown(junk))))
        .otherwise(out("rejected", F.format_string("candidate_low_ratio:%.2f", m["my_char_ratio"])))
    )
    long_enough = m["my_char_count"] >= s.candidate_min_chars_when_style_high
    fallback = F.array_compact(
        F.array(
            F.when(style < s.micro_style_min_style_score, F.concat(F.lit("style_too_low:"), shown(style))),
            F.when(junk >= s.junk_reject_score * 0.4, F.concat(F.lit("elevated_junk:"), shown(junk))),
            F.when(chaos >= s.chaos_separate_score * 0.5, F.concat(F.lit("elevated_chaos:"), shown(chaos))),
        )
    )
    return (
        F.when((privacy >= 8) & styled, out("need_anonymize", "high_privacy_but_has_style"))
        .when(privacy >= 8, out("rejected", "high_privacy_no_style"))
        .when(junk >= s.junk_reject_score, out("rejected", F.concat(F.lit("junk_score_too_higher:"), shown(junk))))
        .when((privacy >= s.privacy_medium_threshold) & styled, out("need_anonymize", "medium_privacy_with_style"))
        .when((chaos >= s.chaos_separate_score) & (style >= 2) & (junk < 4), out("chaos_style", "chaotic_but_has_style"))
        .when((chaos >= s.chaos_separate_score) & (junk >= s.junk_reject_score * 0.5), out("rejected", "chaos_and_junk"))
        .when(chaos >= s.chaos_separate_score, out("chaos_style", "chaos_separated"))
        .when((style >= s.candidate_min_style_score) & long_enough & (F.size(gates) > 0), failed)
        .when((style >= s.candidate_min_style_score) & long_enough, out("candidates", "high_style_score"))
        .when(style >= s.candidate_min_style_score, out("micro_style", "short_but_high_style"))
        .when(style >= s.micro_style_min_style_score, out("micro_style", "low_style_but_has_tone"))
        .otherwise(out("rejected", F.concat(F.lit("rejected_fallback:"), F.array_join(fallback, "|"))))
    )


def decide_buckets(blocks: DataFrame, key: list[str], s: Settings) -> DataFrame:
    """Sets bucket and reasons of every block; ``key`` tells blocks apart and orders ties.

    A block with a bucket keeps it (an unknown one becomes rejected). A block marked
    manual_keep is a candidate unless its privacy score is too high. Then the debatable
    blocks beyond the cap, by style, junk, chaos, ratio and length, are rejected.
    """
    from murmurlake.config import BUCKETS

    manual = F.coalesce(F.col("manual_keep"), F.lit(False)) if "manual_keep" in blocks.columns else F.lit(False)
    manual = manual & (F.col("scores.privacy_score") < s.privacy_medium_threshold)
    preset = F.coalesce(F.col("bucket"), F.lit("")) != ""
    known = F.when(F.col("bucket").isin(*BUCKETS), F.col("bucket")).otherwise(F.lit("rejected"))
    old = F.coalesce("reasons", F.expr("cast(array() as array<string>)"))
    decided = once(blocks, "__c", classify(s)).withColumns(
        {
            "bucket": F.when(preset, known).when(manual, F.lit("candidates")).otherwise(F.col("__c.bucket")),
            "reasons": F.when(preset, old).when(manual, F.array_append(old, F.lit("manual_review_keep"))).otherwise(F.array(F.col("__c.reason"))),
        }
    ).drop("__c")
    return cap_debatable(decided, key, s.debatable_max_per_run)


def cap_debatable(blocks: DataFrame, key: list[str], cap: int) -> DataFrame:
    """Keeps the ``cap`` best debatable blocks; the top-k is taken partition by partition first."""
    order = [
        F.desc("scores.style_score"),
        F.asc("scores.junk_score"),
        F.asc("scores.chaos_score"),
        F.desc("metrics.my_char_ratio"),
        F.desc("metrics.my_char_count"),
    ]
    kept = blocks.where(F.col("bucket") == "debatable").orderBy(*order, *key).limit(cap).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], F.lit(True).alias("__kept"))
    on = F.lit(True)
    for i, k in enumerate(key):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    over = (F.col("bucket") == "debatable") & F.col("__kept").isNull()
    joined = blocks.join(kept, on, "left").withColumn("__over", over)
    return joined.withColumns(
        {
            "bucket": F.when(F.col("__over"), F.lit("rejected")).otherwise(F.col("bucket")),
            "reasons": F.when(F.col("__over"), F.array_append("reasons", F.lit("debatable_overflow_prioritized"))).otherwise(F.col("reasons")),
        }
    ).select(*blocks.columns)


# The limits of the tags.
FRAGMENTED_TURNS, FRAGMENTED_CHARS, REACTION_CHARS, JOKE_CHAOS, JOKE_STYLE, ARGUMENT_TURNS = 4, 200, 30, 3, 3, 3


def tag_blocks(blocks: DataFrame, w: Words, s: Settings) -> DataFrame:
    """Adds the array ``style_tags``, empty where tags are off."""
    if not s.style_tags_enable:
        return blocks.withColumn("style_tags", F.expr("cast(array() as array<string>)"))
    t, m = F.coalesce("my_text", F.lit("")), F.col("metrics")
    style, _, junk, chaos = (F.col("scores")[n] for n in SCORES)
    tags = {
        "analysis_explaining": tx.any_of(t, w.analysis_tag),
        "not_x_but_y_pattern": t.rlike(tx.NOT_X_BUT_Y),
        "qq_fragmented_long_speech": (m["my_turn_count"] >= FRAGMENTED_TURNS) & (m["my_char_count"] >= FRAGMENTED_CHARS),
        "short_reaction": (m["my_char_count"] <= REACTION_CHARS) & (style >= 2),
        "joke_abstract": (chaos >= JOKE_CHAOS) & (style >= JOKE_STYLE),
        "argument": (m["my_turn_count"] >= ARGUMENT_TURNS) & tx.any_of(t, w.argument),
        "low_signal": (style < 2) & (junk < 3),
    }
    return blocks.withColumn("style_tags", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in tags.items()])))


def from_documents(documents: DataFrame) -> DataFrame:
    """The ``documents`` table as blocks: each non-blank line is a turn and a fragment of the one speaker."""
    text = tx.strip(F.coalesce("text", F.lit("")))
    lines = F.filter(F.transform(F.split(text, "\n"), tx.strip), lambda x: x != "")
    base = documents.select("doc_id", F.coalesce("source_file", F.lit("")).alias("source_file"), "block_ord", "source", F.col("bucket").alias("given_bucket"), text.alias("my_text"), lines.alias("fragments"))
    n = F.size("fragments").cast("long")
    chars = F.aggregate("fragments", F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    short = F.size(F.filter("fragments", lambda x: F.length(x) <= 3)).cast("long")
    zero = F.lit(0).cast("long")
    base = base.withColumns({"__n": n, "__c": chars, "__s": short})
    metrics = F.struct(
        F.col("__n").alias("my_msg_count"),
        F.col("__c").alias("my_char_count"),
        F.col("__c").alias("total_char_count"),
        F.col("__n").alias("my_turn_count"),
        zero.alias("other_turn_count"),
        zero.alias("interruption_count"),
        zero.alias("interruption_chars"),
        F.col("__s").alias("short_fragment_count"),
        F.when(F.col("__c") > 0, F.lit(1.0)).otherwise(F.lit(0.0)).alias("my_char_ratio"),
        F.round(F.when(F.col("__n") > 0, F.col("__s") / F.col("__n")).otherwise(F.lit(0.0)), 4).alias("short_fragment_ratio"),
    )
    return base.withColumns(
        {"metrics": metrics, "bucket": F.lit(None).cast("string"), "reasons": F.expr("cast(array() as array<string>)"), "session_id": F.format_string("session_%05d", F.lit(0))}
    ).drop("__n", "__c", "__s")
