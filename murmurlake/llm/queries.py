"""Queries of the training-data problems 1 and 5 to 10, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurlake.llm import conversations, keyness, mixing, moderation, packing, pii, spans, tokens
from murmurlake.plans.data_queries import CLOCK
from murmurlake.session import cut
from murmurlake.sources.tables import table


def _scored_phrases(spark: SparkSession, folder: str, steps: int = keyness.EM_STEPS) -> DataFrame:
    return keyness.score_terms(cut(keyness.latest_counts(table(spark, folder, "ngram_stats")), "counts"), steps=steps)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return keyness.characteristic(_scored_phrases(spark, folder)).select("run_id", "phrase")


def p1_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every phrase of every run with its posterior, next to the recorded style_keyness."""
    rows = _scored_phrases(spark, folder)
    return rows.select("run_id", "phrase", "n", F.round("posterior", 6).alias("posterior"), F.round("lift", 6).alias("lift"), F.col("recorded").alias("style_keyness"))


def _abuse(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    messages = table(spark, folder, "messages")
    weights = moderation.learned_weights(messages, table(spark, folder, "moderation_labels"))
    return moderation.score_texts(messages.select(*columns, "text"), weights=weights)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _abuse(spark, folder, "row_id").where(F.col("abuse_score") >= moderation.THRESHOLD - 1e-9).select("row_id")


def p5_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _abuse(spark, folder, "row_id").select("row_id", "abuse_score", "abuse_kind")


def p5_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rate of each source file."""
    return moderation.rates(_abuse(spark, folder, "source_file"), "source_file")


def _turns(spark: SparkSession, folder: str, *keep: str) -> tuple[DataFrame, DataFrame]:
    return conversations.fold_versions(table(spark, folder, "messages"), keep), table(spark, folder, "chat_files")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.defects(conversations.judge(*_turns(spark, folder)))


def p6_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """The turns of the conversations that are left, in order and with roles."""
    turns, files = _turns(spark, folder, "text")
    turns = cut(turns, "turns")
    return conversations.rebuild(turns, files, conversations.judge(turns, files))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    candidates, model = pii.fit(table(spark, folder, "messages"), "row_id", "text")
    return pii.found_spans(candidates, model, "row_id").select("row_id", "pii_type", "start_pos")


def p7_masked(spark: SparkSession, folder: str) -> DataFrame:
    messages = table(spark, folder, "messages")
    _, model = pii.fit(messages, "row_id", "text")
    return pii.redact(messages.select("row_id", "text"), model, "text").select("row_id", "masked_text")


def _sizes(spark: SparkSession, folder: str) -> DataFrame:
    return cut(tokens.token_counts(table(spark, folder, "documents"), ["doc_id", "source"], "text"), "sizes")


def p8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_sizes(spark, folder), table(spark, folder, "container_sizes"))


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return packing.report(_sizes(spark, folder), table(spark, folder, "container_sizes"))


def p8_check(spark: SparkSession, folder: str) -> DataFrame:
    """What a packing has to keep to, by kind: documents placed, containers too full, documents with tokens lost or doubled, split ones that would have fit."""
    sizes, kinds = _sizes(spark, folder), table(spark, folder, "container_sizes")
    rows = cut(packing.pack(sizes, kinds), "packed").join(F.broadcast(kinds), "container_kind")
    by_container = rows.groupBy("container_kind", "container_id").agg(F.sum("size").alias("n"), F.max("capacity_tokens").alias("c"))
    full = by_container.groupBy("container_kind").agg(F.count_if(F.col("n") > F.col("c")).alias("too_full"), (F.sum("n") / F.sum("c") >= 0.98).alias("well_filled"))
    by_doc = rows.groupBy("container_kind", "doc_id").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("pieces"), F.max("capacity_tokens").alias("c"))
    kept = by_doc.join(sizes, "doc_id", "left").groupBy("container_kind").agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.count_if(F.col("n") != F.col("n_tokens")).alias("wrong_tokens"),
        F.count_if((F.col("pieces") > 1) & (F.col("n_tokens") <= F.col("c"))).alias("needlessly_split"),
    )
    return kept.join(full, "container_kind")


def p9_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(_sizes(spark, folder), table(spark, folder, "mix_targets"))


def p9_report(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_report(_sizes(spark, folder), table(spark, folder, "mix_targets"))


def p9_check(spark: SparkSession, folder: str) -> DataFrame:
    """What a mix has to keep to, by source: its share within half a per cent of the target, no document used too often."""
    rows = mixing.mix_report(_sizes(spark, folder), table(spark, folder, "mix_targets"))
    return rows.select(
        "source", (F.abs(F.col("actual_share") - F.col("target_share")) <= 0.005).alias("share_reached"), (F.col("most_repeats") <= F.col("max_repeats")).alias("within_repeats")
    )


def _spans(spark: SparkSession, folder: str) -> spans.SharedSpans:
    return spans.SharedSpans(table(spark, folder, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return _spans(spark, folder).pairs().select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def p10_links(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs of classes of equal texts, by their least doc_id, that share a run."""
    return _spans(spark, folder).links().select(F.col("ref_a").alias("class_a"), F.col("ref_b").alias("class_b"))


def p10_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The class of equal texts of each document and the number of its links."""
    return _spans(spark, folder).classes().select("doc_id", F.col("class").alias("class_id"), "copies", "n_links")


def p10_shared(spark: SparkSession, folder: str) -> DataFrame:
    """How much of each document is shared elsewhere."""
    return _spans(spark, folder).report()


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p1_found": p1_found,
    "p1_scores": p1_scores,
    "p5_found": p5_found,
    "p5_scores": p5_scores,
    "p5_rates": p5_rates,
    "p6_found": p6_found,
    "p6_conversations": p6_conversations,
    "p7_found": p7_found,
    "p7_masked": p7_masked,
    "p8_packing": p8_packing,
    "p8_report": p8_report,
    "p8_check": p8_check,
    "p9_mix": p9_mix,
    "p9_report": p9_report,
    "p9_check": p9_check,
    "p10_found": p10_found,
    "p10_links": p10_links,
    "p10_classes": p10_classes,
    "p10_shared": p10_shared,
}

_COUNTS = """
c AS (SELECT run_id, trim(phrase) AS phrase, mined_at,
    CAST(coalesce(CASE WHEN bucket_freq IS NULL THEN NULL ELSE coalesce(list_sum(map_values(bucket_freq)), 0) END, freq, 0) AS BIGINT) AS n
  FROM ngram_stats WHERE run_id IS NOT NULL AND length(trim(phrase)) > 0),
l AS (SELECT run_id, phrase, n FROM (SELECT *, row_number() OVER (PARTITION BY run_id, phrase ORDER BY mined_at DESC NULLS LAST, n DESC) AS k FROM c) WHERE k = 1),
r AS (SELECT run_id, sum(n) AS rn FROM l GROUP BY run_id),
p AS (SELECT phrase, sum(n) AS pn, count(*) FILTER (WHERE n > 0) AS runs FROM l GROUP BY phrase)
"""

# Written from TESTDATA.md: "left" are the rows that are neither recalled nor system rows and have a non-blank text.
_FOLDED = f"""
{CLOCK},
f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, coalesce('m' || msg_id, 'r' || CAST(row_id AS VARCHAR)) ORDER BY ingested_at DESC NULLS LAST, row_id DESC) AS k
  FROM clock WHERE conv_id IS NOT NULL) WHERE k = 1),
o AS (SELECT source_file AS sf, max(self_uid) AS me FROM chat_files GROUP BY source_file),
s AS (SELECT f.*, CASE WHEN regexp_full_match(seq, '\\s*-?[0-9]+(\\.0)?\\s*') THEN CAST(regexp_replace(trim(seq), '\\.0$', '') AS HUGEINT) END AS q,
    coalesce(who = me, false) AS mine, NOT coalesce(recalled, false) AND NOT coalesce(is_system, false) AS visible
  FROM f LEFT JOIN o ON f.source_file = o.sf),
l AS (SELECT conv_id, count(DISTINCT mine) AS roles FROM s WHERE visible AND NOT regexp_full_match(coalesce(text, ''), '[\\s\\p{{Z}}]*') GROUP BY conv_id),
w AS (SELECT *, q - lag(q) OVER (PARTITION BY conv_id ORDER BY q NULLS LAST) AS step,
    max(t) OVER (PARTITION BY conv_id ORDER BY q NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS late FROM s),
v AS (SELECT conv_id, broken, q0, coalesce(roles, 0) AS roles FROM (SELECT conv_id, count(*) FILTER (WHERE q IS NULL OR step <> 1 OR late > t) > 0 AS broken,
    min(q) AS q0 FROM w GROUP BY conv_id) LEFT JOIN l USING (conv_id))
"""

# All windows of 60 characters, and those that two documents have.
_WINDOWS = """w AS (SELECT doc_id, i, substr(text, CAST(i AS BIGINT), 60) AS s FROM
    (SELECT doc_id, text, unnest(generate_series(1, length(text) - 59)) AS i FROM documents WHERE length(text) >= 60)),
  g AS (SELECT s FROM w GROUP BY s HAVING count(DISTINCT doc_id) > 1)"""

ORACLES: dict[str, str] = {
    "p1_found": f"""WITH {_COUNTS} SELECT l.run_id, l.phrase FROM l JOIN r USING (run_id) JOIN p USING (phrase)
        WHERE runs >= 2 AND l.n > 0 AND l.n * 50 >= rn AND l.n * (SELECT sum(n) FROM l) >= pn * 4 * rn""",
    "p6_found": f"""WITH {_FOLDED}
        SELECT conv_id, 'broken' AS defect FROM v WHERE broken UNION ALL
        SELECT conv_id, 'empty' FROM v WHERE roles = 0 UNION ALL
        SELECT conv_id, 'no_reply' FROM v WHERE roles = 1""",
    "p6_conversations": f"""WITH {_FOLDED}
        SELECT conv_id, CAST(q - q0 AS BIGINT) AS position, CASE WHEN mine THEN 'me' ELSE 'other' END AS role, text, t AS time_ms, row_id
        FROM s JOIN v USING (conv_id) WHERE visible AND NOT broken AND roles = 2""",
    "p8_check": """SELECT container_kind, count(*) AS n_documents, CAST(0 AS BIGINT) AS wrong_tokens, CAST(0 AS BIGINT) AS needlessly_split, CAST(0 AS BIGINT) AS too_full, true AS well_filled
        FROM container_sizes, documents WHERE length(text) > 0 GROUP BY container_kind""",
    "p9_check": "SELECT source, true AS share_reached, true AS within_repeats FROM mix_targets",
    "p10_found": f"""WITH {_WINDOWS}, x AS (SELECT DISTINCT doc_id, s FROM w JOIN g USING (s))
        SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM x a JOIN x b ON a.s = b.s AND a.doc_id < b.doc_id""",
    "p10_links": f"""WITH {_WINDOWS}, c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS k FROM documents WHERE length(text) >= 60),
        x AS (SELECT DISTINCT k, s FROM w JOIN g USING (s) JOIN c USING (doc_id))
        SELECT DISTINCT a.k AS class_a, b.k AS class_b FROM x a JOIN x b ON a.s = b.s AND a.k < b.k""",
    "p10_classes": f"""WITH {_WINDOWS}, c AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS k, count(*) OVER (PARTITION BY text) AS copies FROM documents WHERE length(text) >= 60),
        x AS (SELECT DISTINCT k, s FROM w JOIN g USING (s) JOIN c USING (doc_id)),
        l AS (SELECT a.k, count(DISTINCT b.k) AS n FROM x a JOIN x b ON a.s = b.s AND a.k <> b.k GROUP BY a.k)
        SELECT doc_id, c.k AS class_id, coalesce(copies, 1) AS copies, coalesce(n, 0) AS n_links FROM documents LEFT JOIN c USING (doc_id) LEFT JOIN l ON l.k = c.k""",
    "p10_shared": f"""WITH {_WINDOWS}, p AS (SELECT DISTINCT doc_id, i FROM w JOIN g USING (s)),
        d AS (SELECT doc_id, least(60, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 60)) AS n FROM p),
        t AS (SELECT doc_id, sum(n) AS n FROM d GROUP BY doc_id)
        SELECT doc_id, coalesce(length(text), 0) AS n_chars, CAST(coalesce(n, 0) AS BIGINT) AS shared_chars,
          CASE WHEN length(text) > 0 THEN round(coalesce(n, 0) / length(text), 6) ELSE 0.0 END AS shared_rate FROM documents LEFT JOIN t USING (doc_id)""",
}
