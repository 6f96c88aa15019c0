"""Lexicons: word lists, diagnostics, archive, frequency audit and the next active set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from murmurlake.config import MINED_BUCKETS, Words
from murmurlake.functions import text as tx
from murmurlake.functions.jsons import document
from murmurlake.sources import files

#: One row of a lexicon in any form: files become this, the stored table is it.
SCHEMA = "entry_no int, kind string, phrase string, label string, severity string, risk string, status string"

# Kinds of lexicon and what their entries become in an archive.
KINDS = ("phrase_bank", "chaos_lexicon", "privacy_lexicon", "drop_sentence_words", "mask_words", "phrase_candidates", "manual_keep", "manual_drop", "phrase_stoplist")

#: A lexicon is edited by hand; one that exceeds this isn't one, and isn't brought to the driver.
MOST_ENTRIES = 100_000

# Thresholds of the audit and of the next active set.
PROMOTE_FREQ, CANDIDATE_FREQ, STOPLIST_FREQ = 8, 2, 10
CANDIDATE_RATE, REJECTED_RATE, DEMOTE_RATE = 0.4, 0.2, 0.35
ACTIVE_FREQ, ACTIVE_RATE = 3, 0.15


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(entry_no, line) of a lexicon file or folder, numbered in order over all its splits."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "^\ufeff", "").alias("line"))
    # A lexicon has at most MOST_ENTRIES lines, so one window over all of them is small.
    return lines.select((F.row_number().over(Window.orderBy("id")) - 1).cast("int").alias("entry_no"), "line")


def read_jsonl(spark: SparkSession, path: str, kind: str, with_category: bool = False) -> DataFrame:
    """A JSON-lines lexicon: byte-order marks, blank lines and lines that don't parse are passed over."""
    schema = "struct<phrase:string,label:string,severity:string,risk:string,status:string,old_category:string>"
    parsed = _numbered_lines(spark, path).select("entry_no", F.from_json("line", schema).alias("e"), document("line").alias("v"))
    own = parsed.where(F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))).select("entry_no", F.lit(kind).alias("kind"), "e.*")
    return own if with_category else own.drop("old_category")


def read_stoplist(spark: SparkSession, path: str) -> DataFrame:
    """A stoplist: # starts a comment line, " #" a comment after a phrase; repeats are kept for diagnosis."""
    lines = _numbered_lines(spark, path).select("entry_no", tx.strip(F.col("line")).alias("line"))
    phrase = tx.strip(F.split("line", " #")[0])
    return lines.where(~F.col("line").startswith("#")).select("entry_no", F.lit("phrase_stoplist").alias("kind"), phrase.alias("phrase")).where("phrase <> ''").select(
        "entry_no", "kind", "phrase", *[F.lit(None).cast("string").alias(c) for c in ("label", "severity", "risk", "status")]
    )


def active(entries: DataFrame) -> DataFrame:
    """The entries that take part in matching: not archived, with a phrase; the latest status of a repeated entry counts."""
    own = entries.withColumn("phrase", tx.strip(F.col("phrase"))).where(F.length("phrase") > 0)
    latest = own.groupBy("kind", "phrase").agg(F.max_by(F.struct(*[c for c in own.columns if c not in ("kind", "phrase")]), "entry_no").alias("e"))
    return latest.select("kind", "phrase", "e.*").where(F.coalesce("status", F.lit("active")) != "archived")


def word_lists(entries: DataFrame) -> Words:
    """The derived word lists, in entry order; a phrase dropped by hand isn't a marker any more."""
    rows = entries.orderBy("entry_no").limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"a lexicon of more than {MOST_ENTRIES} entries")
    dropped = {r["phrase"] for r in rows if r["kind"] == "manual_drop"}
    bank = [r for r in rows if r["kind"] == "phrase_bank" and r["phrase"] not in dropped] + [r for r in rows if r["kind"] == "manual_keep"]
    labelled = lambda label: tuple(r["phrase"] for r in bank if (r["label"] or ("manual_keep" if r["kind"] == "manual_keep" else "unlabeled")) == label)
    of = lambda kind, field=None, value=None: tuple(r["phrase"] for r in rows if r["kind"] == kind and (field is None or r[field] == value))
    return Words(
        analysis=labelled("analysis_marker"),
        tone=labelled("tone_marker"),
        light_interruption=labelled("light_interruption"),
        argument=labelled("argument_marker"),
        analysis_tag=labelled("analysis_tag_marker"),
        mild=of("chaos_lexicon", "severity", "mild"),
        strong=of("chaos_lexicon", "severity", "strong"),
        high_risk=of("privacy_lexicon", "risk", "high"),
        medium_risk=of("privacy_lexicon", "risk", "medium"),
        drop_sentence=of("drop_sentence_words"),
        mask=of("mask_words"),
        stoplist=of("phrase_stoplist"),
        manual_keep=of("manual_keep"),
        manual_drop=of("manual_drop"),
    )


def manual_phrases(entries: DataFrame, decisions: DataFrame) -> DataFrame:
    """(phrase, decision): phrases kept or dropped by hand; a reviewer's decision overrides the lists."""
    listed = entries.where(F.col("kind").isin("manual_keep", "manual_drop")).select("phrase", F.substring("kind", 8, 4).alias("listed"))
    reviewed = decisions.where(F.col("kind") == "phrase").select(F.col("key").alias("phrase"), F.col("decision").alias("reviewed"))
    # A phrase may be on both lists; a review leaves it on one.
    return listed.distinct().join(reviewed, "phrase", "full").select("phrase", F.coalesce("reviewed", "listed").alias("decision")).distinct()


def diagnose_stoplist(stoplist: DataFrame, bank: DataFrame) -> DataFrame:
    """(metric, item, value): totals, repeated entries, conflicts with the phrase bank by label, and lengths.

    ``stoplist`` has phrase with its repeats; of repeated bank phrases the last label counts.
    """
    entries = stoplist.select("phrase").where("phrase <> ''")
    counts = entries.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    labels = bank.where("phrase is not null and phrase <> ''").groupBy("phrase").agg(F.max_by(F.coalesce("label", F.lit("unlabeled")), "entry_no").alias("label"))
    conflicts = counts.join(labels, "phrase")
    size = F.when(F.length("phrase") >= 5, F.lit("5plus")).otherwise(F.length("phrase").cast("string"))
    row = lambda df, metric, item, value: df.select(F.lit(metric).alias("metric"), item.alias("item"), value.cast("long").alias("value"))
    none = F.lit("")
    return (
        row(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v")), "total_entries", none, F.col("v"))
        .union(row(counts.agg(F.count(F.lit(1)).alias("v")), "unique_entries", none, F.col("v")))
        .union(row(counts.where("n > 1"), "duplicate", F.col("phrase"), F.col("n")))
        .union(row(conflicts, "conflict", F.concat_ws(":", "phrase", "label"), F.lit(1)))
        .union(row(conflicts.groupBy("label").agg(F.count(F.lit(1)).alias("v")), "conflict_category", F.col("label"), F.col("v")))
        .union(row(entries.groupBy(size.alias("s")).agg(F.count(F.lit(1)).alias("v")), "length", F.col("s"), F.col("v")))
    )


def archive(entries: DataFrame, at: Column | None = None) -> DataFrame:
    """The entries as archive terms: with old_category, archived_at, source_file, and out of matching."""
    of = lambda c: F.coalesce(F.col(c), F.lit("unknown"))
    kind = F.col("kind")
    category = (
        F.when(kind == "phrase_bank", F.concat(F.lit("style_markers."), of("label")))
        .when(kind == "chaos_lexicon", F.concat(F.lit("chaos."), of("severity")))
        .when(kind == "privacy_lexicon", F.concat(F.lit("privacy."), of("risk")))
        .when(kind == "drop_sentence_words", F.lit("filter.drop_sentence"))
        .when(kind == "mask_words", F.lit("filter.mask"))
        .when(kind == "phrase_candidates", F.lit("phrase_mining.candidates"))
        .when(kind == "phrase_stoplist", F.lit("phrase_mining.stoplist"))
        .when(kind == "manual_keep", F.lit("manual.keep"))
        .when(kind == "manual_drop", F.lit("manual.drop"))
        .otherwise(F.lit("unknown"))
    )
    suffix = F.when(kind == "phrase_stoplist", F.lit(".txt")).otherwise(F.lit(".jsonl"))
    return entries.withColumns(
        {
            "old_category": category,
            "archived_at": F.date_format(at if at is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "participates_in_matching": F.lit(False),
            "source_file": F.concat(kind, suffix),
        }
    )


def terms(archived: DataFrame) -> DataFrame:
    """(term, ord, old_category, all_categories, source_file, all_source_files, labels): one row per phrase, in order of first sight."""
    own = archived.withColumn("term", tx.strip(F.col("phrase"))).where(F.length("term") > 0)
    label = F.coalesce("label", "severity", "risk", F.lit(""))
    place = F.struct(F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind")).alias("k"), "entry_no")
    listed = F.array_sort(F.collect_list(F.struct(place.alias("o"), F.col("source_file").alias("f"), F.col("old_category").alias("c"), label.alias("l"))))
    distinct = lambda f: F.array_distinct(F.transform("x", lambda e: e[f]))
    grouped = own.groupBy("term").agg(listed.alias("x"))
    return grouped.select(
        "term",
        F.element_at("x", 1)["o"].alias("ord"),
        F.element_at("x", 1)["c"].alias("old_category"),
        distinct("c").alias("all_categories"),
        F.element_at("x", 1)["f"].alias("source_file"),
        distinct("f").alias("all_source_files"),
        F.filter(distinct("l"), lambda v: v != "").alias("labels"),
    )


def term_counts(blocks: DataFrame, words: list[str], at_once: int = 2000) -> DataFrame:
    """(term, bucket, n): blocks of each bucket that contain each term.

    Up to ``at_once`` terms are looked for in place; more are found by a join on substrings
    of the terms' lengths, which is spread over the cluster whatever the number of terms.
    """
    texts = blocks.select("bucket", "my_text").where("my_text is not null and my_text <> ''")
    if not words:
        return texts.select(F.lit("").alias("term"), "bucket", F.lit(0).cast("long").alias("n")).limit(0)
    if len(words) <= at_once:
        found = F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(F.col("my_text"), w))
        return texts.select("bucket", F.explode(found).alias("term")).groupBy("term", "bucket").agg(F.count(F.lit(1)).alias("n"))
    listed = blocks.sparkSession.createDataFrame([(w,) for w in words], "term string")
    lengths = sorted({len(w) for w in words})
    chars = F.split("my_text", "")

    def windows(n: int) -> Column:
        at = F.sequence(F.lit(1), F.length("my_text") - n + 1)
        cells = F.transform(at, lambda i: F.array_join(F.slice(chars, i, F.lit(n)), ""))
        return F.when(F.length("my_text") >= n, cells).otherwise(F.expr("cast(array() as array<string>)"))

    parts = F.concat(*[windows(n) for n in lengths])
    return texts.select("bucket", F.explode(F.array_distinct(parts)).alias("term")).join(listed, "term").groupBy("term", "bucket").agg(F.count(F.lit(1)).alias("n"))


def classify_terms(rows: DataFrame) -> DataFrame:
    """Adds rates, keyness, suggested_status and reasons to (term, old_category, freq_total, bucket_freq)."""
    b = lambda k: F.coalesce(F.try_element_at("bucket_freq", F.lit(k)), F.lit(0))
    total = F.greatest("freq_total", F.lit(1))
    good, rejected = b("candidates") + b("micro_style"), b("rejected")
    bad = rejected + b("chaos_style") + b("need_anonymize")
    keyness = F.when(bad <= 0, good / F.greatest(F.lit(1.0), total * 0.1) * 2.0).otherwise(good / F.greatest(F.lit(1), bad))
    work = rows.withColumns({"__c": good / total, "__r": rejected / total, "__k": keyness})
    c, r, k, f, cat = F.col("__c"), F.col("__r"), F.col("__k"), F.col("freq_total"), F.col("old_category")
    out = lambda status, *why: F.struct(F.lit(status).alias("status"), F.array_compact(F.array(*[F.lit(w) if isinstance(w, str) else w for w in why])).alias("why"))
    filter_word = cat.startswith("filter.drop_sentence") | cat.startswith("filter.mask")
    low = F.when(c < CANDIDATE_RATE, F.lit("low_candidate_ratio"))
    verdict = (
        F.when(f == 0, out("demote_or_remove", "zero_frequency"))
        .when(cat.startswith("privacy.") & (f >= PROMOTE_FREQ), out("keep_in_privacy_lexicon", "verified_privacy_term"))
        .when(cat.startswith("privacy."), out("demote_or_remove", "low_frequency_privacy_term"))
        .when(cat.contains("strong"), out("keep_in_chaos_lexicon", "strong_chaos_isolated"))
        .when(filter_word & (f >= PROMOTE_FREQ), out("promote_to_active", "verified_filter_word"))
        .when(filter_word & (f >= CANDIDATE_FREQ), out("keep_as_candidate", "low_frequency_filter_word"))
        .when(filter_word, out("demote_or_remove", "unused_filter_word"))
        .when(cat.startswith("phrase_mining.stoplist") & (f >= STOPLIST_FREQ), out("keep_in_stoplist", "high_frequency_stopword"))
        .when(cat.startswith("phrase_mining.stoplist"), out("demote_or_remove", "low_impact_stopword"))
        .when((f >= PROMOTE_FREQ) & (c >= CANDIDATE_RATE) & (r <= REJECTED_RATE), out("promote_to_active", "high_frequency", "high_candidate_presence", "low_rejected_presence"))
        .when((f >= CANDIDATE_FREQ) & (r > DEMOTE_RATE), out("demote_or_remove", "high_rejected_presence", low))
        .when(f >= CANDIDATE_FREQ, out("keep_as_candidate", "moderate_frequency", low))
        .otherwise(out("demote_or_remove", F.when(r > DEMOTE_RATE, F.lit("high_rejected_presence")), "very_low_frequency"))
    )
    more = F.array_compact(
        F.array(
            F.when((k > 2.0) & (F.col("__v.status") != "promote_to_active"), F.lit("notable_style_keyness_despite_other_factors")),
            F.when(c > 0.5, F.lit("strong_candidate_signal")),
        )
    )
    single = F.length("term") <= 1
    judged = work.withColumn("__v", verdict).withColumn("__why", F.concat("__v.why", more))
    return judged.select(
        *rows.columns,
        F.round("__c", 4).alias("candidate_rate"),
        F.round("__r", 4).alias("rejected_rate"),
        F.round("__k", 2).alias("style_keyness"),
        F.when(single, F.lit("demote_or_remove")).otherwise(F.col("__v.status")).alias("suggested_status"),
        F.when(single, F.array(F.lit("single_character_noise"))).otherwise(F.col("__why")).alias("reasons"),
    )


def audit(blocks: DataFrame, archived: DataFrame) -> DataFrame:
    """The audit of archived terms over bucketed blocks: counts of blocks by bucket and a suggested status.

    Debatable blocks count in my_block_count only. Terms that no block has are audited too.
    """
    listed = terms(archived)
    words = [r["term"] for r in listed.select("term").limit(MOST_ENTRIES + 1).collect()]
    if len(words) > MOST_ENTRIES:
        raise ValueError(f"an archive of more than {MOST_ENTRIES} terms")
    counts = term_counts(blocks, words).groupBy("term").agg(
        *[F.coalesce(F.sum(F.when(F.col("bucket") == b, F.col("n"))), F.lit(0)).alias(b) for b in MINED_BUCKETS], F.sum("n").alias("my_block_count")
    )
    rows = listed.join(counts, "term", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    total = zero(MINED_BUCKETS[0])
    for b in MINED_BUCKETS[1:]:
        total = total + zero(b)
    shaped = rows.select(
        *listed.columns, total.alias("freq_total"), F.create_map(*[x for b in MINED_BUCKETS for x in (F.lit(b), zero(b))]).alias("bucket_freq"), zero("my_block_count").alias("my_block_count")
    )
    return classify_terms(shaped)


def audit_summary(audited: DataFrame) -> DataFrame:
    """(metric, item, value) of an audit: totals, statuses, source files and categories."""
    status, cat = F.col("suggested_status"), F.col("old_category")
    totals = audited.agg(
        F.count(F.lit(1)).alias("total_terms_audited"),
        F.coalesce(F.sum("freq_total"), F.lit(0)).alias("total_occurrences"),
        F.count_if(status == "promote_to_active").alias("promote_to_active"),
        F.count_if(status == "keep_as_candidate").alias("keep_as_candidate"),
        F.count_if(status == "demote_or_remove").alias("demote_or_remove"),
        F.count_if(status.contains("privacy")).alias("privacy_terms"),
        F.count_if(status.contains("chaos")).alias("chaos_terms"),
        F.count_if(cat.startswith("filter.")).alias("filter_terms"),
        F.count_if(F.col("freq_total") == 0).alias("zero_frequency_terms"),
    )
    wide = totals.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.lit("").alias("item"), F.col(c).cast("long").alias("value")) for c in totals.columns])).alias("x")).select("x.*")
    by = lambda c, name: audited.groupBy(F.col(c).alias("item")).agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "item", "value")
    return wide.union(by("source_file", "by_source_file")).union(by("old_category", "by_old_category"))


_ACTIVE = ("file", "phrase", "label", "severity", "risk", "source", "status")


def next_active(audited: DataFrame, archived: DataFrame, mined: DataFrame) -> DataFrame:
    """(file, phrase, label, severity, risk, source, status): the next active lexicon, one row per file and phrase.

    ``mined`` has phrase, freq, bucket_freq, min_pmi, style_keyness, chaos_rate and
    privacy_bucket_rate. Of entries with one phrase in a file the last counts.
    """
    a = audited.select("term", "suggested_status", "freq_total", "candidate_rate", F.col("style_keyness").alias("key"), "all_categories", F.col("old_category").alias("audited_category"))
    seen = (F.col("freq_total") >= ACTIVE_FREQ) & (F.col("candidate_rate") >= ACTIVE_RATE)
    verified = F.col("suggested_status").isin("promote_to_active", "keep_in_privacy_lexicon", "keep_in_chaos_lexicon", "keep_in_stoplist")
    promoted = verified | ((F.col("suggested_status") == "keep_as_candidate") & seen)
    e = archived.join(a, archived["phrase"] == a["term"], "left")
    kind = F.col("kind")
    style = F.exists("all_categories", lambda c: c.startswith("style_markers."))
    privacy_ok = F.col("suggested_status").isin("keep_in_privacy_lexicon", "promote_to_active")
    keep = (
        F.when(kind == "phrase_bank", promoted & style & seen)
        .when(kind.isin("chaos_lexicon", "drop_sentence_words", "mask_words"), promoted)
        .when(kind == "privacy_lexicon", privacy_ok | (F.col("freq_total") >= 1))
        .when(kind == "phrase_stoplist", (F.col("suggested_status") == "keep_in_stoplist") | ((F.col("freq_total") >= 10) & (F.col("key") < 1.0)))
        .when(kind.isin("manual_keep", "manual_drop"), F.lit(True))
        .otherwise(F.lit(False))
    )
    source = F.when((kind == "privacy_lexicon") & ~F.coalesce(privacy_ok, F.lit(False)), F.lit("frequency_verified_low")).otherwise(F.lit("frequency_verified"))
    old = e.where(F.coalesce(keep, F.lit(False))).select(
        kind.alias("file"), "phrase", "label", "severity", "risk", source.alias("source"), F.lit("active_verified").alias("status"), F.col("entry_no").cast("long").alias("o")
    )
    late = F.lit(2**62)
    none = F.lit(None).cast("string")
    new = lambda condition, file, severity=none, risk=none, status="auto_candidate": mined.where(condition).select(
        F.lit(file).alias("file"), "phrase", none.alias("label"), severity.alias("severity"), risk.alias("risk"), F.lit("phrase_mining_auto").alias("source"), F.lit(status).alias("status"), late.alias("o")
    )
    chaos, privacy, freq = F.col("chaos_rate"), F.col("privacy_bucket_rate"), F.col("freq")
    share = F.coalesce(F.try_element_at("bucket_freq", F.lit("candidates")), F.lit(0)) / F.greatest(freq, F.lit(1))
    worth = (F.col("style_keyness") >= 2.0) & (freq >= 5) & (share >= ACTIVE_RATE) & (privacy <= 0.30) & (chaos <= 0.50)
    demoted = audited.where(F.col("suggested_status") == "keep_as_candidate").select(
        F.lit("phrase_candidates").alias("file"), F.col("term").alias("phrase"), none.alias("label"), none.alias("severity"), none.alias("risk"), F.lit("frequency_audit_demotion").alias("source"), F.lit("demoted_from_archive").alias("status"), (late + 1).alias("o")
    )
    removed = audited.where(F.col("suggested_status") == "demote_or_remove").select(
        F.lit("lexicon_removed_or_demoted").alias("file"), F.col("term").alias("phrase"), none.alias("label"), none.alias("severity"), none.alias("risk"), F.col("source_file").alias("source"), F.lit("demoted").alias("status"), F.lit(0).cast("long").alias("o")
    )
    rows = (
        old.unionByName(new((chaos > 0.5) & (freq >= 3), "chaos_lexicon", severity=F.when(chaos > 0.8, F.lit("strong")).otherwise(F.lit("mild"))))
        .unionByName(new((privacy > 0.3) & (freq >= 3), "privacy_lexicon", risk=F.lit("medium")))
        .unionByName(new((freq >= 10) & (F.col("min_pmi") < 1.5) & (F.col("style_keyness") < 1.0), "phrase_stoplist"))
        .unionByName(new(worth, "phrase_candidates"))
        .unionByName(demoted)
        .unionByName(removed)
    )
    last = rows.groupBy("file", "phrase").agg(F.max_by(F.struct("label", "severity", "risk", "source", "status"), "o").alias("x"))
    return last.select("file", "phrase", "x.*").select(*_ACTIVE)


def _file(kind: str, suffix: str = "") -> str:
    return f"{kind}{suffix}.{'txt' if kind == 'phrase_stoplist' else 'jsonl'}"


def read_folder(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """The lexicon files of a folder, which has to be there; of its files any may be missing."""
    files.required(spark, folder)
    parts = [spark.createDataFrame([], SCHEMA)]
    for kind in KINDS:
        path = f"{folder.rstrip('/')}/{_file(kind, suffix)}"
        if files.exists(spark, path):
            parts.append(read_stoplist(spark, path) if kind == "phrase_stoplist" else read_jsonl(spark, path, kind))
    return reduce(DataFrame.unionByName, parts)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The terms of an archive's own files: what an entry doesn't say of its origin is filled in."""
    files.required(spark, folder)
    parts = []
    for kind in KINDS:
        path = f"{folder.rstrip('/')}/{_file(kind, '_archive')}"
        if files.exists(spark, path):
            own = read_stoplist(spark, path).withColumn("old_category", F.lit("phrase_mining.stoplist")) if kind == "phrase_stoplist" else read_jsonl(spark, path, kind, with_category=True)
            parts.append(own)
    rows = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], SCHEMA + ", old_category string")
    return archive(rows.withColumnRenamed("old_category", "__own")).withColumn("old_category", F.coalesce("__own", F.lit("unknown"))).drop("__own")


def write_archive(entries: DataFrame, folder: str, force: bool = False) -> str:
    """Write the archive, one file of JSON lines a kind and a README; without ``force`` an archive that is there stays. Returns what was done."""
    spark = entries.sparkSession
    there = files.exists(spark, folder)
    if there and not force:
        return "skipped"
    rows = archive(entries)
    counts = _write_files(rows.withColumnRenamed("kind", "file"), folder, "_archive")
    listed = "".join(f"| `{_file(k, '_archive')}` | {n} |\n" for k, n in sorted(counts.items()))
    files.write_text(
        spark, f"{folder.rstrip('/')}/README.md",
        f"# Archived lexicons\n\nEntries as they were; they take no part in matching. {sum(counts.values())} in all.\n\n| file | entries |\n|-|-|\n{listed}",
    )
    return "overwritten" if there else "written"


def _write_files(rows: DataFrame, folder: str, suffix: str = "") -> dict[str, int]:
    """Write rows with the column file, each file by itself: a stoplist as text, others as JSON lines. Returns rows of each."""
    counts = {r["file"]: r["n"] for r in rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a file
    for name in counts:
        own = rows.where(F.col("file") == name).drop("file").coalesce(1)
        path = f"{folder.rstrip('/')}/{_file(name, suffix)}"
        if name == "phrase_stoplist":
            own.select("phrase").orderBy("phrase").coalesce(1).write.mode("overwrite").text(path)
        else:
            (own.orderBy("entry_no").coalesce(1) if "entry_no" in own.columns else own).write.mode("overwrite").json(path)
    return counts


def write_active(active_rows: DataFrame, folder: str, dry_run: bool = False) -> dict[str, int]:
    """Write the next active lexicon, one file per kind, and a report, unless it is a dry run; returns rows of each file."""
    if dry_run:
        return {r["file"]: r["n"] for r in active_rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a file
    counts = _write_files(active_rows, folder)
    by = active_rows.groupBy("file", "source", "status").agg(F.count(F.lit(1)).alias("n")).orderBy("file", "source", "status").limit(200).collect()
    report = "# Next active lexicon\n\n| file | source | status | entries |\n|-|-|-|-|\n" + "".join(f"| {r['file']} | {r['source']} | {r['status']} | {r['n']} |\n" for r in by)
    files.write_text(active_rows.sparkSession, f"{folder.rstrip('/')}/active_lexicon_report.md", report)
    return counts


def append_candidates(mined: DataFrame, path: str) -> int:
    """Add the mined candidates that a candidate file lacks to its end; returns how many.

    What is mined is bounded by the settings (top_k a length), so it may pass the driver.
    """
    from murmurlake.operators.mining import new_candidates

    spark = mined.sparkSession
    there = files.exists(spark, path)
    known = read_jsonl(spark, path, "phrase_candidates").select("phrase") if there else spark.createDataFrame([], "phrase string")
    fresh = new_candidates(mined, known).withColumn("status", F.lit("auto_candidate"))
    if there and files.is_folder(spark, path):
        count = fresh.count()
        fresh.coalesce(1).write.mode("append").json(path)
        return count
    lines = [r["line"] for r in fresh.orderBy("length", "rank").select(F.to_json(F.struct(*fresh.columns)).alias("line")).collect()]
    if lines:
        files.append_text(spark, path, "".join(f"{x}\n" for x in lines))
    return len(lines)
