"""Phrase mining: n-grams of script runs with PMI, neighbour entropy and keyness.

Texts are cut into windows twice. The first pass counts all phrases, and with them pairs and
characters, in hash tables; PMI is a join on the inner pairs of a few thousand leading
phrases. The second pass keeps only the windows of phrases that may lead and sums them up by
phrase and neighbours, before anything is shuffled; first sight and entropies both come from
these sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmurlake.config import MINED_BUCKETS, Settings
from murmurlake.functions import text as tx
from murmurlake.session import cut

REVIEW_LIMIT = 100


def runs(texts: DataFrame, text: str, script: str = tx.CJK) -> DataFrame:
    """One row per maximal run of script characters: the other columns, ``at`` (ordinal) and ``chars``."""
    found = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"[{script}]+"), F.lit(0))
    rest = [c for c in texts.columns if c != text]
    return texts.select(*rest, F.posexplode(found).alias("at", "run")).select(*rest, "at", F.split("run", "").alias("chars"))


def _grams(chars: Column, lengths: Sequence[int], around: bool) -> Column:
    """array<struct<n, pos, phrase[, l, r]>> of all windows of the lengths in a run."""
    def windows(n: int) -> Column:
        def one(i: Column) -> Column:
            cells = [F.get(chars, i + k) for k in range(n)]
            fields = [F.lit(n).alias("n"), i.alias("pos"), F.concat(*cells).alias("phrase")]
            if around:
                fields += [F.when(i > 0, F.get(chars, i - 1)).alias("l"), F.get(chars, i + n).alias("r")]
            return F.struct(*fields)

        kind = "struct<n:int,pos:int,phrase:string" + (",l:string,r:string>" if around else ">")
        at = F.sequence(F.lit(0), F.size(chars) - n)
        return F.when(F.size(chars) >= n, F.transform(at, one)).otherwise(F.expr(f"cast(array() as array<{kind}>)"))

    return F.concat(*[windows(n) for n in lengths])


def ngrams(texts: DataFrame, text: str, lengths: Sequence[int], around: bool = False, script: str = tx.CJK) -> DataFrame:
    """One row per window: the other columns, at, n, pos, phrase and, with ``around``, its neighbours l and r.

    Neighbours outside the run are null. Null and empty texts have no windows.
    """
    found = runs(texts, text, script)
    rest = [c for c in found.columns if c != "chars"]
    return found.select(*rest, F.explode(_grams(F.col("chars"), lengths, around)).alias("g")).select(*rest, "g.*")


def scan_texts(blocks: DataFrame, sources: Sequence[str] = ("my_text",)) -> DataFrame:
    """One row per text to scan: bucket, ord and text. Sources are my_text, fragments and my_blocks."""
    parts = {
        "my_text": lambda: F.col("my_text"),
        "fragments": lambda: F.array_join("fragments", " "),
        "my_blocks": lambda: F.array_join(F.filter(F.transform("my_turns", lambda t: t["text"]), lambda x: x != ""), " "),
    }
    texts = F.array(*[parts[s]() for s in sources if s in parts])
    return blocks.select("bucket", "ord", F.posexplode(texts).alias("part", "text")).where("text is not null and text <> ''")


def _ranked(texts: DataFrame, buckets: Sequence[str]) -> DataFrame:
    rank = F.array_position(F.array(*[F.lit(b) for b in buckets]), F.col("bucket")).cast("int")
    return texts.where(F.col("bucket").isin(*buckets)).withColumn("rank", rank)


def count_phrases(texts: DataFrame, s: Settings, buckets: Sequence[str] = MINED_BUCKETS, characters: bool = False) -> DataFrame:
    """(n, phrase, freq, bucket_freq): counts of all phrases, with ``characters`` of single ones too.

    ``texts`` has bucket, ord, part and text; texts of other buckets are left out. Only
    numbers are aggregated, so the counts stay in hash tables.
    """
    lengths = sorted({2, *range(s.min_n, s.max_n + 1), *([1] if characters else [])})
    grams = ngrams(texts.where(F.col("bucket").isin(*buckets)).select("bucket", "text"), "text", lengths)
    by_bucket = [F.count_if(F.col("bucket") == b).alias(b) for b in buckets]
    counted = grams.groupBy("n", "phrase").agg(F.count(F.lit(1)).alias("freq"), *by_bucket)
    freq = F.create_map(*[x for b in buckets for x in (F.lit(b), F.col(b))])
    return counted.select("n", "phrase", "freq", freq.alias("bucket_freq"))


def neighbours(texts: DataFrame, phrases: DataFrame, buckets: Sequence[str] = MINED_BUCKETS) -> DataFrame:
    """(n, phrase, l, r, k, seen): how often some phrases stand between which characters, and where first.

    Characters outside the run are null; seen is (bucket, text, place).
    """
    lengths = [r["n"] for r in phrases.select("n").distinct().collect()]  # a few lengths
    grams = ngrams(_ranked(texts, buckets), "text", sorted(lengths) or [2], around=True).join(phrases.select("n", "phrase"), ["n", "phrase"], "left_semi")
    return grams.groupBy("n", "phrase", "l", "r").agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("rank", "ord", "part", "at", "pos")).alias("seen"))


def pair_information(pairs: DataFrame, characters: DataFrame) -> DataFrame:
    """(pair, pmi) of counted pairs: log2 of p(xy) / (p(x) p(y)), at least 0, and 0 below two occurrences.

    ``pairs`` has pair and freq; the totals are those of the whole tables given.
    """
    totals = pairs.agg(F.sum("freq").alias("all_pairs")).crossJoin(characters.agg(F.sum("n").alias("all_chars")))  # one row
    x = characters.select(F.col("ch").alias("x"), F.col("n").alias("nx"))
    y = characters.select(F.col("ch").alias("y"), F.col("n").alias("ny"))
    cells = pairs.select("pair", "freq", F.substring("pair", 1, 1).alias("x"), F.substring("pair", 2, 1).alias("y"))
    joined = cells.join(x, "x", "left").join(y, "y", "left").crossJoin(F.broadcast(totals))
    px, py = F.coalesce("nx", F.lit(1)) / F.col("all_chars"), F.coalesce("ny", F.lit(1)) / F.col("all_chars")
    pmi = F.greatest(F.lit(0.0), F.log2((F.col("freq") / F.col("all_pairs")) / (px * py)))
    return joined.select("pair", F.when(F.col("freq") >= 2, pmi).otherwise(F.lit(0.0)).alias("pmi"))


def leading_phrases(counts: DataFrame, texts: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(phrases, their neighbours): the 3 · top_k most frequent phrases of each length, ties by first sight, that reach min_freq.

    First sight and neighbours are looked up only for phrases that are frequent enough, ties included.
    """
    by_freq = Window.partitionBy("n").orderBy(F.desc("freq"))
    wanted = counts.where(F.col("n").between(s.min_n, s.max_n) & (F.col("freq") >= s.min_freq))
    near = cut(wanted.withColumn("__r", F.rank().over(by_freq)).where(F.col("__r") <= 3 * s.top_k_each_length).drop("__r"), "near")
    around = cut(neighbours(texts, near), "around")
    seen = near.join(around.groupBy("n", "phrase").agg(F.min("seen").alias("seen")), ["n", "phrase"])
    w = Window.partitionBy("n").orderBy(F.desc("freq"), "seen")
    return seen.withColumn("place", F.row_number().over(w)).where(F.col("place") <= 3 * s.top_k_each_length), around


def phrase_information(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """(phrase, pmi): the mean information of a phrase's inner pairs; pairs themselves have their own.

    ``counts`` holds all phrases, pairs and characters among them.
    """
    inner = F.transform(F.sequence(F.lit(1), F.length("phrase") - 1), lambda i: F.substring(F.col("phrase"), i, F.lit(2)))
    cells = phrases.select("phrase", F.posexplode(inner).alias("i", "pair"))
    characters = counts.where("n = 1").select(F.col("phrase").alias("ch"), F.col("freq").alias("n"))
    info = pair_information(counts.where("n = 2").select(F.col("phrase").alias("pair"), "freq"), characters)
    return cells.join(info, "pair", "left").groupBy("phrase").agg(F.avg(F.coalesce("pmi", F.lit(0.0))).alias("pmi"))


def neighbour_entropy(phrases: DataFrame, around: DataFrame) -> DataFrame:
    """(phrase, left_entropy, right_entropy) in bits, over all occurrences, from the sums of ``neighbours``."""
    kept = around.join(phrases.select("phrase"), "phrase", "left_semi")
    sides = kept.select("phrase", "k", F.explode(F.array(F.struct(F.lit("l").alias("side"), F.col("l").alias("c")), F.struct(F.lit("r").alias("side"), F.col("r").alias("c")))).alias("x"))
    counted = sides.where("x.c is not null").groupBy("phrase", "x.side", "x.c").agg(F.sum("k").alias("k"))
    bits = F.greatest(F.lit(0.0), F.log2(F.sum("k")) - F.sum(F.col("k") * F.log2("k")) / F.sum("k"))
    by_side = counted.groupBy("phrase", "side").agg(bits.alias("h")).groupBy("phrase").agg(
        F.max(F.when(F.col("side") == "l", F.col("h"))).alias("left_entropy"), F.max(F.when(F.col("side") == "r", F.col("h"))).alias("right_entropy")
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0)).alias(c)
    return phrases.select("phrase").join(by_side, "phrase", "left").select("phrase", zero("left_entropy"), zero("right_entropy"))


def _rounded(c: Column, digits: int) -> Column:
    """Of the number itself, not of its decimal text, whose halves may be none."""
    return F.floor(c * 10**digits + 0.5) / 10**digits


def judge_phrases(rows: DataFrame, s: Settings) -> DataFrame:
    """Adds keyness, rates, label, action and reasons to phrases with n, freq, bucket_freq, pmi, entropies and manual_keep."""
    b = lambda k: F.coalesce(F.try_element_at("bucket_freq", F.lit(k)), F.lit(0))
    c, micro, chaos, priv, rej = (b(k) for k in ("candidates", "micro_style", "chaos_style", "need_anonymize", "rejected"))
    everywhere = F.greatest(F.lit(1), F.aggregate(F.map_values("bucket_freq"), F.lit(0).cast("long"), lambda a, x: a + x))
    good = c * s.weight("candidates") + micro * s.weight("micro_style")
    bad = chaos * s.weight("chaos_style") + priv * s.weight("need_anonymize")
    if s.compare_against_rejected:
        bad = bad + rej * abs(s.weight("rejected"))
    keyness = (good + 0.5) / (bad + 0.5) if s.keyness_enabled else good / everywhere
    out = rows.withColumns({"__k": keyness, "__chaos": chaos / everywhere, "__priv": priv / everywhere, "__ent": F.least("left_entropy", "right_entropy")})
    key, ch, pr = F.col("__k"), F.col("__chaos"), F.col("__priv")
    keyed = key >= s.min_keyness
    label = (
        F.when((ch > 0.5) & (key < 2), F.lit("chaos_phrase"))
        .when(pr > 0.3, F.lit("privacy_phrase"))
        .when(F.lit(s.keyness_enabled) & keyed, F.lit("candidate_style_phrase"))
        .otherwise(F.lit("ambiguous_phrase"))
    )
    action = (
        F.when(F.col("manual_keep"), F.lit("manual_keep"))
        .when((ch > 0.7) | ((rej > c) & (F.col("freq") < 10)), F.lit("skip"))
        .when(pr > 0.4, F.lit("privacy_review"))
        .when((F.lit(not s.keyness_enabled) | keyed) & (ch < 0.3), F.lit("review"))
        .otherwise(F.lit("review_low_keyness"))
    )
    reasons = F.array_compact(
        F.array(
            F.when(F.col("manual_keep"), F.lit("manual_phrase_keep")),
            F.when((c > 0) & (rej == 0), F.lit("high_candidate_frequency")),
            F.when((c > rej * 2) & (rej > 0), F.lit("low_rejected_frequency")),
            F.when(F.col("pmi") > s.min_pmi_2gram * 2, F.lit("stable_ngram")),
            F.when(F.col("__ent") > 1.5, F.lit("high_entropy")),
            F.when(ch < 0.1, F.lit("low_chaos")),
        )
    )
    return out.select(
        "phrase",
        F.col("n").alias("length"),
        "freq",
        "bucket_freq",
        _rounded(F.col("pmi"), 2).alias("min_pmi"),
        _rounded(F.col("left_entropy"), 4).alias("left_entropy"),
        _rounded(F.col("right_entropy"), 4).alias("right_entropy"),
        _rounded(F.col("__ent"), 4).alias("min_entropy"),
        _rounded(F.col("__k"), 2).alias("style_keyness"),
        _rounded(F.col("__chaos"), 4).alias("chaos_rate"),
        _rounded(F.col("__priv"), 4).alias("privacy_bucket_rate"),
        label.alias("suggested_label"),
        action.alias("suggested_action"),
        F.lit("auto_candidate").alias("status"),
        F.lit("phrase_mining_auto").alias("source"),
        reasons.alias("reasons"),
        "place",
    )


def mine(texts: DataFrame, s: Settings, stoplist: DataFrame, keep: DataFrame, drop: DataFrame) -> DataFrame:
    """The mined phrases of each length, at most top_k, with their rank by keyness and frequency.

    ``stoplist``, ``keep`` and ``drop`` have one column, phrase; phrases on the first and
    the last are left out, phrases of ``keep`` are marked. ``texts`` is read twice
    and should be cheap to read. Empty texts give an empty result.
    """
    counts = cut(count_phrases(texts, s, characters=True), "counts")
    lead, around = leading_phrases(counts, texts, s)
    lead = lead.join(stoplist.select("phrase").distinct(), "phrase", "left_anti").join(drop.select("phrase").distinct(), "phrase", "left_anti")
    info = phrase_information(lead, counts)
    least = F.when(F.col("n") == 2, s.min_pmi_2gram).when(F.col("n") == 3, s.min_pmi_3gram).when(F.col("n") == 4, s.min_pmi_4gram).otherwise(2.0)
    kept = cut(lead.join(info, "phrase").where(F.col("pmi") >= least), "phrases", replaces=counts)
    entropy = neighbour_entropy(kept, around)
    marked = kept.join(keep.select("phrase").distinct().withColumn("__keep", F.lit(True)), "phrase", "left").withColumn("manual_keep", F.coalesce("__keep", F.lit(False)))
    rows = judge_phrases(marked.join(entropy, "phrase").where(F.least("left_entropy", "right_entropy") >= s.min_entropy), s)
    order = Window.partitionBy("length").orderBy(F.desc("style_keyness"), F.desc("freq"), "place")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.top_k_each_length).drop("place")


def candidates(mined: DataFrame) -> DataFrame:
    return mined.where(F.col("suggested_action").isin("review", "manual_keep"))


def review_lists(mined: DataFrame, s: Settings, limit: int = REVIEW_LIMIT) -> DataFrame:
    """(list, place, phrase): the top phrases of the four review lists."""
    privacy = F.col("suggested_action") == "privacy_review"
    chaos = ~privacy & (F.col("chaos_rate") > 0.5)
    stop = (F.col("freq") > s.min_freq * 5) & (F.col("min_pmi") < s.min_pmi_2gram * 0.6) & (F.col("min_entropy") < 0.8)
    lists = {
        "review_privacy_terms": (privacy, "privacy_bucket_rate"),
        "review_chaos_terms": (chaos, "chaos_rate"),
        "review_phrases_top": (~privacy & ~chaos, "style_keyness"),
        "review_stopword_candidates": (stop, "freq"),
    }
    named = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(n).alias("list"), F.col(by).cast("double").alias("by"))) for n, (c, by) in lists.items()]))
    rows = mined.select("phrase", "length", "rank", F.explode(named).alias("x"))
    w = Window.partitionBy("x.list").orderBy(F.desc("x.by"), "length", "rank")
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit).select("x.list", "place", "phrase")


def promote(mined: DataFrame, s: Settings, existing: Sequence[str]) -> DataFrame:
    """The first phrases, in order of length and rank, that pass all thresholds and aren't markers yet."""
    passed = candidates(mined).where(
        (F.col("style_keyness") >= s.promote_min_style_keyness)
        & (F.col("min_pmi") >= s.promote_min_pmi)
        & (F.col("min_entropy") >= s.promote_min_entropy)
        & (F.col("freq") >= s.promote_min_freq)
        & (F.col("chaos_rate") <= s.promote_max_chaos_rate)
        & (F.col("privacy_bucket_rate") <= s.promote_max_privacy_rate)
    )
    if existing:
        passed = passed.where(~F.col("phrase").isin(*existing))
    if not s.auto_promote_enabled or not math.isfinite(s.promote_max_per_run):
        return passed.limit(0)
    return passed.orderBy("length", "rank").limit(s.promote_max_per_run)


def new_candidates(mined: DataFrame, existing: DataFrame) -> DataFrame:
    """Mined candidates whose phrase an existing candidate file lacks, ready to be appended."""
    return candidates(mined).join(existing.select("phrase").distinct(), "phrase", "left_anti")
