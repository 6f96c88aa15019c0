"""Conversations rebuilt from message rows, read as an event log.

A row creates a message, or is a later version of it: an edit, a recall or a retried
export. Versions are folded to one final turn per (conversation, message); turns are put
in order by ``seq`` and conversations validated. No step needs a whole conversation in
one task: turns of one number are summed up first, wherever they are, order is checked
within ranges of ``seq``, and ranges are then checked against each other by one summary
row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmurlake.functions.time import usable_millis

SEQ_RANGE = 4096
_WHOLE = r"(?U)^\s*-?0*\d{1,38}(\.0)?\s*$"


def whole_number(seq: Column) -> Column:
    """``seq`` as a number: blanks around it, leading zeros and a final .0 are allowed; else null.

    Numbers of more than 38 digits, leading zeros aside, are beyond the type and null too.
    """
    digits = F.regexp_replace(F.regexp_replace(F.regexp_replace(seq, r"(?U)\s", ""), r"\.0$", ""), r"^(-?)0+(?=\d)", "$1")
    return F.when(seq.rlike(_WHOLE), digits.try_cast("decimal(38,0)"))


def fold_versions(messages: DataFrame, keep: tuple[str, ...] = ("text",)) -> DataFrame:
    """One final turn per (conv_id, msg_id): the version ingested last, by row_id on a tie.

    Rows without conv_id belong to no conversation and are left out; rows without msg_id
    are messages of their own. A null recalled or is_system flag counts as false.
    ``keep`` names further columns that turns carry; ``said`` tells whether a turn is
    left when recalled, system and blank ones are dropped.
    """
    blank = F.coalesce(F.col("text"), F.lit("")).rlike(r"(?U)^\s*$")
    visible = ~F.coalesce("recalled", F.lit(False)) & ~F.coalesce("is_system", F.lit(False))
    turn = F.struct(
        F.coalesce("ingested_at", F.lit("0001-01-01").cast("timestamp")).alias("version"),
        "row_id",
        F.col("seq").alias("raw_seq"),
        usable_millis("timestamp_ms", "time_text").alias("t"),
        F.coalesce("uid", "sender.uid").alias("account"),
        "source_file",
        visible.alias("visible"),
        (visible & ~blank).alias("said"),
        *keep,
    )
    own = F.coalesce(F.concat(F.lit("m"), F.col("msg_id")), F.concat(F.lit("r"), F.col("row_id").cast("string")))
    folded = messages.where(F.col("conv_id").isNotNull()).groupBy("conv_id", own.alias("message")).agg(F.max(turn).alias("e"))
    return folded.select(
        "conv_id", "e.row_id", whole_number(F.col("e.raw_seq")).alias("seq"), "e.t", "e.account", "e.source_file", "e.visible", "e.said", *[f"e.{c}" for c in keep]
    )


def _with_self(turns: DataFrame, files: DataFrame) -> DataFrame:
    owners = files.groupBy(F.col("source_file").alias("__file")).agg(F.max("self_uid").alias("self_uid"))
    return turns.join(owners, F.col("source_file") == F.col("__file"), "left").drop("__file")


def is_me() -> Column:
    return F.coalesce(F.col("account") == F.col("self_uid"), F.lit(False))


def judge(turns: DataFrame, files: DataFrame, seq_range: int = SEQ_RANGE) -> DataFrame:
    """(conv_id, turns, broken, empty, no_reply) of each conversation of folded turns.

    broken: a seq isn't a whole number, or the numbers aren't consecutive without
    repeats, or a later turn has an earlier usable time. empty: no turn is left when
    recalled, system and blank ones are dropped. no_reply: not empty, but all turns that
    are left are of one role.
    """
    # However many turns have one number, or none, they come as a few rows to the windows.
    numbers = (
        turns.withColumn("range", F.floor(F.col("seq") / F.lit(seq_range)).cast("decimal(38,0)"))
        .groupBy("conv_id", "range", "seq", "source_file", "account")
        .agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count_if("said").alias("said"))
    )
    mine = F.when(is_me(), F.col("said")).otherwise(F.lit(0))
    places = (
        _with_self(numbers, files)
        .repartition("conv_id", "range")  # serves the sums of a number, the windows and the sums of a range
        .groupBy("conv_id", "range", "seq")
        .agg(F.sum("n").alias("n"), F.min("first_t").alias("first_t"), F.max("last_t").alias("last_t"), F.sum("said").alias("said"), F.sum(mine).alias("me"))
    )
    inside = Window.partitionBy("conv_id", "range").orderBy("seq")
    marked = places.withColumn("step", F.col("seq") - F.lag("seq").over(inside)).withColumn(
        "late", F.max("last_t").over(inside.rowsBetween(Window.unboundedPreceding, -1)) > F.col("first_t")
    )
    ranges = marked.groupBy("conv_id", "range").agg(
        F.sum("n").alias("n"),
        F.count_if(F.col("seq").isNull() | (F.col("n") > 1) | (F.col("step") != 1) | F.coalesce("late", F.lit(False))).alias("bad"),
        F.min("seq").alias("low"),
        F.max("seq").alias("high"),
        F.min("first_t").alias("first_t"),
        F.max("last_t").alias("last_t"),
        F.sum("said").alias("said"),
        F.sum("me").alias("me"),
    )
    along = Window.partitionBy("conv_id").orderBy("range")
    chained = ranges.withColumn("gap", F.col("low") - F.lag("high").over(along) != 1).withColumn(
        "back", F.max("last_t").over(along.rowsBetween(Window.unboundedPreceding, -1)) > F.col("first_t")
    )
    verdict = chained.groupBy("conv_id").agg(
        F.sum("n").alias("turns"),
        ((F.sum("bad") > 0) | (F.count_if(F.coalesce("gap", F.lit(False)) | F.coalesce("back", F.lit(False))) > 0)).alias("broken"),
        F.sum("said").alias("said"),
        F.sum("me").alias("me"),
    )
    return verdict.select(
        "conv_id",
        "turns",
        "broken",
        (F.col("said") == 0).alias("empty"),
        ((F.col("said") > 0) & ((F.col("me") == 0) | (F.col("me") == F.col("said")))).alias("no_reply"),
    )


def defects(verdicts: DataFrame) -> DataFrame:
    """(conv_id, defect): one row per defect that applies."""
    named = [F.when(F.col(d), F.lit(d)) for d in ("broken", "empty", "no_reply")]
    return verdicts.select("conv_id", F.explode(F.array_compact(F.array(*named))).alias("defect"))


def rebuild(turns: DataFrame, files: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, time_ms, row_id): the visible turns of sound conversations.

    position is the turn's place by seq, from 0; recalled and system turns keep their
    place free. Turns are rows, so a conversation may have any length.
    """
    sound = verdicts.where(~F.col("broken") & ~F.col("empty") & ~F.col("no_reply")).select("conv_id")
    kept = turns.join(sound, "conv_id", "left_semi")
    first = kept.groupBy("conv_id").agg(F.min("seq").alias("__first"))
    return (
        _with_self(kept.where("visible").join(first, "conv_id"), files)
        .withColumn("role", F.when(is_me(), F.lit("me")).otherwise(F.lit("other")))
        .select("conv_id", (F.col("seq") - F.col("__first")).cast("long").alias("position"), "role", "text", F.col("t").alias("time_ms"), "row_id")
    )
