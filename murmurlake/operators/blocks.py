"""Turns, sessions and blocks of one target speaker, from messages.

Every step is keyed by source file, and a single chat may hold a large part of all
messages; so nothing is done per file in one task. Messages and turns are numbered within
their file and dealt into chunks, gaps are taken between neighbours over chunk edges, and
the one sequential step – whether a turn is absorbed into the open block – is folded over
segments that end wherever the open block is bound to close.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurlake.config import Settings
from murmurlake.operators.neighbours import CHUNK, with_neighbours
from murmurlake.operators.ranking import bucketed_prefix
from murmurlake.sources.messages import stripped

DAY_MS = 86_400_000
CONTEXT = 3
LOOK_AHEAD = 4


def build_turns(messages: DataFrame, s: Settings) -> DataFrame:
    """(source_file, turn_no, is_me, uid, uin, name, text, fragments, char_count, start_ms, end_ms, is_system, msg_type).

    ``messages`` has the common shape and is_me. Recalled messages are left out. A message
    joins the turn before it if it comes less than the turn gap later and is from the same
    side, or from the same uid; all other speakers form one side. A gap of 0 or less
    switches the time test off. Empty texts extend a turn's time but add no fragment;
    ties of time go by msg_idx. Null sources form a group of their own.
    """
    tie = "row_id" if "row_id" in messages.columns else "__tie"
    rows = stripped(messages.where(~F.col("is_recalled"))).withColumn("__tie", F.xxhash64("msg_id", "seq", "text"))
    numbered = bucketed_prefix(rows, ["source_file"], F.floor(F.col("timestamp_ms") / DAY_MS).cast("long"), ["timestamp_ms", "msg_idx", tie], rank="pos")
    near, w, own = with_neighbours(numbered, ["source_file"], "pos", back=1, ahead=0)
    lag = lambda c: F.lag(c).over(w)
    same = (lag("is_me") == F.col("is_me")) | ((F.col("uid") != "") & (lag("uid") == F.col("uid")))
    close = F.lit(True) if s.turn_gap_seconds <= 0 else F.col("timestamp_ms") - lag("timestamp_ms") < s.turn_gap_seconds * 1000
    flagged = near.withColumn("__new", F.when(F.coalesce(same & close, F.lit(False)), 0).otherwise(1)).where(own)
    placed = bucketed_prefix(flagged, ["source_file"], F.col("__chunk"), ["pos"], rank="__again", value="__new", before="__before")
    first = lambda c: F.min_by(c, "pos").alias(c)
    texts = F.array_sort(F.collect_list(F.when(F.col("text") != "", F.struct("pos", "text"))))
    turns = placed.groupBy("source_file", (F.col("__before") + F.col("__new") - 1).alias("turn_no")).agg(
        first("is_me"),
        first("uid"),
        first("uin"),
        F.min_by(F.when(F.col("name") != "", F.col("name")).otherwise(F.col("nickname")), "pos").alias("name"),
        F.transform(texts, lambda x: x["text"]).alias("fragments"),
        F.sum(F.length("text")).cast("int").alias("char_count"),
        F.min("timestamp_ms").alias("start_ms"),
        F.max("timestamp_ms").alias("end_ms"),
        first("is_system"),
        first("msg_type"),
    )
    return turns.withColumn("text", F.array_join("fragments", "\n"))


def split_sessions(turns: DataFrame, s: Settings) -> DataFrame:
    """Adds session_no (from 0 in each file), segment_no, gap_ms and comes_back to the turns.

    A session ends where the next turn starts more than the session gap after the last
    one ended. comes_back tells whether the target speaker is back within the next four
    turns of the session and the continuation time.
    """
    most = s.max_light_interruptions + 1
    near, w, own = with_neighbours(turns, ["source_file"], "turn_no", back=most + 1, ahead=LOOK_AHEAD)
    limit, wait = s.session_gap_minutes * 60_000, s.my_block_continue_seconds * 1000
    gap = F.col("start_ms") - F.lag("end_ms").over(w)
    new_session = gap.isNull() | (gap > limit)
    together, back = F.lit(True), F.lit(False)
    for k in range(1, LOOK_AHEAD + 1):
        end_before = F.col("end_ms") if k == 1 else F.lead("end_ms", k - 1).over(w)
        start = F.lead("start_ms", k).over(w)
        together = together & (start - end_before <= limit)
        back = back | F.coalesce(together & F.lead("is_me", k).over(w) & (start - F.col("end_ms") <= wait), F.lit(False))
    # No block goes on after another's turn that isn't light and after which the speaker isn't
    # back, nor after more light ones in a row than a block takes: there a new segment starts,
    # so that segments stay short however long others talk.
    kept = F.coalesce(F.col("gap_ms") <= wait, F.lit(False)) & F.col("comes_back")
    size = F.col("char_count")
    shuts = ~F.col("is_me") & ((size >= s.hard_interruption_chars) | ((size > s.light_interruption_chars) & ~kept))
    faint = ~F.col("is_me") & ~kept
    seen = near.withColumns({"gap_ms": gap, "comes_back": back, "__session": new_session.cast("int")}).withColumns({"__shuts": shuts, "__faint": faint})
    many = F.lit(True)
    for k in range(1, most + 1):
        many = many & F.coalesce(F.lag("__faint", k).over(w), F.lit(False))
    bound_to_close = (F.col("is_me") & (F.col("gap_ms") > wait)) | F.lag("__shuts").over(w) | many
    flagged = seen.withColumn("__segment", ((F.col("__session") == 1) | F.coalesce(bound_to_close, F.lit(False))).cast("int")).where(own).drop("__shuts", "__faint")
    placed = bucketed_prefix(
        flagged, ["source_file"], F.col("__chunk"), ["turn_no"], rank="__again", value=["__session", "__segment"], before=["__s", "__g"]
    )
    return placed.withColumns(
        {"session_no": (F.col("__s") + F.col("__session") - 1).cast("int"), "segment_no": F.col("__g") + F.col("__segment") - 1}
    ).drop("__own", "__chunk", "__session", "__segment", "__again", "__s", "__g")


_RANGE = "struct<first:int,last:int,light:int>"


def _fold(turns: Column, s: Settings) -> Column:
    """The blocks of a segment as array<struct<first, last, light>> of places in it, last included."""
    wait = s.my_block_continue_seconds * 1000
    none = F.expr(f"cast(array() as array<{_RANGE}>)")

    def state(open_: Column, at: Column, first: Column, light: Column, chars: Column, frags: Column, out: Column) -> Column:
        return F.struct(
            open_.alias("open"), at.cast("int").alias("at"), first.cast("int").alias("first"), light.cast("int").alias("light"), chars.cast("long").alias("chars"), frags.cast("long").alias("frags"), out.alias("out")
        )

    def step(a: Column, t: Column) -> Column:
        at = a["at"] + 1
        n, f = t["char_count"], F.size(t["fragments"])
        closed = F.concat(a["out"], F.array(F.struct(a["first"].alias("first"), a["at"].alias("last"), a["light"].alias("light")))).cast(f"array<{_RANGE}>")
        out = F.when(a["open"], closed).otherwise(a["out"])
        shut = state(F.lit(False), at, at, F.lit(0), F.lit(0), F.lit(0), out)
        begin = state(F.lit(True), at, at, F.lit(0), n, f, out)
        chars, frags = a["chars"] + n, a["frags"] + f
        take = state(F.lit(True), at, a["first"], a["light"], chars, frags, a["out"])
        take_light = state(F.lit(True), at, a["first"], a["light"] + 1, chars, frags, a["out"])
        # A medium interruption is taken, but may be the last that the block takes.
        with_it = F.concat(a["out"], F.array(F.struct(a["first"].alias("first"), at.alias("last"), a["light"].alias("light")))).cast(f"array<{_RANGE}>")
        take_last = state(F.lit(False), at, at, F.lit(0), F.lit(0), F.lit(0), with_it)
        full = (frags > s.max_fragment_count) | (chars > s.max_block_chars)
        in_time = F.coalesce(t["gap_ms"] <= wait, F.lit(False))
        opens = t["is_me"] & ~t["is_system"]
        return (
            F.when(~a["open"] | (t["is_me"] & ~in_time), F.when(opens, begin).otherwise(shut))
            .when(t["is_me"], take)
            .when(n >= s.hard_interruption_chars, shut)
            .when((n <= s.light_interruption_chars) & (a["light"] < s.max_light_interruptions), take_light)
            .when(in_time & t["comes_back"], F.when(full, take_last).otherwise(take))
            .otherwise(shut)
        )

    def finish(a: Column) -> Column:
        last = F.array(F.struct(a["first"].alias("first"), a["at"].alias("last"), a["light"].alias("light")))
        return F.when(a["open"], F.concat(a["out"], last).cast(f"array<{_RANGE}>")).otherwise(a["out"])

    zero = state(F.lit(False), F.lit(-1), F.lit(-1), F.lit(0), F.lit(0), F.lit(0), none)
    return F.aggregate(turns, zero, step, finish)


def extract_blocks(sessions: DataFrame, s: Settings) -> DataFrame:
    """One row per block: ids, turns, my_text, fragments, metrics, and bucket and reasons of blocks below the thresholds.

    A block starts at a turn of the target speaker that is no system message and takes
    what follows: the speaker's own turns in time, a few light interruptions, and
    medium ones after which the speaker comes back; hard interruptions end it.
    """
    fields = ["turn_no", "is_me", "is_system", "uid", "name", "text", "fragments", "char_count", "start_ms", "end_ms", "msg_type", "gap_ms", "comes_back"]
    segments = sessions.groupBy("source_file", "session_no", "segment_no").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("ts"))
    ranges = segments.withColumn("b", F.explode(_fold(F.col("ts"), s)))
    part = ranges.select(
        "source_file", "session_no", F.slice("ts", F.col("b.first") + 1, F.col("b.last") - F.col("b.first") + 1).alias("turns"), F.col("b.light").alias("light")
    )
    total = lambda arr, f: F.aggregate(arr, F.lit(0).cast("long"), lambda a, t: a + f(t).cast("long"))
    mine = F.filter("turns", lambda t: t["is_me"])
    others = F.filter("turns", lambda t: ~t["is_me"])
    part = part.withColumns({"my_turns": mine, "other_turns": others})
    short = lambda t: F.size(F.filter(t["fragments"], lambda f: F.length(f) <= s.short_fragment_chars))
    n = {
        "my_msg_count": total("my_turns", lambda t: F.size(t["fragments"])),
        "my_char_count": total("my_turns", lambda t: t["char_count"]),
        "total_char_count": total("turns", lambda t: t["char_count"]),
        "my_turn_count": F.size("my_turns").cast("long"),
        "other_turn_count": F.size("other_turns").cast("long"),
        "interruption_count": F.col("light").cast("long"),
        "interruption_chars": total("other_turns", lambda t: t["char_count"]),
        "short_fragment_count": total("my_turns", short),
    }
    texts = F.filter(F.transform("my_turns", lambda t: t["text"]), lambda x: x != "")
    rows = part.withColumns(n | {"my_text": F.array_join(texts, "\n"), "fragments": F.flatten(F.transform("turns", lambda t: t["fragments"]))})
    ratio = F.when(F.col("total_char_count") > 0, F.col("my_char_count") / F.col("total_char_count")).otherwise(F.lit(0.0))
    short_ratio = F.when(F.col("my_msg_count") > 0, F.col("short_fragment_count") / F.col("my_msg_count")).otherwise(F.lit(0.0))
    rows = rows.withColumn("__ratio", ratio)
    reasons = F.array_compact(
        F.array(
            F.when(F.col("my_char_count") < s.min_my_block_chars, F.format_string(f"too_few_chars:%d<{s.min_my_block_chars}", "my_char_count")),
            F.when(F.col("my_msg_count") < s.min_my_msg_count, F.format_string(f"too_few_msgs:%d<{s.min_my_msg_count}", "my_msg_count")),
            F.when(F.col("__ratio") < s.min_my_char_ratio, F.format_string(f"low_my_ratio:%.2f<{float(s.min_my_char_ratio)}", "__ratio")),
        )
    )
    rows = rows.withColumns(
        {
            "first_turn": F.element_at("turns", 1)["turn_no"],
            "last_turn": F.element_at("turns", -1)["turn_no"],
            "my_char_ratio": F.round("__ratio", 4),
            "short_fragment_ratio": F.round(short_ratio, 4),
            "reasons": reasons,
        }
    )
    numbered = bucketed_prefix(
        rows, ["source_file", "session_no"], F.floor(F.col("first_turn") / CHUNK).cast("long"), ["first_turn"], rank="block_no"
    )
    metrics = [*n, "my_char_ratio", "short_fragment_ratio"]
    return numbered.select(
        "source_file",
        F.format_string("session_%05d", "session_no").alias("session_id"),
        "session_no",
        F.format_string("session_%05d_block_%03d", "session_no", "block_no").alias("block_id"),
        "block_no",
        "first_turn",
        "last_turn",
        "my_text",
        "fragments",
        "my_turns",
        "other_turns",
        F.when(F.size("reasons") > 0, F.lit("rejected")).alias("bucket"),
        "reasons",
        F.struct(*metrics).alias("metrics"),
    )


def number_sources(blocks: DataFrame, messages: DataFrame) -> DataFrame:
    """Puts ``source_%04d_`` before block_id: sources with messages, in the order of their names."""
    from murmurlake.session import cut

    names = cut(messages.select("source_file").distinct().repartitionByRange("source_file").withColumn("__part", F.spark_partition_id()), "sources")
    ranked = bucketed_prefix(names.withColumn("__all", F.lit(1)), ["__all"], F.col("__part"), ["source_file"], rank="source_no")
    joined = blocks.join(ranked.select(F.col("source_file").alias("__f"), "source_no"), F.col("source_file").eqNullSafe(F.col("__f")), "left")
    return joined.withColumn("block_id", F.format_string("source_%04d_%s", "source_no", "block_id")).drop("__f", "source_no")


def block_context(blocks: DataFrame, sessions: DataFrame, around: int = CONTEXT) -> DataFrame:
    """(source_file, block_id, context): the turns from three before a block to three after it, within its session."""
    wanted = blocks.select(
        "source_file", "session_no", "block_id", F.explode(F.sequence(F.greatest(F.lit(0), F.col("first_turn") - around), F.col("last_turn") + around)).alias("turn_no")
    )
    turns = sessions.select("source_file", "session_no", "turn_no", "is_me", "text", "start_ms", "end_ms")
    near = wanted.join(turns, ["source_file", "session_no", "turn_no"])
    return near.groupBy("source_file", "block_id").agg(
        F.array_sort(F.collect_list(F.struct("turn_no", "is_me", "text", "start_ms", "end_ms"))).alias("context")
    )


def blocks_of(messages: DataFrame, s: Settings) -> DataFrame:
    """Messages → blocks in one go."""
    return extract_blocks(split_sessions(build_turns(messages, s), s), s)
