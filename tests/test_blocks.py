import random
from dataclasses import replace

import pytest

from murmurlake.config import CODE_DEFAULTS, TUNED
from murmurlake.operators import blocks as bl
from murmurlake.operators.neighbours import with_neighbours
from murmurlake.operators.ranking import bucketed_prefix, salt

SCHEMA = "source_file string, msg_idx int, msg_id string, seq string, timestamp_ms long, uid string, uin string, name string, nickname string, text string, msg_type string, is_system boolean, is_recalled boolean, is_me boolean"


def msg(i, ts, me, text, source="f", system=False, recalled=False, uid=None):
    return (source, i, str(i), str(i), ts, uid or ("me" if me else "o"), "", "n", "", text, "text", system, recalled, me)


def messages(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def fold(rows, s):
    """The rules, plainly: (source, session, block, first turn, last turn, light interruptions)."""
    out = []
    for source in sorted({r[0] for r in rows}):
        turns = []
        for r in sorted((r for r in rows if r[0] == source and not r[12]), key=lambda r: (r[4], r[1])):
            t = (r[9] or "").strip()
            if turns and turns[-1]["me"] == r[13] and (s.turn_gap_seconds <= 0 or r[4] - turns[-1]["e"] < s.turn_gap_seconds * 1000):
                turns[-1]["e"] = r[4]
                turns[-1]["n"] += len(t)
                turns[-1]["f"] += bool(t)
            else:
                turns.append({"me": r[13], "sys": r[11], "s": r[4], "e": r[4], "n": len(t), "f": int(bool(t))})
        sessions = []
        for t in turns:
            if sessions and t["s"] - sessions[-1][-1]["e"] <= s.session_gap_minutes * 60_000:
                sessions[-1].append(t)
            else:
                sessions.append([t])
        base, wait = 0, s.my_block_continue_seconds * 1000
        for k, ts in enumerate(sessions):
            i = n = 0
            while i < len(ts):
                if not ts[i]["me"] or ts[i]["sys"]:
                    i += 1
                    continue
                j, light, chars, frags = i + 1, 0, ts[i]["n"], ts[i]["f"]
                while j < len(ts):
                    t, gap, medium = ts[j], ts[j]["s"] - ts[j - 1]["e"], False
                    if t["me"]:
                        if gap > wait:
                            break
                    elif t["n"] >= s.hard_interruption_chars:
                        break
                    elif t["n"] <= s.light_interruption_chars and light < s.max_light_interruptions:
                        light += 1
                    elif gap <= wait and any(u["me"] and u["s"] - t["e"] <= wait for u in ts[j + 1 : j + 5]):
                        medium = True
                    else:
                        break
                    chars, frags, j = chars + t["n"], frags + t["f"], j + 1
                    if medium and (frags > s.max_fragment_count or chars > s.max_block_chars):
                        break
                out.append((source, k, n, base + i, base + j - 1, light))
                n, i = n + 1, j
            base += len(ts)
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_extraction_against_the_plain_fold(spark, seed):
    rng = random.Random(seed)
    rows, t = [], 0
    for i in range(400):
        t += rng.choice([0, 5_000, 60_000, 89_999, 90_000, 119_999, 120_000, 120_001, 400_000, 1_200_000, 1_200_001])
        rows.append(msg(i, t, rng.random() < 0.5, "x" * rng.choice([0, 1, 3, 10, 20, 21, 60, 90, 150]), rng.choice("fg"), rng.random() < 0.1, rng.random() < 0.1))
    s = replace(TUNED, turn_gap_seconds=rng.choice([0, 30, 90]), max_block_chars=200, max_fragment_count=9, max_light_interruptions=2)
    got = bl.blocks_of(messages(spark, rows), s).selectExpr("source_file", "session_no", "block_no", "first_turn", "last_turn", "metrics.interruption_count")
    assert sorted(map(tuple, got.collect())) == fold(rows, s)


def test_turn_gap_and_session_gap_are_exact(spark):
    rows = [msg(0, 0, True, "a"), msg(1, 89_999, True, "b"), msg(2, 179_999, True, "c"), msg(3, 179_999 + 1_200_000, True, "d"), msg(4, 2_580_000 + 1, True, "e")]
    sessions = bl.split_sessions(bl.build_turns(messages(spark, rows), CODE_DEFAULTS), CODE_DEFAULTS).orderBy("turn_no").collect()
    assert [r["fragments"] for r in sessions] == [["a", "b"], ["c"], ["d"], ["e"]]
    assert [r["session_no"] for r in sessions] == [0, 0, 0, 1]


def test_files_stay_apart_and_metrics_add_up(spark):
    rows = [msg(0, 1000, True, " hello \n", "a"), msg(1, 1001, True, "x", "b"), msg(2, 1500, False, "ok", "a"), msg(3, 2000, True, "again", "a"), msg(4, 2500, True, None, "a")]
    out = {r["source_file"]: r for r in bl.blocks_of(messages(spark, rows), CODE_DEFAULTS).collect()}
    m = out["a"]["metrics"]
    assert (out["a"]["my_text"], out["a"]["fragments"]) == ("hello\nagain", ["hello", "ok", "again"])
    assert (m["my_msg_count"], m["my_char_count"], m["total_char_count"], m["my_char_ratio"], m["interruption_count"]) == (2, 10, 12, 0.8333, 1)
    assert out["b"]["reasons"] == ["too_few_chars:1<50", "too_few_msgs:1<2"]
    assert out["b"]["bucket"] == "rejected"


def test_recalled_and_system(spark):
    rows = [msg(0, 0, True, "gone", recalled=True), msg(1, 1000, True, "notice", system=True), msg(2, 200_000, False, "hi"), msg(3, 201_000, True, "mine")]
    got = bl.blocks_of(messages(spark, rows), CODE_DEFAULTS).collect()
    assert [r["my_text"] for r in got] == ["mine"]


def test_empty_input_and_source_numbers(spark):
    assert bl.blocks_of(messages(spark, []), CODE_DEFAULTS).count() == 0
    m = messages(spark, [msg(0, 0, True, "a", "z"), msg(0, 0, True, "b", "a")])
    ids = {r["source_file"]: r["block_id"] for r in bl.number_sources(bl.blocks_of(m, CODE_DEFAULTS), m).collect()}
    assert ids == {"a": "source_0000_session_00000_block_000", "z": "source_0001_session_00000_block_000"}


def test_prefix_and_neighbours_over_chunks(spark):
    rows = [("k" if i % 3 else None, i, i % 7) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i int, v int").repartition(7)
    from pyspark.sql import functions as F

    got = bucketed_prefix(df, ["k"], F.floor(F.col("i") / 50).cast("long"), ["i"], value="v").orderBy("k", "i").collect()
    for key in (None, "k"):
        own = [r for r in got if r["k"] == key]
        assert [r["rank"] for r in own] == list(range(len(own)))
        assert [r["before"] for r in own] == [sum(x["v"] for x in own[:n]) for n in range(len(own))]
    ranked = bucketed_prefix(df, ["k"], salt(["i"], 8), ["i"]).collect()
    assert sorted(r["rank"] for r in ranked if r["k"] == "k") == list(range(sum(r[0] == "k" for r in rows)))
    near, w, own = with_neighbours(df.where("k = 'k'").withColumn("pos", F.row_number().over(__import__("pyspark").sql.Window.partitionBy("k").orderBy("i")) - 1), ["k"], "pos", 1, 2, chunk=16)
    seen = near.withColumns({"b": F.lag("i").over(w), "a": F.lead("i", 2).over(w)}).where(own).orderBy("pos").collect()
    values = [r["i"] for r in seen]
    assert [r["b"] for r in seen] == [None, *values[:-1]]
    assert [r["a"] for r in seen] == [*values[2:], None, None]
