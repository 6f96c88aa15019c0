import pytest
from pyspark.sql import functions as F

from murmurlake import config
from murmurlake.config import CODE_DEFAULTS, TUNED, Words
from murmurlake.functions import text as tx
from murmurlake.operators import dedup, filters, review, scoring

METRICS = "my_msg_count long, my_char_count long, total_char_count long, my_turn_count long, short_fragment_ratio double, my_char_ratio double"
SCHEMA = f"doc_id long, source_file string, session_id string, my_text string, bucket string, reasons array<string>, metrics struct<{METRICS.replace(' ', ':').replace(',:', ',')}>"


def block(i, text, chars=None, turns=1, frags=1, short=0.0, ratio=1.0, total=None, bucket=None):
    n = len(text or "") if chars is None else chars
    return (i, "f", "session_00000", text, bucket, [], (frags, n, total or n, turns, short, ratio))


def frame(spark, *blocks):
    return spark.createDataFrame(list(blocks), SCHEMA)


W = Words(analysis=("其实", "其实"), tone=("吧",), light_interruption=("哈哈",), mild=("Damn", "死"), strong=("废物",), high_risk=("Mail",), medium_risk=("电话",), argument=("但是",), analysis_tag=("我觉得",))


def scores(spark, text, **kw):
    return scoring.score_blocks(frame(spark, block(1, text, **kw)), W, CODE_DEFAULTS).first()["scores"]


def test_style_points(spark):
    assert scores(spark, "")["style_score"] == 0
    assert scores(spark, None)["junk_score"] == 0
    assert scores(spark, "其实吧")["style_score"] == 5.0  # a word listed twice counts twice
    assert scores(spark, "不是A而是B。先C再D。我觉得E")["style_score"] == 2 + 1.5 + 1 + 1
    assert scores(spark, "不是A。而是B")["style_score"] == 0
    assert scores(spark, "x", chars=120, turns=5, frags=5)["style_score"] == 2 + 1 + 0.5 + 1.5
    assert scores(spark, "说白了 a\n b \n\n c")["style_score"] == 1.5 + 1


def test_privacy_points(spark):
    assert scores(spark, "mail a.b@c.de")["privacy_score"] == 3 + 4
    assert scores(spark, "15412345678")["privacy_score"] == 4 + 2
    assert scores(spark, "的12345678")["privacy_score"] == 0  # no word boundary
    assert scores(spark, "12345678 1234567 87654321")["privacy_score"] == 4
    assert scores(spark, "WWW.x.y 电话")["privacy_score"] == 3.5
    assert scores(spark, "a@b.cd 15412345678 330102199001011234 www.x " + "12345678 " * 9)["privacy_score"] == 15


def test_junk_and_chaos_points(spark):
    assert scores(spark, "？！。")["junk_score"] == 5
    assert scores(spark, "哈哈哈哈哈")["junk_score"] == 0
    assert scores(spark, "哈哈" * 6)["junk_score"] == 4 + 3
    assert scores(spark, "abc", short=0.71, total=1201)["junk_score"] == 6
    assert scores(spark, "DAMN 死 废物 废物")["chaos_score"] == 4
    assert scores(spark, "a\na\na\na\nb")["chaos_score"] == 2


def decided(spark, blocks, s=CODE_DEFAULTS, **cols):
    df = frame(spark, *blocks)
    sc = F.struct(*[F.lit(float(cols.get(n, 0))).alias(f"{n}_score") for n in ("style", "privacy", "junk", "chaos")])
    rows = scoring.decide_buckets(df.withColumn("scores", sc), ["doc_id"], s).orderBy("doc_id").collect()
    return [(r["bucket"], r["reasons"]) for r in rows]


@pytest.mark.parametrize(
    ("cols", "kw", "want"),
    [
        (dict(privacy=8, style=3), {}, ("need_anonymize", ["high_privacy_but_has_style"])),
        (dict(privacy=9), {}, ("rejected", ["high_privacy_no_style"])),
        (dict(junk=6.5), {}, ("rejected", ["junk_score_too_higher:6.5"])),
        (dict(privacy=5, style=3), {}, ("need_anonymize", ["medium_privacy_with_style"])),
        (dict(privacy=5, style=2), {}, ("micro_style", ["low_style_but_has_tone"])),
        (dict(chaos=4, style=2), {}, ("chaos_style", ["chaotic_but_has_style"])),
        (dict(chaos=4, junk=3), {}, ("rejected", ["chaos_and_junk"])),
        (dict(chaos=4), {}, ("chaos_style", ["chaos_separated"])),
        (dict(style=5), dict(chars=30), ("candidates", ["high_style_score"])),
        (dict(style=5), dict(chars=29), ("micro_style", ["short_but_high_style"])),
        (dict(style=5, chaos=3, junk=3), dict(chars=30, ratio=0.5), ("debatable", ["debatable_gate_failures:chaos,junk,ratio"])),
        (dict(style=1, junk=3, chaos=2), {}, ("rejected", ["rejected_fallback:style_too_low:1.0|elevated_junk:3.0|elevated_chaos:2.0"])),
    ],
)
def test_decision_rules(spark, cols, kw, want):
    assert decided(spark, [block(1, "x", **kw)], **cols) == [want]


def test_decision_without_debatable_and_presets(spark):
    off = CODE_DEFAULTS.with_(debatable_enable=False)
    assert decided(spark, [block(1, "x", chars=30, ratio=0.5)], off, style=5) == [("rejected", ["candidate_low_ratio:0.50"])]
    assert decided(spark, [block(1, "x", chars=30)], off, style=5, chaos=3) == [("rejected", ["candidate_chaotic:3.0"])]
    assert decided(spark, [block(1, "x", bucket="odd"), block(2, "", bucket="rejected"), block(3, "")]) == [
        ("rejected", []),
        ("rejected", []),
        ("rejected", ["rejected_fallback:style_too_low:0"]),
    ]


def test_debatable_cap_prefers_long_blocks(spark):
    got = decided(spark, [block(i, "x", chars=30 + i, ratio=0.5) for i in range(4)], CODE_DEFAULTS.with_(debatable_max_per_run=2), style=5)
    assert [b for b, _ in got] == ["rejected", "rejected", "debatable", "debatable"]
    assert got[0][1][-1] == "debatable_overflow_prioritized"


def test_tags(spark):
    rows = scoring.score_blocks(frame(spark, block(1, "我觉得但是", chars=200, turns=4), block(2, "嗯")), W, CODE_DEFAULTS)
    got = {r["doc_id"]: r["style_tags"] for r in scoring.tag_blocks(rows, W, CODE_DEFAULTS).collect()}
    assert got == {1: ["analysis_explaining", "qq_fragmented_long_speech", "argument"], 2: ["low_signal"]}
    assert scoring.tag_blocks(rows, W, CODE_DEFAULTS.with_(style_tags_enable=False)).first()["style_tags"] == []


def test_masks_and_drops(spark):
    df = frame(spark, block(1, "Bob met bob at A.B"), block(2, "bob", bucket="rejected"), block(3, None), block(4, "Drop it"))
    got = {r["doc_id"]: (r["my_text"], r["reasons"]) for r in filters.mask_words(df, ["BOB", "a.b", ""]).collect()}
    assert got[1] == ("[MASKED] met [MASKED] at [MASKED]", ["masked_word:2", "masked_word:1"])
    assert got[2] == ("bob", []) and got[3] == (None, [])
    dropped = {r["doc_id"]: (r["bucket"], r["reasons"]) for r in filters.drop_sentences(df, ["nope", "drop"]).collect()}
    assert dropped[4] == ("rejected", ["dropped_by_sentence_word:drop"]) and dropped[2] == ("rejected", []) and dropped[3] == (None, [])


def test_privacy_modes(spark):
    df = frame(spark, block(1, "x"), block(2, "x", bucket="candidates")).withColumn(
        "scores", F.struct(F.lit(2.0).alias("style_score"), F.lit(5.0).alias("privacy_score"), F.lit(0.0).alias("junk_score"), F.lit(0.0).alias("chaos_score"))
    )
    strict = filters.privacy_mode(df, CODE_DEFAULTS.with_(privacy_mode="strict")).orderBy("doc_id").collect()
    assert [(r["bucket"], r["reasons"]) for r in strict] == [("rejected", ["strict_privacy:score=5.0"])] * 2
    recall = filters.privacy_mode(df, CODE_DEFAULTS.with_(privacy_mode="recall")).orderBy("doc_id").collect()
    assert [r["bucket"] for r in recall] == ["need_anonymize", "candidates"]


def test_review_decisions_cannot_override_filters(spark):
    df = filters.with_review_ids(frame(spark, block(1, "open"), block(2, "shut", bucket="rejected"), block(3, "drop me")))
    ids = {r["doc_id"]: r["review_id"] for r in df.collect()}
    lines = [(1, "block", ids[1], "drop"), (2, "block", f" {ids[1]} ", "keep"), (3, "block", ids[2], "keep"), (4, "block", ids[3], "drop"), (5, "phrase", "p", "KEEP"), (6, None, "q", "keep")]
    d = filters.latest_decisions(spark.createDataFrame([(*x, None) for x in lines], "line_no int, kind string, decision_key string, decision string, reason string"))
    got = {r["doc_id"]: (r["bucket"], r["manual_keep"], r["reasons"]) for r in filters.apply_decisions(df, d).collect()}
    assert got == {
        1: (None, True, ["manual_review_keep_requested"]),
        2: ("rejected", False, ["manual_review_keep_blocked_by_prior_filter"]),
        3: ("rejected", False, ["manual_review_drop"]),
    }
    assert len(ids[1]) == 24


def test_exact_copies_count_rejected_ones(spark):
    df = frame(spark, block(1, "a", bucket="rejected"), block(2, "a"), block(3, "a"), block(4, "b"), block(5, None))
    got = {r["doc_id"]: (r["bucket"], r["reasons"]) for r in dedup.limit_copies(df, F.floor(F.col("doc_id") / 2), ["doc_id"], 2).collect()}
    assert got == {1: ("rejected", []), 2: (None, []), 3: ("rejected", ["exact_duplicate:kept_2_already"]), 4: (None, []), 5: (None, [])}


def test_near_duplicates_go_greedily(spark):
    texts = ["这是一个足够长的相近表达", "这是一个足够长的相近表达呀", "这是一个足够长的相近表达 ", "别的", "", "", "x", "y", "这是一个足够长的相近表达呀呀"]
    df = frame(spark, *[block(i, t) for i, t in enumerate(texts)])
    got = {r["doc_id"]: (r["bucket"], r["reasons"]) for r in dedup.reject_near(df, "doc_id", 0.7).collect()}
    assert got[1] == ("rejected", ["near_duplicate:similarity=0.92"]) and got[2] == ("rejected", ["near_duplicate:similarity=1.00"])
    assert [got[i][0] for i in (0, 3, 6, 7)] == [None] * 4 and got[8][0] == "rejected"
    assert got[5] == ("rejected", ["near_duplicate:similarity=1.00"])


def test_near_duplicates_against_all_pairs(spark):
    import random

    rng = random.Random(1)
    base = ["".join(rng.choice("abcd") for _ in range(30)) for _ in range(6)]
    texts = [b[: rng.randrange(20, 31)] + rng.choice(["", "x", "yz"]) for b in base * 6]
    df = frame(spark, *[block(i, t) for i, t in enumerate(texts)])
    pairs = lambda t: {t[i : i + 2] for i in range(len(t) - 1)}
    kept, gone = [], set()
    for i, t in enumerate(texts):
        if any(t == u or len(pairs(t) & pairs(u)) / len(pairs(t) | pairs(u)) >= 0.85 for u in kept):
            gone.add(i)
        else:
            kept.append(t)
    assert {r["doc_id"] for r in dedup.near_duplicates(df, "doc_id", "my_text", 0.85).collect()} == gone


def test_sample_sizes_and_repeatability(spark):
    df = filters.with_review_ids(frame(spark, *[block(i, f"t{i}", bucket="rejected") for i in range(50)])).withColumn("scores", F.struct(F.lit(5.0).alias("style_score")))
    one = {r["doc_id"] for r in review.stratified_sample(df, 7, 1).collect()}
    assert len(one) == 7 and one == {r["doc_id"] for r in review.stratified_sample(df.repartition(3), 7, 1).collect()}
    assert one != {r["doc_id"] for r in review.stratified_sample(df, 7, 2).collect()}


def test_text_helpers(spark):
    df = spark.createDataFrame([("  　a\x1c\n", "a😀a😀", "abcab")], "s string, e string, g string")
    r = df.select(tx.strip(F.col("s")).alias("s"), tx.occurrences(F.col("e"), "a").alias("n"), F.sort_array(tx.bigrams(F.col("g"))).alias("b"), tx.bigrams(F.lit("x")).alias("one")).first()
    assert (r["s"], r["n"], r["b"], r["one"]) == ("a", 2, ["ab", "bc", "ca"], [])


def test_settings():
    assert config.from_mapping({"interruption": {"light_interruption_chars": 7}, "phrase_mining": {"keyness": {"enabled": False}, "auto_promote": {"min_pmi": 9.0}}}).promote_min_pmi == 9.0
    assert TUNED.max_block_chars == 1000 and CODE_DEFAULTS.max_block_chars == 1200
    for bad in ({"ratio": {"max_short_fragment_ratio": 1.5}}, {"privacy": {"mode": "x"}}, {"interruption": {"light_interruption_chars": 500}}, {"character": {"writer_name": "a/b"}}, {"time": {"turn_gap_seconds": "x"}}):
        with pytest.raises(ValueError):
            config.from_mapping(bad)
    assert 'writer_name = "a\\"b"' in config.snapshot(CODE_DEFAULTS.with_(writer_name='a"b'))
    assert config.expand("x/{writer_name}/y", "w", "/r") == "/r/x/w/y"
    with pytest.raises(ValueError):
        config.expand("{writer_name}", "", "/")
