import datetime as dt

import pytest

from murmurlake.llm import conversations, moderation, pii

G = moderation.grammar()


@pytest.mark.parametrize(
    "text",
    [
        "你就是个废物",
        "你这种废🍵物也配说话",
        "一家子垃.圾.玩.意",
        "脑脑脑脑残，快滚！",
        "你这种腦殘也配说话",
        "说你呢，feiwu",
        "又是你这个臭重，恶心谁呢",
        "真是个春虫货",
        "白·痴闭嘴吧",
        "你呼吸都是浪费空气",
        "信不信我明天就去弄死你",
        "下班别走，陪 睡",
        "发张luo照看看",
        "开视频，tuo光给我看",
        "这身材真馬蚤，想摸",
        "泽岭人都是臭虫",
        "把坞北人统统赶出去，看着就脏",
        "shut up you 1d10t",
        "what a m o r o n",
        "come to bed with me now, s.l.u.t",
        "those greycap people are vermin, all of them",
        "有人在帖子里骂我畜生，我好难过。你就是个废物",
    ],
)
def test_abuse_is_scored_however_spelled(text):
    assert G(text)[0] >= moderation.THRESHOLD, G(text)


@pytest.mark.parametrize(
    "text",
    [
        "有人在帖子里骂我窝囊废，我好难过",
        "群规第三条：不许骂人，比如“蠢货”这种词",
        "剧里那句台词“去死吧”演得好假",
        "白痴这本小说我看了三遍",
        "小狗傻乎乎的太可爱了",
        "垃圾要分类",
        "猪肉又涨价，今天热死了",
        "shut down the printer please",
        "滚动条怎么拖不动",
        "裸辞以后睡得真香",
        "泽岭人过节要挂雪圆龟，挺有意思",
        "你不是废物",
        "absolutely, slutsky is a surname",
        "",
        None,
    ],
)
def test_mentions_and_harmless_senses_are_not(text):
    assert G(text)[0] < moderation.THRESHOLD, G(text)


def test_very_long_text_is_read_to_its_end():
    assert G("好的。" * 30_000 + "你就是个废物")[0] >= 1


def test_scores_and_rates(spark):
    df = spark.createDataFrame([(1, "a", "你就是个废物", 9), (2, "a", "好", 9), (3, None, None, 9), (1, "a", "你就是个废物", 9)], "row_id long, source_file string, text string, score int")
    scored = moderation.score_texts(df)
    assert sorted((r["row_id"], r["abuse_kind"]) for r in scored.collect()) == [(1, "insult"), (1, "insult"), (2, ""), (3, "")]
    assert {r["source_file"]: (r["n_rows"], r["n_abusive"]) for r in moderation.rates(scored, "source_file").collect()} == {"a": (3, 2), None: (1, 0)}
    assert moderation.score_texts(df.limit(0)).count() == 0


def test_weights_are_fitted_to_one_part_of_the_labels_and_hold_on_the_other(spark):
    """Agreement with the reviewers, who err at times themselves, where their table is here."""
    import os

    d = "/root/testdata/sf0.1"
    if not os.path.exists(f"{d}/moderation_labels.parquet"):
        pytest.skip("no labels")
    messages, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("messages", "moderation_labels"))
    weights = moderation.learned_weights(messages, labels)
    assert any(abs(weights[k] - w) > 0.01 for k, (w, _) in moderation.WORDS.items())
    held = labels.where("pmod(xxhash64(row_id), 2) = 0")
    scored = moderation.score_texts(messages.select("row_id", "text").join(held, "row_id"), weights=weights).select("abusive", "abuse_score").collect()
    right = sum((r["abuse_score"] >= 1) == bool(r["abusive"]) for r in scored)
    assert len(scored) > 500 and right / len(scored) > 0.95, right / len(scored)


def test_weights_without_labels_are_those_listed():
    assert moderation.fit_weights([]) == moderation.fit_weights([(-1, 0.0, 1, 9)]) == {k: w for k, (w, _) in moderation.WORDS.items()}
    # Reviewers who never call a path abusive make it lighter; seldom seen ones hardly move it.
    path = next(i for i, p in enumerate(moderation.PATHS) if p[1] == ("body", "lewd"))
    often, once = (moderation.fit_weights([(path, 0.0, 0, n)]) for n in (5000, 1))
    assert often["body"] + often["lewd"] < 1.0 < once["body"] + once["lewd"] + 0.03


@pytest.mark.parametrize("text", ["你是个笨蛋", "你真是个蠢材", "you are an imbecile", "你这个狗娘养的", "我要打断他的腿", "You absolute d1ps#it, you dipshit", "im gonna kill them"])
def test_other_wording_than_the_tables(text):
    assert G(text)[0] >= moderation.THRESHOLD, G(text)


@pytest.mark.parametrize("text", ["你就是个废物", "骂我废物，", "“废物”", "废物不是", "a1 b2 ", "白痴这本小说"])
def test_cost_is_linear(text):
    import time

    took = []
    for n in (50_000, 100_000):
        whole, began = "骂我" + text * (n // len(text)), time.perf_counter()
        G(whole)
        G(text * (n // len(text)))
        took.append(time.perf_counter() - began)
    assert took[1] < 2.0 and took[1] < 4 * took[0] + 0.1


MESSAGES = """row_id long, source_file string, conv_id long, msg_id string, seq string, timestamp_ms long, time_text string, uid string,
 sender struct<uid:string>, text string, is_system boolean, recalled boolean, ingested_at timestamp, role string"""


def row(i, conv, seq, text="x", uid="me", msg=None, t=None, recalled=None, system=None, day=1, sender=None):
    return (i, "f", conv, msg or f"m{i}", seq, t, None, uid, sender, text, system, recalled, dt.datetime(2012, 1, day), "clash")


def verdicts(spark, rows, seq_range=4096):
    files = spark.createDataFrame([("f", "me"), ("f", "me"), ("f", None), (None, "x")], "source_file string, self_uid string")
    turns = conversations.fold_versions(spark.createDataFrame(rows, MESSAGES))
    v = conversations.judge(turns, files, seq_range)
    out = sorted((r["conv_id"], r["defect"]) for r in conversations.defects(v).collect())
    left = [(r["conv_id"], r["position"], r["role"], r["text"]) for r in conversations.rebuild(turns, files, v).orderBy("conv_id", "position").collect()]
    return out, left


T0 = 1_325_469_197_000


@pytest.mark.parametrize("seq_range", [1, 4096])
def test_defects(spark, seq_range):
    rows = [
        row(1, 1, " 0007"), row(2, 1, "8.0", uid="o"), row(3, 1, "9", uid=None, sender=("me",)),
        row(4, 2, "1"), row(5, 2, "3", uid="o"),  # a gap
        row(6, 3, "1"), row(7, 3, "1", uid="o"),  # a repeat
        row(8, 4, "n/a"), row(9, 4, "2", uid="o"),
        row(10, 5, "1", t=T0 + 5), row(11, 5, "2", uid="o"), row(12, 5, "3", t=T0),  # back in time
        row(13, 6, "1", text=" \n"), row(14, 6, "2", uid="o", recalled=True), row(15, 6, "3", uid="o", system=True),
        row(16, 7, "1", uid="o"), row(17, 7, "2", uid=None),
        row(18, 8, None), row(19, 8, "1.5"),
        row(20, 9, "1", t=T0), row(21, 9, "2", uid="o", t=T0), row(22, 9, "3", t=T0 // 1000 + 1),
    ]
    out, left = verdicts(spark, rows, seq_range)
    assert out == [(2, "broken"), (3, "broken"), (4, "broken"), (5, "broken"), (6, "empty"), (7, "no_reply"), (8, "broken"), (8, "no_reply")]
    assert left == [(1, 0, "me", "x"), (1, 1, "other", "x"), (1, 2, "me", "x"), (9, 0, "me", "x"), (9, 1, "other", "x"), (9, 2, "me", "x")]


def test_roles_are_those_of_rows_with_text(spark):
    """A conversation in which only blank, recalled or system rows are of the other side has no reply."""
    rows = [
        row(1, 1, "1"), row(2, 1, "2", uid="o", text=" \u3000\n"), row(3, 1, "3", uid="o", text=None),
        row(4, 2, "1"), row(5, 2, "2", uid="o", text="y", recalled=True), row(6, 2, "3", uid="o", text="y", system=True),
        row(7, 3, "1", uid="o", text=""), row(8, 3, "2", uid="o"), row(9, 3, "3", text=None),
        row(10, 4, "1"), row(11, 4, "2", uid="o", text=""), row(12, 4, "3", uid="o"),
    ]
    out, left = verdicts(spark, rows)
    assert out == [(1, "no_reply"), (2, "no_reply"), (3, "no_reply")]
    assert left == [(4, 0, "me", "x"), (4, 1, "other", ""), (4, 2, "other", "x")]


def test_hot_numbers_and_long_numbers(spark):
    """Many rows of one number, or of none, are summed up; numbers of any length are read, leading zeros aside."""
    rows = [row(i, 1, "5", msg=f"a{i}", uid="o" if i % 2 else "me") for i in range(300)] + [row(1000 + i, 2, "?", msg=f"b{i}") for i in range(300)]
    rows += [row(2000, 3, "0" * 60 + "1"), row(2001, 3, "2", uid="o"), row(2002, 4, "9" * 40), row(2003, 4, "1", uid="o")]
    out, _ = verdicts(spark, rows)
    assert out == [(1, "broken"), (2, "broken"), (2, "no_reply"), (4, "broken")]


def test_the_last_version_counts(spark):
    rows = [
        row(1, 1, "1", text="old", msg="a"), row(2, 1, "1", text="new", msg="a", day=2), row(3, 1, "2", uid="o", msg="b"),
        row(4, 1, "3", text="tie1", msg="c"), row(5, 1, "3", text="tie2", msg="c"), row(6, None, "1"),
    ]
    out, left = verdicts(spark, rows)
    assert out == [] and [x[3] for x in left] == ["new", "x", "tie2"]
    assert verdicts(spark, [])[0] == []


PII = {
    "发我邮箱 old.lamp@study.test 就行": [("email", 5)],
    "文件我传到RAIN.NOTE5@POST.EXAMPLE了": [("email", 5)],
    "lanbo0 (at) box dot invalid 这个邮箱还能用吗": [("email", 0)],
    "邮箱：ink_pot#study.test，别发错": [("email", 3)],
    "send it to tea.drinker＠box.invalid please": [("email", 11)],
    "代码里那个 foo@bar 装饰器怎么写的": [],
    "打我电话15423195317": [("phone", 4)],
    "新的是+86 15459759625": [("phone", 3)],
    "call me at (656) 555-0131 tonight": [("phone", 11)],
    "加我：一五四三零零六六五六九": [("phone", 3)],
    "手机号 １５４１０８９０９３１，微信同号": [("phone", 4)],
    "订单号344485668628查一下": [],
    "会议号 177-318-046 两点开始": [],
    "快递单号YT1540228366788到了没": [],
    "流水号 943115198511114587 已退款": [],
    "身份证号944986200701043062": [("id_number", 4)],
    "my id is ZQ3579443": [("id_number", 9)],
    "证件号码：919-10-4254，订票用": [("id_number", 5)],
    "我现在住澜泊市石渡区青芜街27号，离地铁近": [("address", 4)],
    "寄到听雨弄89弄17号楼297，谢谢": [("address", 2)],
    "导航搜Flat 7, 86 Wren Hollow Drive就能找到": [("address", 3)],
    "霁原市听桐路七号院四单元": [("address", 0)],
    "在拾光街口等你，别走错": [],
    "这家店在新垄区挺有名的": [],
    "帮我跟欧阳听舟说一声": [("person", 3)],
    "卢听宁说明天不来了": [("person", 0)],
    "my teacher is Liora Dunmarrow by the way": [("person", 14)],
    "我叫司徒昀梧，请多关照": [("person", 2)],
    "林老师今天又拖堂了": [],
    "@雪桥 出来吃饭": [],
    "": [],
    None: [],
}


def test_personal_information(spark):
    rows = [(i, t, "clash") for i, t in enumerate(list(PII) * 5)]
    df = spark.createDataFrame(rows, "row_id long, text string, spans string")
    candidates, model = pii.fit(df, "row_id", "text")
    got = {}
    for r in pii.found_spans(candidates, model, "row_id").collect():
        got.setdefault(r["row_id"], []).append((r["pii_type"], r["start_pos"]))
    texts = list(PII)
    wrong = {texts[i]: (got.get(i, []), PII[texts[i]]) for i in range(len(texts)) if sorted(got.get(i, [])) != PII[texts[i]]}
    assert not wrong
    masked = {r["row_id"]: r["masked_text"] for r in pii.redact(df, model, "text").collect()}
    assert masked[0] == "发我邮箱 [EMAIL] 就行" and masked[texts.index(None)] is None
    assert masked[texts.index("订单号344485668628查一下")] == "订单号344485668628查一下"


def test_reliabilities_recover_hidden_truth():
    import random

    import numpy as np

    rng = random.Random(3)
    counts = {}
    for _ in range(4000):
        truth = rng.random() < 0.4
        votes = "".join(("+" if truth else "-") if rng.random() < p else ("-" if truth else "+") for p in (0.95, 0.9, 0.85, 0.6))
        counts[votes] = counts.get(votes, 0) + 1
    patterns = sorted(counts)
    soft, table, prior = pii.reliabilities(patterns, np.array([counts[p] for p in patterns], float))
    assert abs(prior - 0.4) < 0.05 and table[1, 0, 2] > table[1, 3, 2] > 0.5
    w = pii.train_classifier(patterns, [[1]] * len(patterns), np.array([counts[p] for p in patterns], float), soft)
    model = pii.SpanModel({"email": w}, {})
    assert model.probability("email", "++++", [1]) > 0.9 and model.probability("email", "----", [1]) < 0.1
    assert model.probability("phone", "++++", []) == 0.0


def test_surroundings_speak_where_votes_don_t():
    import numpy as np

    votes, near = ["+0", "-0", "00", "00"], [[1], [2], [1], [2]]
    w = pii.train_classifier(votes, near, np.full(4, 100.0), np.array([0.99, 0.01, 0.9, 0.1]))
    model = pii.SpanModel({"person": w}, {})
    assert model.probability("person", "00", [1]) > 0.8 > 0.2 > model.probability("person", "00", [2])


def test_empty_table_fits_nothing(spark):
    df = spark.createDataFrame([], "row_id long, text string")
    candidates, model = pii.fit(df, "row_id", "text")
    assert pii.found_spans(candidates, model, "row_id").count() == 0


def test_names_stand_anywhere(spark):
    named = {
        "我是卢听宁，你好": 2, "明天去找卢听宁吧": 4, "和欧阳听舟一起": 1, "书要还给陈雨桐。": 4, "卢听宁": 0, "到了\n陈雨桐\n好": 3, "陈雨桐，请多关照": 0, "我和卢听宁": 2,
    }
    plain = ["谢谢", "马上来", "周末，见", "高兴吗", "于是吵", "白痴少说", "和平", "找时间", "方便的话给我", "金色"]
    texts = [*named, *plain, *["我叫卢听宁，请多关照", "帮我跟陈雨桐说一声"] * 20, *plain * 5]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string")
    candidates, model = pii.fit(df, "row_id", "text")
    got = {r["row_id"]: r["start_pos"] for r in pii.found_spans(candidates, model, "row_id").where("pii_type = 'person'").collect()}
    assert {i: got.get(i) for i in range(len(named) + len(plain))} == dict(enumerate([*named.values(), *[None] * len(plain)]))


# Sentences of other wording than those of the test tables, with what stands in them.
HELD = [
    ("王小明昨天来过我家", [("person", 0)]),
    ("昨天见到李建国了", [("person", 4)]),
    ("王小明的电话打不通", [("person", 0)]),
    ("陈晓东 提交了报告", [("person", 0)]),
    ("负责人：赵雅琴", [("person", 4)]),
    ("请把材料交给周文博", [("person", 6)]),
    ("我同事徐静怡下周结婚", [("person", 3)]),
    ("听说欧阳明月要出国了", [("person", 2)]),
    ("please ask Martha Kellerman about the invoice", [("person", 11)]),
    ("I met Oliver Brandt yesterday", [("person", 6)]),
    ("有问题请拨 13900001234", [("phone", 6)]),
    ("我的号码换成18655554321了", [("phone", 6)]),
    ("text me on +44 7700 900123 if late", [("phone", 11)]),
    ("the office line is (415) 555-0199", [("phone", 19)]),
    ("短信发到159 1234 5678", [("phone", 4)]),
    ("合同扫描件请抄送 finance.dept@corp.example 谢谢", [("email", 9)]),
    ("reach me: jo_k+news@mail.test", [("email", 10)]),
    ("他的邮箱好像是 lee.wang (at) post.example", [("email", 8)]),
    ("办护照填的是 110101199003074514", [("id_number", 7)]),
    ("her SSN was 219-09-9999, keep it safe", [("id_number", 12)]),
    ("passport EA1234567 expires soon", [("id_number", 9)]),
    ("快递放到杭州市西湖区文三路138号就行", [("address", 4)]),
    ("货送南京东路二十号", [("address", 2)]),
    ("we now live at 221 Baker Street", [("address", 15)]),
    ("the parcel went to 15 Old Mill Lane, Apt 3", [("address", 19)]),
    ("病历号 13812345678", []),
    ("订单 202311051234 已发货", []),
    ("航班号 CA1234 晚点了", []),
    ("升级到版本 10.0.19045 再试", []),
    ("会议号 512-334-908，晚上八点", []),
    ("高兴得跳起来", []),
    ("谢谢老师", []),
    ("方便的话明天来", []),
    ("人民路有点堵", []),
    ("浦东新区今天下雨", []),
    ("Good Morning everyone", []),
    ("马上就到", []),
    ("何必这么认真", []),
    ("白天太热了", []),
    ("这个 @foo 装饰器不错", []),
]


def test_other_wording_than_the_training_texts(spark):
    """Trained on the tables' texts, where they are here, and held against sentences that are none of theirs."""
    import os

    d = "/root/testdata/sf0.01"
    if not os.path.exists(f"{d}/messages.parquet"):
        pytest.skip("no messages")
    _, model = pii.fit(spark.read.parquet(f"{d}/messages.parquet"), "row_id", "text")
    label = pii.Labelers()
    hit = extra = missed = 0
    for text, gold in HELD:
        spans = [(k, a, b, v, pii.surroundings(text, k, a, b)) for k, a, b, v in label(text)]
        got = {(k, a) for k, a, _, _ in model.choose(spans)}
        hit, extra, missed = hit + len(got & set(gold)), extra + len(got - set(gold)), missed + len(set(gold) - got)
    assert hit / (hit + missed) >= 0.9 and hit / (hit + extra) >= 0.9, (hit, extra, missed)
