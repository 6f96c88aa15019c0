import json

from pyspark.sql import functions as F

from murmurlake.operators import drift


def payloads(n, **fields):
    return [json.dumps({k: (v(i) if callable(v) else v) for k, v in fields.items()}) for i in range(n)]


def table(spark, files, chat="c"):
    rows = [(f, chat, p) for f, lines in files.items() for p in lines]
    return spark.createDataFrame(rows, "file_no long, chat_id string, payload string")


def changes(spark, files):
    return sorted((r["file_no"], r["field_path"], r["drift"]) for r in drift.drift_report(table(spark, files)).collect())


BASE = dict(id=lambda i: f"2000{i}", seq=lambda i: str(i), timestamp=1326586429833, sender={"uid": "u_1", "name": "a"}, content={"text": "hello", "html": "<p>"})


def test_renames_and_new_types(spark):
    second = dict(BASE, sequence=BASE["seq"], id=lambda i: 2000 + i)
    del second["seq"]
    third = dict(second, sender={"uid": "u_1", "senderName": "a", "nickname": "n"}, edited=False)
    fourth = dict(third, sender="a", msgContent={"plain": "hello", "html": "<p>"})
    del fourth["content"]
    got = changes(spark, {1: payloads(8, **BASE), 2: payloads(8, **second), 3: payloads(8, **third), 4: payloads(8, **fourth)})
    assert got == [
        (2, "id", "retyped"),
        (2, "sequence", "renamed"),
        (3, "edited", "added"),
        (3, "sender.nickname", "added"),
        (3, "sender.senderName", "renamed"),
        (4, "msgContent", "renamed"),
        (4, "msgContent.plain", "renamed"),
        (4, "sender", "retyped"),
    ]


def test_rare_fields_foreign_layouts_and_cut_lines_are_no_changes(spark):
    foreign = payloads(1, msgId="1", sequence="2", time=3, **{"from": "x"}, message="m")
    first = payloads(8, **BASE)
    second = payloads(7, **BASE) + foreign + ['{"id": "1", "se', "", "[1]", "null"] + payloads(1, **dict(BASE, rare=1))
    assert changes(spark, {1: first, 2: second}) == []


def test_removed_is_named_as_before_and_chats_are_kept_apart(spark):
    less = {k: v for k, v in BASE.items() if k != "seq"}
    one = table(spark, {1: payloads(4, **BASE), 3: payloads(4, **less)})
    other = table(spark, {2: payloads(4, **less)}, "d")
    got = [tuple(r) for r in drift.drift_report(one.union(other)).select("chat_id", "file_no", "field_path", "drift").collect()]
    assert got == [("c", 3, "seq", "removed")]


def test_empty_and_unparsable(spark):
    assert changes(spark, {}) == []
    assert changes(spark, {1: ["x"], 2: payloads(3, **BASE)}) == []
    nulls = spark.createDataFrame([(None, "c", "{}"), (1, None, "{}"), (1, "c", None)], "file_no long, chat_id string, payload string")
    assert drift.drift_report(nulls).count() == 0


def test_flooding_converges_to_one_to_one():
    f = lambda t, fmt: {"type": t, "parent": "", "format": fmt}
    before = {("", "isOpen"): f("boolean", (0, 0, 0, 1.6)), ("", "clientKind"): f("string", (0, 0, 0, 1.4))}
    after = {("", "open"): f("boolean", (0, 0, 0, 1.6)), ("", "client_kind"): f("string", (0, 0, 0, 1.4))}
    assert drift.flood(before, after) == {("", "isOpen"): ("", "open"), ("", "clientKind"): ("", "client_kind")}
    assert drift.flood({}, after) == {}


def test_unified_table_keeps_every_record(spark):
    rows = [
        ('{"msgId": 7, "time": 1326586429, "from": "bob", "message": "hi", "isSystem": 1, "z": {"a": 1}}'),
        ('{"id": "8", "timestamp": "2012-01-23 21:48:05", "sender": {"uid": "u", "nick": "k"}, "content": {"plain_text": "yo"}}'),
        ("{broken"),
        (None),
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, payload string").withColumnRenamed("id", "record_id")
    out = {r["record_id"]: r for r in drift.unify(df, ["record_id"]).collect()}
    assert (out[0]["id"], out[0]["time_ms"], out[0]["sender_name"], out[0]["text"], out[0]["is_system"]) == ("7", 1326586429000, "bob", "hi", True)
    assert out[0]["extras"] == {"z": '{"a":1}'}
    assert (out[1]["time_ms"], out[1]["sender_name"], out[1]["text"]) == (1327355285000, "k", "yo")
    assert [out[i]["parsed"] for i in range(4)] == [True, True, False, False]


def test_unified_table_keeps_every_key(spark):
    elements = [{"type": "text", "data": {"text": "a"}}, {"type": "face", "data": {"id": 4}}, {"type": "text", "data": {"text": "b"}}]
    rows = [
        {"id": 1, "sender": {"uid": "u", "name": "n", "level": 3}, "content": {"elements": elements, "mentions": [{"uid": "m"}], "gone": None}},
        {"id": "2", "msgId": "3", "timestamp": "never", "system": "odd", "content": {"text": "x", "plain": "y"}, "from": 5},
        {"id": "4", "content": {"text": "x", "mentions": []}, "content.mentions": "z", "sender": {}},
    ]
    df = spark.createDataFrame([(i, json.dumps(r)) for i, r in enumerate(rows)], "record_id int, payload string")
    out = {r["record_id"]: r for r in drift.unify(df, ["record_id"]).collect()}
    assert out[0]["text"] == "a\nb"
    assert {k: json.loads(v) for k, v in out[0]["extras"].items()} == {"sender.level": 3, "content.elements": elements, "content.mentions": [{"uid": "m"}]}
    assert (out[1]["id"], out[1]["text"], out[1]["time_ms"], out[1]["is_system"]) == ("2", "x", None, None)
    assert out[1]["extras"] == {"msgId": "3", "timestamp": "never", "system": "odd", "content.plain": "y", "from": "5"}
    assert out[2]["extras"] == {"content": '{"mentions":[],"text":"x"}', "content.mentions": "z", "sender": "{}"}


def test_formats_alone_can_speak_for_a_rename(spark):
    first = dict(BASE, client=lambda i: ("android", "desktop")[i % 2], edited=True)
    second = dict(BASE, device=lambda i: ("desktop", "android")[i % 2], open=True)
    assert changes(spark, {1: payloads(8, **first), 2: payloads(8, **second)}) == [(2, "device", "renamed"), (2, "edited", "removed"), (2, "open", "added")]
    # Two fields that look the same leave it open.
    both = dict(second, origin=second["device"])
    assert (2, "device", "added") in changes(spark, {1: payloads(8, **first), 2: payloads(8, **both)})


def test_without_flooding_nothing_corresponds(spark):
    second = dict(BASE, sequence=BASE["seq"])
    del second["seq"]
    df = table(spark, {1: payloads(8, **BASE), 2: payloads(8, **second)})
    assert [r["drift"] for r in drift.drift_report(df).collect()] == ["renamed"]
    off = {r["drift"] for r in drift.drift_report(df, rounds=0).collect()}
    assert off == {"added", "removed"}


def test_fields_renamed_beyond_the_reader_s_names_are_united(spark):
    """The sequence number, the text, twice, and a field of its own get names that no list has."""
    second = dict(BASE, client=lambda i: ("android", "desktop")[i % 2])
    third = dict(second, content={"body": "hello", "html": "<p>"}, device=second["client"], ordinal=BASE["seq"])
    del third["client"], third["seq"]
    fourth = dict(third, content={"payloadText": "hello", "html": "<p>"})
    fifth = dict(fourth, content={"body": "x", "text": "y"})
    files = {1: payloads(8, **BASE), 2: payloads(8, **second), 3: payloads(8, **third), 4: payloads(8, **fourth) + payloads(1, **fifth)}
    df = table(spark, files).withColumn("record_id", F.monotonically_increasing_id())
    names = drift.corresponding_names(df)
    found = {(r["level"], r["key"]): r["name"] for r in names.collect()}
    own = found.pop(("", "client"), None) or found.pop(("", "device"), None)
    assert own in ("client", "device") and found == {("", "ordinal"): "seq", ("content", "body"): "text", ("content", "payloadText"): "text"}
    for at_once in (drift.NAMES_IN_ROW, 0):
        was, drift.NAMES_IN_ROW = drift.NAMES_IN_ROW, at_once
        try:
            out = drift.unify(df, ["file_no"], names=names).collect()
        finally:
            drift.NAMES_IN_ROW = was
        assert all(r["seq"] is not None for r in out) and {k for r in out if r["file_no"] > 1 for k in r["extras"]} <= {own, "content.body"}
        assert [r["text"] for r in out if r["file_no"] < 4] == ["hello"] * 24
        last = [r for r in out if r["file_no"] == 4]
        assert sorted(r["text"] for r in last) == ["hello"] * 8 + ["y"]
        assert [r["extras"]["content.body"] for r in last if r["text"] == "y"] == ["x"]  # two keys of one meaning: neither is lost


def test_payloads_with_keys_of_their_own_make_no_long_rows(spark):
    lines = [json.dumps(dict(id=f"2000{i}", seq=str(i)) | {f"k{i}_{j}": j for j in range(30)}) for i in range(40)]
    out = drift.profiles(table(spark, {1: lines})).first()
    assert sorted(f["key"] for f in out["fields"]) == ["id", "seq"]


def test_names_are_read_alike_however_many_there_are(spark, monkeypatch):
    """Keys that few records of a file carry, objects whose own name is found, and records without a file or chat."""
    names = spark.createDataFrame([("", "ordinal", "seq"), ("", "author", "sender"), ("sender", "title", "name"), ("content", "body", "text"), ("", "absent", "id")], "level string, key string, name string")
    renamed = dict(id="1", ordinal="5", author={"title": "t", "rank": 2}, content={"body": "hello"})
    lines = payloads(8, **BASE) + [json.dumps(renamed), json.dumps(dict(renamed, seq="6")), "{broken", "{}", "[1]"]
    places = [(1, "c"), (None, "c"), (1, None)]
    rows = [(i * 100 + j, f, c, p) for i, (f, c) in enumerate(places) for j, p in enumerate(lines)] + [(900, 1, "c", None)]
    df = spark.createDataFrame(rows, "record_id int, file_no long, chat_id string, payload string")
    got = []
    for at_once in (drift.NAMES_IN_ROW, 0):
        monkeypatch.setattr(drift, "NAMES_IN_ROW", at_once)
        got.append(sorted((r.asDict() for r in drift.unify(df, ["record_id"], names=names).collect()), key=lambda r: r["record_id"]))
    assert got[0] == got[1] and len(got[1]) == len(rows)
    out = {r["record_id"]: r for r in got[1]}
    for i in (8, 108, 208):
        assert (out[i]["seq"], out[i]["sender_name"], out[i]["text"], out[i]["extras"]) == ("5", "t", "hello", {"sender.rank": "2"})
        assert (out[i + 1]["seq"], out[i + 1]["extras"].get("ordinal")) == ("6", "5")
