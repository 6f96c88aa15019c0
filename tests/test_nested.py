import json

from pyspark.sql import functions as F

from murmurlake.operators import nested

SCHEMA = """row_id long, node_path string, content struct<elements: array<struct<kind:string, data:struct<text:string,
 forward:struct<title:string, items:array<struct<sender:string, elements:array<struct<kind:string>>>>>>>>>,
 elements array<struct<kind:string, data:struct<text:string, forward:struct<title:string, items:array<struct<sender:string, elements:array<struct<kind:string>>>>>>>>"""
ROOTS = {"elements": ("content.elements", "elements")}


def element(kind, text=None, items=None):
    return {"kind": kind, "data": {"text": text, "forward": None if items is None else {"title": "t", "items": items}}}


def rows():
    deep = element("forward", items=[None, {"sender": "a", "elements": [{"kind": "x"}, None, {"kind": "y"}]}, {"sender": None, "elements": None}])
    return [
        (1, "clash", {"elements": [element("text", "hi"), None, deep]}, None),
        (2, None, {"elements": []}, [element("text", "fallback")]),
        (3, None, None, None),
        (4, None, None, []),
        (5, None, {"elements": None}, [None, None]),
        (1, "clash", {"elements": [element("text", "hi"), None, deep]}, None),
    ]


def brute(row):
    out = []

    def visit(elements, prefix, parent):
        for i, e in enumerate(elements or []):
            if e is None:
                continue
            path = f"{prefix}{i}"
            out.append((row[0], path, parent))
            forward = (e.get("data") or {}).get("forward") or {}
            for j, item in enumerate(forward.get("items") or []):
                if item is None:
                    continue
                out.append((row[0], f"{path}.items.{j}", path))
                for k, x in enumerate(item["elements"] or []):
                    if x is not None:
                        out.append((row[0], f"{path}.items.{j}.elements.{k}", f"{path}.items.{j}"))

    content = (row[2] or {}).get("elements")
    visit(content or row[3], "elements.", "")
    return out


def test_every_object_once_with_its_parent(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = sorted((r["row_id"], r["node_path"], r["parent_path"]) for r in nested.emit_objects(df, "row_id", ROOTS).collect())
    assert got == sorted(x for r in rows() for x in brute(r))


def test_payload_round_trip(spark, tmp_path):
    df = spark.createDataFrame(rows()[:2], SCHEMA)
    tagged = nested.emit_objects(df, "row_id", ROOTS)
    nested.write_tables(tagged, str(tmp_path / "t"))
    back = spark.read.schema(tagged.schema).parquet(str(tmp_path / "t"))
    flat = nested.apply_schema(back, df, "row_id", "elements", ROOTS)
    texts = {(r["row_id"], r["node_path"]): r["data"]["text"] for r in flat.collect()}
    assert texts == {(1, "elements.0"): "hi", (1, "elements.2"): None, (2, "elements.0"): "fallback"}
    items = nested.apply_schema(back, df, "row_id", "elements.data.forward.items", ROOTS).collect()
    assert sorted((r["node_path"], r["sender"]) for r in items) == [("elements.2.items.1", "a"), ("elements.2.items.2", None)]
    payloads = [json.loads(r["payload"]) for r in tagged.where(F.col("table") == "elements").collect()]
    assert all("items" not in json.dumps(p) for p in payloads)


def test_empty_table(spark):
    assert nested.emit_objects(spark.createDataFrame([], SCHEMA), "row_id", ROOTS).count() == 0


def test_flat_tables_hold_every_object_with_its_payload(spark):
    from murmurlake.plans.data_queries import QUERIES

    folder = "/root/testdata/sf0.001"
    rows = QUERIES["p2_flat"](spark, folder).collect()
    found = {(r["row_id"], r["node_path"]) for r in rows}
    wanted = nested.emit_objects(spark.read.parquet(f"{folder}/messages.parquet"), "row_id", nested.MESSAGE_ROOTS).collect()
    key = lambda r, data: (r["row_id"], r["table"], r["node_path"], r["parent_path"], r["position"], json.dumps(json.loads(r[data]), sort_keys=True))
    assert sorted(key(r, "data") for r in rows) == sorted(key(r, "payload") for r in wanted)
    assert len({r["table"] for r in rows}) > 3 and {(r["row_id"], r["parent_path"]) for r in rows if r["table"].endswith(".items")} <= found
