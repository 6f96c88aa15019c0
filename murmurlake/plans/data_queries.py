"""Queries of the general data problems: nested records (2), drifting schemas (3), sessions (4)."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurlake.operators import drift, nested
from murmurlake.session import cut_folder
from murmurlake.sources.tables import account, message_time, table
from murmurlake.streaming.session_timers import timer_sessions


def _flat_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(messages, tagged rows of all flat tables, written partitioned by table and read back)."""
    messages = table(spark, folder, "messages")
    path = f"{cut_folder(spark)}/flat-{uuid.uuid4().hex}"
    nested.write_tables(nested.emit_objects(messages, "row_id", nested.MESSAGE_ROOTS), path)
    return messages, spark.read.schema("row_id long, node_path string, parent_path string, position int, payload string, table string").parquet(path)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return _flat_tables(spark, folder)[1].select("row_id", "node_path")


def p2_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, first-level rows and last position of each flat table."""
    return _flat_tables(spark, folder)[1].groupBy("table").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("parent_path") == "").alias("n_first_level"),
        F.max("position").cast("long").alias("max_position"),
    )


def p2_face_elements(spark: SparkSession, folder: str) -> DataFrame:
    """One flat table with its schema applied: face elements with their parent link."""
    messages, stored = _flat_tables(spark, folder)
    flat = nested.apply_schema(stored, messages, "row_id", "elements", nested.MESSAGE_ROOTS)
    return flat.where(F.col("data.face_id").isNotNull()).select(
        "row_id", "node_path", "parent_path", "kind", F.col("data.face_id").cast("long").alias("face_id")
    )


def p2_flat(spark: SparkSession, folder: str) -> DataFrame:
    """All flat tables, each with its schema applied: data is the object's own fields."""
    messages, stored = _flat_tables(spark, folder)
    links = ("row_id", "node_path", "parent_path", "position")

    def flat(tag: str) -> DataFrame:
        rows = nested.apply_schema(stored, messages, "row_id", tag, nested.MESSAGE_ROOTS)
        own = F.to_json(F.struct(*[c for c in rows.columns if c not in links]))
        return rows.select("row_id", F.lit(tag).alias("table"), "node_path", "parent_path", "position", own.alias("data"))

    return reduce(DataFrame.union, map(flat, nested.table_names(messages, nested.MESSAGE_ROOTS)))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return drift.drift_report(table(spark, folder, "raw_records")).select("file_no", "field_path", "drift")


def p3_unified(spark: SparkSession, folder: str) -> DataFrame:
    records = table(spark, folder, "raw_records")
    return drift.unify(records, ["record_id", "file_no"], names=drift.corresponding_names(records))


def p4_sessions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "messages").select(account().alias("uid"), message_time().alias("time_ms"))
    return timer_sessions(rows, "uid", "time_ms")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return p4_sessions(spark, folder).select("uid", "start_ms", "end_ms")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "p2_found": p2_found,
    "p2_tables": p2_tables,
    "p2_face_elements": p2_face_elements,
    "p2_flat": p2_flat,
    "p3_found": p3_found,
    "p3_unified": p3_unified,
    "p4_found": p4_found,
    "p4_sessions": p4_sessions,
}


def _level(source: str, array: str, path: str) -> str:
    return (
        f"SELECT row_id, {path} || CAST(i - 1 AS VARCHAR) AS p, a[i] AS o FROM "
        f"(SELECT *, {array} AS a, unnest(generate_series(1, len({array}))) AS i FROM {source}) WHERE a[i] IS NOT NULL"
    )


_NODES = f"""
m AS (SELECT row_id, CASE WHEN content.elements IS NULL OR len(content.elements) = 0 THEN elements ELSE content.elements END AS e,
  content.mentions AS me, sender.member.badges AS b FROM messages),
e1 AS ({_level("m", "e", "'elements.'")}),
i1 AS ({_level("e1", "o.data.forward.items", "p || '.items.'")}),
e2 AS ({_level("i1", "o.elements", "p || '.elements.'")}),
i2 AS ({_level("e2", "o.data.forward.items", "p || '.items.'")}),
e3 AS ({_level("i2", "o.elements", "p || '.elements.'")}),
me AS ({_level("m", "me", "'mentions.'")}),
ba AS ({_level("m", "b", "'badges.'")}),
nodes AS (
  SELECT row_id, p, 'elements' AS t FROM e1 UNION ALL
  SELECT row_id, p, 'elements.data.forward.items' FROM i1 UNION ALL
  SELECT row_id, p, 'elements.data.forward.items.elements' FROM e2 UNION ALL
  SELECT row_id, p, 'elements.data.forward.items.elements.data.forward.items' FROM i2 UNION ALL
  SELECT row_id, p, 'elements.data.forward.items.elements.data.forward.items.elements' FROM e3 UNION ALL
  SELECT row_id, p, 'mentions' FROM me UNION ALL
  SELECT row_id, p, 'badges' FROM ba)
"""

#: Usable time and uid of ``messages``, as TESTDATA.md defines them.
CLOCK = r"""
clock AS (SELECT *, coalesce(uid, sender.uid) AS who,
  CASE WHEN timestamp_ms >= 1262304000000 AND timestamp_ms < 1893456000000 THEN timestamp_ms
       WHEN timestamp_ms >= 1262304000 AND timestamp_ms < 1893456000 THEN timestamp_ms * 1000
       ELSE (SELECT CASE WHEN x >= 1262304000000 AND x < 1893456000000 THEN x END FROM (SELECT
         CASE WHEN regexp_full_match(time_text, '\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2}|\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}\.\d{1,6}Z|\d{4}/\d{1,2}/\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}')
           THEN epoch_ms(try_cast(replace(replace(replace(time_text, '/', '-'), 'T', ' '), 'Z', '') AS TIMESTAMP)) END AS x)) END AS t
  FROM messages)
"""

_SESSIONS = f"""
WITH {CLOCK},
a AS (SELECT who, t, row_id, CASE WHEN t - lag(t) OVER (PARTITION BY who ORDER BY t, row_id) <= 1200000 THEN 0 ELSE 1 END AS f
  FROM clock WHERE who IS NOT NULL AND t IS NOT NULL),
b AS (SELECT *, sum(f) OVER (PARTITION BY who ORDER BY t, row_id ROWS UNBOUNDED PRECEDING) AS g FROM a)
"""

ORACLES: dict[str, str] = {
    "p2_found": f"WITH {_NODES} SELECT row_id, p AS node_path FROM nodes",
    "p2_tables": f"""WITH {_NODES} SELECT t AS "table", count(*) AS n_rows,
        count(*) FILTER (WHERE len(string_split(p, '.')) = 2) AS n_first_level,
        max(CAST(string_split(p, '.')[-1] AS BIGINT)) AS max_position FROM nodes GROUP BY t""",
    "p2_face_elements": f"""WITH {_NODES} SELECT row_id, p AS node_path, '' AS parent_path, o.kind AS kind,
        CAST(o.data.face_id AS BIGINT) AS face_id FROM e1 WHERE o.data.face_id IS NOT NULL""",
    "p4_found": _SESSIONS + "SELECT who AS uid, min(t) AS start_ms, max(t) AS end_ms FROM b GROUP BY who, g",
    "p4_sessions": _SESSIONS
    + "SELECT who AS uid, min(t) AS start_ms, max(t) AS end_ms, max(t) - min(t) AS duration_ms, count(*) AS events FROM b GROUP BY who, g",
}
