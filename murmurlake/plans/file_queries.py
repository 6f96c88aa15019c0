"""Queries through files: exports read back, and what a run and a lexicon folder write, read back.

Each writes its files into the shared folder and returns what readers make of them, so that
SQL over the stored tables can tell whether anything got lost on the way.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurlake.functions.jsons import document
from murmurlake.operators import lexicon
from murmurlake.plans import core_oracles, reports
from murmurlake.plans.core_queries import _decided, _joined, _scored
from murmurlake.session import cut_folder
from murmurlake.sources import messages as src
from murmurlake.sources.tables import table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{cut_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _read_back(spark: SparkSession, folder: str, json_lines: bool) -> DataFrame:
    rows, _, _ = src.read_exports(spark, folder, json_lines=json_lines)
    file_no = F.regexp_extract("source_file", r"file_no=(\d+)", 1).cast("long").alias("file_no")
    return rows.select(file_no, "msg_idx", "msg_id", "seq", "uid", "is_system", "is_recalled")


def export_documents(spark: SparkSession, d: str) -> DataFrame:
    """The payloads that parse, as one export document a file, read back by the reader of exports."""
    lines = table(spark, d, "raw_records").where("file_no is not null").select("file_no", "line_no", "record_id", document("payload").alias("v")).where("v is not null")
    one = F.struct("line_no", "record_id", F.to_json("v").alias("j"))
    whole = F.concat(F.lit('{"chatInfo":{},"messages":['), F.array_join(F.transform(F.array_sort(F.collect_list(one)), lambda x: x["j"]), ","), F.lit("]}"))
    docs = lines.groupBy("file_no").agg(whole.alias("value"))  # an export is one document, so a file is one row
    path = _folder(spark, "exports")
    docs.select("file_no", F.from_json("value", "chatInfo struct<>, messages array<variant>").alias("e")).select("file_no", "e.messages").repartition("file_no").write.partitionBy("file_no").json(path)
    return _read_back(spark, path, json_lines=False)


def written_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Decided documents, written as bucketed JSON as a run does, and read back."""
    path = _folder(spark, "buckets")
    rows = reports.output_record(_decided(spark, d)).select("doc_id", "bucket", "reasons", "decision", "scores")
    rows.write.option("ignoreNullFields", False).partitionBy("bucket").json(path)
    back = spark.read.schema("doc_id long, reasons array<string>, decision string, bucket string").json(path)
    return back.select("doc_id", "bucket", _joined("reasons"))


def written_scores(spark: SparkSession, d: str) -> DataFrame:
    """The scores as they come back from written JSON."""
    path = _folder(spark, "scores")
    _scored(spark, d).select("doc_id", "scores").write.json(path)
    s = "style_score double, privacy_score double, junk_score double, chaos_score double"
    return spark.read.schema(f"doc_id long, scores struct<{s.replace(' double', ': double')}>").json(path).select("doc_id", "scores.*")


def lexicon_files(spark: SparkSession, d: str) -> DataFrame:
    """The lexicon table as a folder of lexicon files, read back; a stoplist has no attributes."""
    path = _folder(spark, "lexicon")
    lexicon._write_files(table(spark, d, "lexicon").withColumnRenamed("kind", "file"), path)
    return lexicon.read_folder(spark, path).where("trim(phrase) <> ''").select("kind", "phrase", "label", "severity", "risk", "status")


def archive_files(spark: SparkSession, d: str) -> DataFrame:
    """The lexicon's archive, written and read back."""
    path = _folder(spark, "archive")
    lexicon.write_archive(table(spark, d, "lexicon"), path)
    return lexicon.read_archive(spark, path).where("trim(phrase) <> ''").select("phrase", "old_category", "source_file", "participates_in_matching")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (export_documents, written_buckets, written_scores, lexicon_files, archive_files)}

_PARSED = """r AS (SELECT file_no, row_number() OVER (PARTITION BY file_no ORDER BY line_no, record_id) - 1 AS msg_idx, CAST(payload AS JSON) AS p
  FROM raw_records WHERE file_no IS NOT NULL AND json_valid(payload)),
o AS (SELECT file_no, msg_idx, p, coalesce(nullif(json_extract(p, '$.sender'), 'null'::JSON), nullif(json_extract(p, '$.fromUser'), 'null'::JSON), json_extract(p, '$.from')) AS s FROM r WHERE json_type(p) = 'OBJECT')"""


def _scalar(of: str, *names: str) -> str:
    """The first of the keys that holds a scalar other than null and the empty text, as text; else empty."""
    one = (f"nullif(CASE WHEN json_type({of}, '$.{n}') NOT IN ('OBJECT', 'ARRAY', 'NULL') THEN json_extract_string({of}, '$.{n}') END, '')" for n in names)
    return f"coalesce({', '.join(one)}, '')"


def _flag(name: str) -> str:
    return f"coalesce(CASE json_type(p, '$.{name}') WHEN 'BOOLEAN' THEN json_extract_string(p, '$.{name}') = 'true' WHEN 'VARCHAR' THEN try_cast(json_extract_string(p, '$.{name}') AS BOOLEAN) ELSE try_cast(json_extract_string(p, '$.{name}') AS DOUBLE) <> 0 END, false)"


_ATTRIBUTE = lambda c: f"CASE WHEN kind = 'phrase_stoplist' THEN NULL ELSE {c} END AS {c}"

ORACLES: dict[str, str] = {
    "export_documents": f"""WITH {_PARSED} SELECT file_no, CAST(msg_idx AS INTEGER) AS msg_idx, {_scalar("p", "id", "msgId", "msg_id")} AS msg_id,
        {_scalar("p", "seq", "sequence", "seqId")} AS seq, CASE WHEN json_type(s) = 'OBJECT' THEN {_scalar("s", "uid")} ELSE '' END AS uid,
        {_flag("system")} AS is_system, {_flag("recalled")} AS is_recalled FROM o""",
    "written_buckets": core_oracles.ORACLES["classify_documents"],
    "written_scores": core_oracles.ORACLES["score_documents"],
    "lexicon_files": f"""SELECT kind, phrase, {_ATTRIBUTE("label")}, {_ATTRIBUTE("severity")}, {_ATTRIBUTE("risk")}, {_ATTRIBUTE("status")} FROM lexicon WHERE trim(phrase) <> ''""",
    "archive_files": """SELECT phrase, CASE kind WHEN 'phrase_bank' THEN 'style_markers.' || coalesce(label, 'unknown') WHEN 'chaos_lexicon' THEN 'chaos.' || coalesce(severity, 'unknown')
        WHEN 'privacy_lexicon' THEN 'privacy.' || coalesce(risk, 'unknown') WHEN 'drop_sentence_words' THEN 'filter.drop_sentence' WHEN 'mask_words' THEN 'filter.mask'
        WHEN 'phrase_candidates' THEN 'phrase_mining.candidates' WHEN 'phrase_stoplist' THEN 'phrase_mining.stoplist' WHEN 'manual_keep' THEN 'manual.keep' ELSE 'manual.drop' END AS old_category,
        kind || CASE WHEN kind = 'phrase_stoplist' THEN '.txt' ELSE '.jsonl' END AS source_file, false AS participates_in_matching FROM lexicon WHERE trim(phrase) <> ''""",
}
