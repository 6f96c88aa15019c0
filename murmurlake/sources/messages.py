"""Messages in one shape, from stored tables or from export files whose layout varies.

The shape: source_file, msg_idx, msg_id, seq, timestamp_ms, uid, uin, name, nickname,
text, msg_type, is_system, is_recalled. Missing texts are "", missing times 0, as the block
pipeline expects; nothing is dropped here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmurlake.functions.jsons import document
from murmurlake.functions.text import strip
from murmurlake.functions.time import text_millis, usable_millis
from murmurlake.operators.ranking import bucketed_prefix

# Field names that carry one meaning in different export versions, first present wins.
TEXT_FIELDS = ("text", "content", "message", "msg", "raw_message", "msgContent", "message_content", "plain", "plain_text")
NAME_FIELDS = ("name", "senderName", "sender_name", "nickname", "nick", "from", "fromName")
ID_FIELDS = ("uin", "senderUin", "sender_id", "user_id", "uid", "qq", "account", "fromUin")
TIME_FIELDS = ("timestamp", "msgTime", "send_time", "datetime", "time", "date")
SEQ_FIELDS = ("seq", "sequence", "seqId")

# Message types by their code.
TYPES = {
    "type_1": "text",
    "type_2": "image",
    "type_3": "image",
    "type_4": "file",
    "type_5": "audio",
    "type_6": "video",
    "type_7": "location",
    "type_8": "file",
    "type_9": "forward",
    "type_10": "system",
    "type_11": "reply",
    "type_17": "other",
}


def message_type(raw: Column, is_system: Column) -> Column:
    """The category of a type code; the system flag wins, unknown and null codes are other."""
    table = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])
    return F.when(is_system, F.lit("system")).otherwise(F.coalesce(F.try_element_at(table, F.coalesce(raw, F.lit("type_1"))), F.lit("other")))


def first_present(*columns: Column) -> Column:
    """The first value that is neither null nor empty, else empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def _elements_text(elements: Column) -> Column:
    texts = F.filter(F.transform(elements, lambda e: e["data"]["text"]), lambda t: F.coalesce(t, F.lit("")) != "")
    return F.array_join(F.coalesce(texts, F.expr("cast(array() as array<string>)")), "\n")


def from_table(messages: DataFrame) -> DataFrame:
    """The stored ``messages`` table in the common shape; keeps row_id."""
    content_text = first_present(F.col("content.text"), _elements_text(F.col("content.elements")), _elements_text(F.col("elements")))
    is_system = F.coalesce("is_system", F.lit(False))
    return messages.select(
        "row_id",
        F.coalesce("source_file", F.lit("")).alias("source_file"),
        F.coalesce("msg_idx", F.lit(0)).alias("msg_idx"),
        F.coalesce("msg_id", F.lit("")).alias("msg_id"),
        F.coalesce("seq", F.lit("")).alias("seq"),
        F.coalesce(usable_millis("timestamp_ms", "time_text"), F.lit(0)).cast("long").alias("timestamp_ms"),
        first_present(F.col("uid"), F.col("sender.uid")).alias("uid"),
        first_present(F.col("sender.uin")).alias("uin"),
        first_present(F.col("sender.name"), F.col("sender.nickname")).alias("name"),
        first_present(F.col("sender.nickname")).alias("nickname"),
        first_present(F.col("text"), content_text).alias("text"),
        message_type(F.col("raw_type"), is_system).alias("msg_type"),
        is_system.alias("is_system"),
        F.coalesce("recalled", F.lit(False)).alias("is_recalled"),
    )


def owned_by_file(messages: DataFrame, files: DataFrame) -> DataFrame:
    """Adds is_me: the sender's uid is the self_uid of the message's file."""
    owners = files.groupBy(F.col("source_file").alias("__file")).agg(F.max("self_uid").alias("__me"))
    joined = messages.join(owners, F.col("source_file") == F.col("__file"), "left")
    return joined.withColumn("is_me", F.coalesce((F.col("uid") == F.col("__me")) & (F.col("uid") != ""), F.lit(False))).drop("__file", "__me")


def owned_by_identity(messages: DataFrame, ids: tuple[str, ...], names: tuple[str, ...] = (), everyone: bool = False) -> DataFrame:
    """Adds is_me: uid or uin is one of the ids, or a name equals one of the names, whatever its case.

    With ``everyone`` all speakers count. Long id lists become a broadcast join below
    Spark's own size limit, and a shuffled one beyond it.
    """
    if everyone:
        return messages.withColumn("is_me", F.lit(True))
    low = [n.lower() for n in names]
    by_name = F.lower("name").isin(*low) | F.lower("nickname").isin(*low) if low else F.lit(False)
    if len(ids) <= 200:
        by_id = F.col("uid").isin(*ids) | F.col("uin").isin(*ids) if ids else F.lit(False)
        return messages.withColumn("is_me", F.coalesce(by_id, F.lit(False)) | F.coalesce(by_name, F.lit(False)))
    listed = messages.sparkSession.createDataFrame([(i,) for i in set(ids)], "id string")
    flagged = messages
    for c in ("uid", "uin"):
        flagged = flagged.join(listed.select(F.col("id").alias(f"__{c}"), F.lit(True).alias(f"__is_{c}")), F.col(c) == F.col(f"__{c}"), "left")
    is_me = F.coalesce("__is_uid", F.lit(False)) | F.coalesce("__is_uin", F.lit(False)) | F.coalesce(by_name, F.lit(False))
    return flagged.withColumn("is_me", is_me).drop("__uid", "__uin", "__is_uid", "__is_uin")


def scan_folder(spark: SparkSession, folder: str, limit_files: int | None = None) -> DataFrame:
    """(source_file, file_ord, doc): export files below ``folder`` – .json by path, then .jsonl by path."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{json,jsonl}")
    whole = reader.text(folder, wholetext=True)
    files = whole.select(F.col("_metadata.file_path").alias("source_file"), F.regexp_replace("value", "^\ufeff", "").alias("doc"))
    if limit_files and limit_files > 0:
        order = F.struct(F.col("source_file").endswith(".jsonl").alias("j"), "source_file")
        files = files.orderBy(order).limit(limit_files)
    return files


def file_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(source_file, line_no, line) of the .jsonl files below ``folder``; lines count from 0 over all splits of a file."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl")
    lines = reader.text(folder).select(
        F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", "^\ufeff", "").alias("line")
    )
    return bucketed_prefix(lines, ["source_file"], F.col("split"), ["id"], rank="line_no").select("source_file", "line_no", "line")


def in_file_order(rows: DataFrame) -> list[Column]:
    """The order in which files are read: .json by path, then .jsonl by path, and their messages in place."""
    return [F.col("source_file").endswith(".jsonl"), F.col("source_file"), F.col("msg_idx")]


def _field(v: Column, *names: str) -> Column:
    """First of the top-level values that is there: text of scalars, "" of objects and arrays."""
    return first_present(*[F.when(~F.coalesce(F.schema_of_variant(F.try_variant_get(v, f"$.{n}", "variant")), F.lit("VOID")).rlike("^(OBJECT|ARRAY|VOID)"), F.try_variant_get(v, f"$.{n}", "string")) for n in names])


def _object(v: Column, *names: str) -> Column:
    return F.coalesce(*[F.try_variant_get(v, f"$.{n}", "variant") for n in names])


def read_exports(spark: SparkSession, folder: str, limit_files: int | None = None, json_lines: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(messages, file infos, warnings) of the export files below ``folder``.

    A file is one JSON document with its messages under ``messages``, ``data`` or ``list``.
    Files that don't parse, top-level arrays and message fields that are no array
    give a warning and no messages; array entries that are no objects are skipped.
    With ``json_lines`` each line of a .jsonl file is a message; such files are read line
    by line and may be split.
    """
    files = scan_folder(spark, folder, limit_files)
    every = files
    if json_lines:
        files = files.where(~F.col("source_file").endswith(".jsonl"))
    docs = files.withColumn("v", document("doc"))
    kind = F.schema_of_variant("v")
    is_object = F.coalesce(kind.startswith("OBJECT"), F.lit(False))
    listed = F.coalesce(*[F.try_variant_get("v", f"$.{n}", "variant") for n in ("messages", "data", "list")])
    docs = docs.withColumn("ok", is_object).withColumn("list", F.when(is_object, listed))
    is_list = F.coalesce(F.schema_of_variant("list").startswith("ARRAY"), F.lit(False))
    docs = docs.withColumn("is_list", is_list)
    infos = docs.where("ok").select(
        "source_file",
        *[first_present(F.try_variant_get("v", f"$.chatInfo.{n}", "string")).alias(c) for n, c in (("selfUid", "self_uid"), ("selfUin", "self_uin"), ("selfName", "self_name"), ("name", "chat_name"))],
        F.coalesce(F.try_variant_get("v", "$.chatInfo.type", "string"), F.lit("private")).alias("chat_type"),
        F.coalesce(F.when(F.col("is_list"), F.size(F.try_variant_get("list", "$", "array<variant>"))), F.lit(0)).alias("message_count"),
    )
    bad = F.when(~F.col("ok") & F.col("v").isNotNull(), F.lit("the document is no object")).when(~F.col("ok"), F.lit("cannot be parsed")).when(
        F.col("list").isNotNull() & ~F.col("is_list"), F.lit("messages is not a list")
    )
    warnings = docs.select("source_file", bad.alias("warning")).where("warning is not null")
    entries = docs.where("is_list").select("source_file", F.posexplode(F.try_variant_get("list", "$", "array<variant>")).alias("msg_idx", "m"))
    if json_lines:
        lines = file_lines(spark, folder)
        if limit_files and limit_files > 0:
            lines = lines.join(every.select("source_file"), "source_file", "left_semi")
        entries = entries.union(lines.select("source_file", F.col("line_no").cast("int").alias("msg_idx"), document("line").alias("m")))
    entries = entries.where(F.coalesce(F.schema_of_variant("m").startswith("OBJECT"), F.lit(False)))
    m = F.col("m")
    sender, content = _object(m, "sender", "fromUser", "from"), _object(m, "content", "message", "msgContent")
    e = entries.withColumn("s", sender).withColumn("c", content)
    s, c = F.col("s"), F.col("c")
    sender_text = F.when(F.schema_of_variant("s") == "STRING", F.try_variant_get("s", "$", "string"))
    content_text = F.when(F.schema_of_variant("c") == "STRING", F.try_variant_get("c", "$", "string"))
    parts = F.filter(
        F.transform(F.try_variant_get("c", "$.elements", "array<variant>"), lambda x: F.try_variant_get(x, "$.data.text", "string")),
        lambda t: F.coalesce(t, F.lit("")) != "",
    )
    text = first_present(content_text, _field(c, *TEXT_FIELDS), F.array_join(F.coalesce(parts, F.expr("cast(array() as array<string>)")), "\n"), _field(m, "text", "message", "msg", "content"))
    clock = first_present(*[F.nullif(F.nullif(_field(m, n), F.lit("0")), F.lit("false")) for n in ("timestamp", "time", "msgTime")])
    number = F.when(clock.rlike(r"^\d+(\.\d+)?$"), clock.cast("double").cast("long"))
    # Seconds become milliseconds, whatever their year.
    millis = F.coalesce(F.when(number < F.lit(10**12), number * 1000).otherwise(number), text_millis(clock), F.lit(0))
    flag = lambda n: F.coalesce(F.try_variant_get("m", f"$.{n}", "boolean"), F.try_variant_get("m", f"$.{n}", "double") != 0, F.lit(False))
    is_system = flag("system")
    rows = e.select(
        "source_file",
        F.col("msg_idx").cast("int").alias("msg_idx"),
        _field(m, "id", "msgId", "msg_id").alias("msg_id"),
        _field(m, *SEQ_FIELDS).alias("seq"),
        millis.cast("long").alias("timestamp_ms"),
        _field(s, "uid").alias("uid"),
        _field(s, *ID_FIELDS).alias("uin"),
        first_present(sender_text, _field(s, *NAME_FIELDS)).alias("name"),
        _field(s, "nickname").alias("nickname"),
        text.alias("text"),
        message_type(first_present(_field(m, "type"), F.lit("type_1")), is_system).alias("msg_type"),
        is_system.alias("is_system"),
        flag("recalled").alias("is_recalled"),
    )
    return rows, infos, warnings


def stripped(messages: DataFrame) -> DataFrame:
    return messages.withColumn("text", F.coalesce(strip(F.col("text")), F.lit("")))
