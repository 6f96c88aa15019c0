"""Schemas that drift between files: correspondences by similarity flooding, a report, one table.

Each file's schema is a small graph: fields with their parent (nesting), JSON type, name
and value format. Two successive graphs of a chat are joined into a pair graph whose nodes
are pairs of fields, of names, of types and of formats. Only pairs of names, types and
formats start with a score; it flows along the edges until all scores have converged, and
consistent one-to-one correspondences are taken from the scores of the field pairs.
Profiles are counted by Spark without leaving the JVM (``variant``); only pairs of small
graphs reach Python, one row per file. ``unify`` casts and unions by the correspondences.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmurlake.functions.jsons import document
from murmurlake.functions.time import usable_millis
from murmurlake.operators.ranking import HOT_PARTS, bucketed_prefix
from murmurlake.session import cut
from murmurlake.sources.messages import ID_FIELDS, NAME_FIELDS, SEQ_FIELDS, TEXT_FIELDS, TIME_FIELDS

_CONTENT = ("content", "message", "msgContent")
_SENDER = ("sender", "fromUser", "from")
# Names of one meaning that the reader of exports accepts: what pairs of names start with.
ALIASES: dict[str, tuple[str, ...]] = {
    "id": ("id", "msgId", "msg_id"),
    "seq": SEQ_FIELDS,
    "time": TIME_FIELDS,
    "sender": _SENDER,
    "content": _CONTENT,
    "system": ("system", "isSystem"),
    "recalled": ("recalled", "isRecalled"),
    "type": ("type",),
    "sender.uid": ("uid",),
    "sender.uin": tuple(n for n in ID_FIELDS if n != "uid"),
    "sender.name": tuple(n for n in NAME_FIELDS if n not in ("nickname", "from")),
    "sender.nickname": ("nickname",),
    "content.text": tuple(n for n in TEXT_FIELDS if n not in _CONTENT),
    "content.html": ("html",),
}
PARENTS = ("sender", "content")
SHARE = 0.25
#: Converged score from which two fields correspond, and its least lead over rivals where names don't speak.
ACCEPT, LEAD = 0.44, 0.02

_GROUP = {("" if "." not in g else g.split(".")[0], n): g for g, names in ALIASES.items() for n in names}


def _sql_in(names: tuple[str, ...]) -> str:
    return ", ".join(f"'{n}'" for n in names)


def parsed(records: DataFrame, payload: str = "payload") -> DataFrame:
    """The records whose payload is a JSON object, with it as ``v``; others have no schema."""
    v = records.withColumn("v", document(payload))
    return v.where(F.col("v").isNotNull() & F.schema_of_variant("v").startswith("OBJECT"))


def profiles(records: DataFrame, file: str = "file_no", chat: str = "chat_id", payload: str = "payload") -> DataFrame:
    """(chat, file, records, fields): the held fields of each file, counted over all its records.

    A field is a top-level key or a key of the sender or content object. fields is an
    array of (level, parent, key, type, n, length, digits, dates, words), where level is
    "", "sender" or "content" and parent the parent's own name. Null values, empty files
    and payloads that don't parse don't count.
    """
    base = parsed(records, payload).select(F.col(chat).alias("chat"), F.col(file).alias("file"), "v")
    spark = records.sparkSession
    view = f"murmurlake_drift_{id(base)}"
    base.createOrReplaceTempView(view)
    # The first character of a value's JSON tells its type, at less cost than its whole schema.
    types = "map('{', 'object', '[', 'array', '\"', 'string', 't', 'boolean', 'f', 'boolean', 'n', 'null')"
    kind = lambda v: f"CASE WHEN {v} IS NOT NULL THEN coalesce(try_element_at({types}, left(to_json({v}), 1)), 'number') END"
    level = "CASE " + " ".join(f"WHEN key IN ({_sql_in(ALIASES[p])}) THEN '{p}'" for p in PARENTS) + " END"
    # Payloads are parsed once: a record comes with each of its keys and counts with the first, and
    # so does a parent object with its own.
    exploded = spark.sql(
        f"""
        WITH top AS (
          SELECT chat, file, coalesce(t.pos, 0) AS place, t.key, t.value, {kind('t.value')} AS kind FROM {view}, LATERAL variant_explode_outer(v) AS t),
        below AS (
          SELECT chat, file, place, top.key, top.value, kind, c.pos, c.key AS ckey, c.value AS cvalue, {kind('c.value')} AS ckind
          FROM top, LATERAL variant_explode_outer(CASE WHEN kind = 'object' AND top.key IN ({_sql_in(ALIASES['sender'] + ALIASES['content'])}) THEN top.value END) AS c),
        both AS (
          SELECT chat, file, explode(array_compact(array(
            CASE WHEN place = 0 AND coalesce(pos, 0) = 0 THEN struct('#' AS level, '' AS parent, '' AS key, '' AS type, CAST(NULL AS VARIANT) AS value) END,
            CASE WHEN kind <> 'null' AND coalesce(pos, 0) = 0 THEN struct('' AS level, '' AS parent, key AS key, kind AS type, value AS value) END,
            CASE WHEN ckind <> 'null' THEN struct({level} AS level, key AS parent, ckey AS key, ckind AS type, cvalue AS value) END))) AS f FROM below)
        SELECT chat, file, f.level, f.parent, f.key, f.type, f.value FROM both
        """
    )
    spark.catalog.dropTempView(view)
    text = F.when(F.col("type").isin("object", "array"), F.lit(None)).otherwise(F.try_variant_get("value", "$", "string"))
    counted = (
        exploded.withColumn("s", text)
        .groupBy("chat", "file", "level", "parent", "key", "type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.length("s")).alias("length"),
            F.count_if(F.col("s").rlike(r"^\s*[0-9]+$")).alias("digits"),
            F.count_if(F.col("s").rlike(r"^\d{4}[-/]\d")).alias("dates"),
            F.count_if(F.col("s").rlike(r"[^\x00-\x7f]")).alias("words"),
        )
    )
    counted = cut(counted, "fields")
    sizes = counted.where("level = '#'").select("chat", "file", F.col("n").alias("records"))
    counted = counted.where("level <> '#'")
    # Only what a quarter of a file's records carry, under any type or name of one meaning, can make a field.
    # So few keys are left of a file, however many its payloads have.
    meaning = F.create_map(*[F.lit(x) for (level_, n), g in _GROUP.items() for x in (f"{level_}.{n}", g)])
    same = Window.partitionBy("chat", "file", "level", "meaning")
    carried = counted.withColumn("meaning", F.coalesce(meaning[F.concat_ws(".", "level", "key")], F.concat(F.lit("="), "key"))).withColumn("carried", F.sum("n").over(same))
    fields = (
        carried.join(sizes, ["chat", "file"])
        .where(F.col("carried") >= F.lit(SHARE) * F.col("records"))
        .groupBy("chat", "file")
        .agg(F.collect_list(F.struct("level", "parent", "key", "type", "n", "length", "digits", "dates", "words")).alias("fields"))
    )
    return sizes.join(fields, ["chat", "file"], "left")


def held_fields(records: int, rows: list) -> dict[tuple[str, str], dict]:
    """(level, key) → {type, parent, format} of the fields that a file holds.

    Types of one key are added up, and so are keys of one meaning that records carry in
    place of each other; name and type are those of most.
    """
    per_key: dict[tuple[str, str], list] = {}
    parents: dict[str, dict[tuple[str, str], int]] = {p: {} for p in PARENTS}
    for r in rows:
        per_key.setdefault((r["level"], r["key"]), []).append(r)
    merged: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for level, key in per_key:
        merged.setdefault((level, _GROUP.get((level, key), f"={key}")), []).append((level, key))
    for r in rows:
        if not r["level"]:
            for p in PARENTS:
                if r["key"] in ALIASES[p]:
                    parents[p][(r["key"], r["type"])] = parents[p].get((r["key"], r["type"]), 0) + r["n"]
    out: dict[tuple[str, str], dict] = {}
    for names in merged.values():
        count = {k: sum(r["n"] for r in per_key[k]) for k in names}
        groups = [names] if sum(count.values()) <= records else [[k] for k in names]
        for group in groups:
            total = sum(count[k] for k in group)
            if not total or total < SHARE * records:
                continue
            name = max(group, key=lambda k: (count[k], k))
            kinds: dict[str, int] = {}
            for k in group:
                for r in per_key[k]:
                    kinds[r["type"]] = kinds.get(r["type"], 0) + r["n"]
            own = per_key[name]
            n = sum(r["n"] for r in own)
            where: dict[str, int] = {}
            for r in own:
                where[r["parent"]] = where.get(r["parent"], 0) + r["n"]
            out[name] = {
                "type": max(kinds, key=lambda t: (kinds[t], t)),
                "parent": max(where, key=lambda p: (where[p], p)),
                "format": tuple(round(sum(r[f] or 0 for r in own) / n, 2) for f in ("digits", "dates", "words"))
                + (round(float(np.log1p(sum(r["length"] or 0 for r in own) / n)), 1),),
            }
    return out


def _tokens(name: str) -> frozenset[str]:
    parts = re.findall(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+", name)
    return frozenset(p.lower() for p in parts) - {"is", "has"}


@lru_cache(maxsize=100_000)
def _name_similarity(level: str, a: str, b: str) -> float:
    if a == b:
        return 1.0
    ga, gb = _GROUP.get((level, a)), _GROUP.get((level, b))
    if ga and gb:
        return 0.95 if ga == gb else 0.0
    ta, tb = _tokens(a), _tokens(b)
    tokens = len(ta & tb) / len(ta | tb) if ta | tb else 0.0
    ba, bb = ({x[i : i + 2] for i in range(len(x) - 1)} for x in (a.lower(), b.lower()))
    grams = len(ba & bb) / len(ba | bb) if ba | bb else 0.0
    return max(tokens, grams**2)  # a few common letter pairs are chance


_TYPE_START = {frozenset(("string", "number")): 0.5, frozenset(("boolean", "number")): 0.5}


def _format_start(a: dict, b: dict) -> float:
    """How alike the values of two fields are. Flags and containers all look alike, so they say little."""
    if a["type"] not in ("string", "number") or b["type"] not in ("string", "number"):
        return 0.3 if a["type"] == b["type"] else 0.1
    gap = np.abs(np.subtract(a["format"], b["format"]))
    return float(max(0.0, 1 - 4 * gap[:3].max()) * max(0.0, 1 - gap[3] / 0.3))


# What a pair of fields takes from its names, types, formats and its place.
_TAKES = (0.5, 0.1, 0.2, 0.2)


def flood_scores(before: dict[tuple[str, str], dict], after: dict[tuple[str, str], dict], rounds: int = 200) -> dict[tuple[tuple[str, str], tuple[str, str]], tuple[float, float]]:
    """(score, name's start) of each pair of fields of one level, at convergence.

    Field pairs start at 0 and get everything through their edges: from the pair of their
    names, their types, their formats, and from the pair of their parents; the latter get
    back the mean over their fields of the best pair's score, as do the two roots. Pairs
    of types and formats are shared by field pairs and get back their mean. All shares
    are below 1, so scores converge whatever the graph. A key that both have is paired
    with itself alone, and the others with each other, so edges are as few as the changes.
    """
    both = before.keys() & after.keys()
    pairs = [(k, k) for k in sorted(both)] + [(a, b) for a in sorted(before) if a not in both for b in sorted(after) if b not in both and a[0] == b[0]]
    if not pairs or not rounds:
        return {}
    n = len(pairs)
    name0 = np.array([_name_similarity(a[0], a[1], b[1]) for a, b in pairs])
    kinds: dict[tuple, int] = {}
    looks: dict[tuple, int] = {}
    kind0: list[float] = []
    look0: list[float] = []
    kind_of, look_of = np.zeros(n, int), np.zeros(n, int)
    for i, (a, b) in enumerate(pairs):
        fa, fb = before[a], after[b]
        k = (fa["type"], fb["type"])
        if k not in kinds:
            kinds[k] = len(kinds)
            kind0.append(1.0 if k[0] == k[1] else _TYPE_START.get(frozenset(k), 0.0))
        kind_of[i] = kinds[k]
        f = (k, fa["format"], fb["format"])
        if f not in looks:
            looks[f] = len(looks)
            look0.append(_format_start(fa, fb))
        look_of[i] = looks[f]
    at = {p: i for i, p in enumerate(pairs)}
    # Nesting: each pair below the pair of its parents, or of the roots (index n).
    above = np.array([at.get((("", before[a]["parent"]), ("", after[b]["parent"])), n) if a[0] else n for a, b in pairs])
    left = np.unique([f"{a}" for a, _ in pairs], return_inverse=True)[1]  # the field of ``before`` in each pair
    groups, group_of = np.unique(np.column_stack([above, left]), axis=0, return_inverse=True)
    group_of = group_of.ravel()
    fields_above = np.maximum(np.bincount(groups[:, 0], minlength=n + 1), 1)
    parents = np.unique(above[above < n])

    def mean(of: np.ndarray, score: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(of, score, size) / np.maximum(np.bincount(of, minlength=size), 1)

    kind_start, look_start = np.array(kind0), np.array(look0)
    field = np.zeros(n)
    for _ in range(rounds):
        name = 0.9 * name0 + 0.1 * field
        kind = 0.9 * kind_start + 0.1 * mean(kind_of, field, len(kind0))
        look = 0.8 * look_start + 0.2 * mean(look_of, field, len(look0))
        best = np.zeros(len(groups))
        np.maximum.at(best, group_of, field)
        place = np.bincount(groups[:, 0], best, n + 1) / fields_above
        nest = place[n] * np.ones(n)
        nest[parents] = (place[n] + place[parents]) / 2
        inner = above < n
        nest[inner] = field[above[inner]]
        new = _TAKES[0] * name + _TAKES[1] * kind[kind_of] + _TAKES[2] * look[look_of] + _TAKES[3] * nest
        moved = np.abs(new - field).max()
        field = new
        if moved < 1e-6:
            break
    return {p: (float(field[i]), float(name0[i])) for p, i in at.items()}


def flood(before: dict[tuple[str, str], dict], after: dict[tuple[str, str], dict], rounds: int = 200) -> dict[tuple[str, str], tuple[str, str]]:
    """Correspondences between two schemas: fields of ``before`` → fields of ``after``.

    Best converged scores first, each field once. Where names don't speak for a pair, types
    and formats may, but then it has to be ahead of every other pair of its two fields.
    """
    scores = flood_scores(before, after, rounds)
    by_field: dict[tuple, list[float]] = {}
    for (a, b), (score, _) in scores.items():
        by_field.setdefault(("a", a), []).append(score)
        by_field.setdefault(("b", b), []).append(score)
    taken_a: set = set()
    taken_b: set = set()
    found: dict[tuple[str, str], tuple[str, str]] = {}
    for (a, b), (score, name) in sorted(scores.items(), key=lambda x: (-round(x[1][0], 6), x[0])):
        if score < ACCEPT or a in taken_a or b in taken_b:
            continue
        rivals = sum(s > score - LEAD for s in by_field[("a", a)]) + sum(s > score - LEAD for s in by_field[("b", b)])
        if name < 0.3 and rivals > 2:
            continue
        found[a] = b
        taken_a.add(a)
        taken_b.add(b)
    return found


def compare(before: dict[tuple[str, str], dict], after: dict[tuple[str, str], dict], rounds: int = 200) -> list[tuple[str, str, str, str, str, str]]:
    """(field_path, drift, was, level, key, was_key) of one file against the one before; was: the path before, or ""."""

    def parents(fields: dict) -> dict[str, tuple[str, str]]:
        found = {}
        for p in PARENTS:
            tops = [k for k in fields if not k[0] and k[1] in ALIASES[p]]
            if len(tops) == 1:
                found[p] = (tops[0][1], fields[tops[0]]["type"])
        return found

    pb, pa = parents(before), parents(after)
    both = {p for p in PARENTS if pb.get(p, ("", ""))[1] == "object" and pa.get(p, ("", ""))[1] == "object"}
    b = {k: v for k, v in before.items() if not k[0] or k[0] in both}
    a = {k: v for k, v in after.items() if not k[0] or k[0] in both}
    path = lambda k, names: k[1] if not k[0] else f"{names[k[0]][0]}.{k[1]}"
    if {k: v["type"] for k, v in b.items()} == {k: v["type"] for k, v in a.items()}:
        return []
    match = flood(b, a, rounds)
    rows = [(path(k, pb), "removed", "", *k, "") for k in b if k not in match]
    rows += [(path(k, pa), "added", "", *k, "") for k in a if k not in set(match.values())]
    for x, y in match.items():
        if x[1] != y[1]:
            rows.append((path(y, pa), "renamed", path(x, pb), *y, x[1]))
        if b[x]["type"] != a[y]["type"]:
            rows.append((path(y, pa), "retyped", path(x, pb), *y, x[1]))
    return sorted(rows)


def _changes(records: DataFrame, file: str, chat: str, payload: str, files_in_bucket: int, rounds: int = 200) -> DataFrame:
    files = cut(profiles(records.where(F.col(chat).isNotNull() & F.col(file).isNotNull()), file, chat, payload), "profiles")
    ranked = bucketed_prefix(files, ["chat"], F.floor(F.col("file") / F.lit(files_in_bucket)).cast("long"), ["file"])
    earlier = ranked.select("chat", (F.col("rank") + 1).alias("rank"), F.col("records").alias("records_b"), F.col("fields").alias("fields_b"))
    pairs = ranked.join(earlier, ["chat", "rank"]).select("chat", "file", "records", "fields", "records_b", "fields_b")
    kind = {f.name: f.dataType.simpleString() for f in files.schema.fields}
    columns = ["field_path", "drift", "was", "level", "key", "was_key"]

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for c, f, n, fields, nb, fields_b in pdf.itertuples(index=False):
                now = held_fields(n, [] if fields is None else list(fields))
                was = held_fields(nb, [] if fields_b is None else list(fields_b))
                out += [(c, f, *row) for row in compare(was, now, rounds)]
            yield pd.DataFrame(out, columns=["chat", "file", *columns])

    return pairs.mapInPandas(work, f"chat {kind['chat']}, file {kind['file']}, " + ", ".join(f"{c} string" for c in columns))


def drift_report(
    records: DataFrame, file: str = "file_no", chat: str = "chat_id", payload: str = "payload", files_in_bucket: int = 4096, rounds: int = 200
) -> DataFrame:
    """(chat, file, field_path, drift, was): each change of a file against the file before of its chat.

    Drifts: added, removed, renamed, retyped. A chat's first file has no rows, nor has a
    file without a payload that parses, which isn't compared either. Null chats are left out.
    Without rounds of flooding no score reaches a pair of fields, so nothing corresponds.
    """
    found = _changes(records, file, chat, payload, files_in_bucket, rounds)
    return found.select(F.col("chat").alias(chat), F.col("file").alias(file), "field_path", "drift", "was")


NAMES_IN_ROW = 10_000


def corresponding_names(records: DataFrame, file: str = "file_no", chat: str = "chat_id", payload: str = "payload", files_in_bucket: int = 4096) -> DataFrame:
    """(level, key, name): the names that flooding has found to stand for another, and for which.

    Renames of all files are summed up by name. Names that the reader knows stand for
    themselves. Any other takes the partner it was matched with in most files – one that
    the reader knows before one that it doesn't, of the latter only a more frequent one –
    and, through it, what that stands for. So there is one row a name, and chains of
    renames end at one name.
    """
    found = _changes(records, file, chat, payload, files_in_bucket).where("drift = 'renamed'")
    both = found.select("level", F.explode(F.array(F.struct(F.col("key").alias("key"), F.col("was_key").alias("other")), F.struct(F.col("was_key").alias("key"), F.col("key").alias("other")))).alias("e"))
    edges = cut(both.groupBy("level", "e.key", "e.other").agg(F.count(F.lit(1)).alias("n")), "renames")
    known = F.create_map(*[F.lit(x) for (level, n), g in _GROUP.items() for x in (f"{level}.{n}", ALIASES[g][0])])
    of = lambda c: known[F.concat_ws(".", "level", c)]
    size = edges.groupBy("level", "key").agg(F.sum("n").alias("size"))
    rank = lambda s, k: F.struct(F.col(s), F.col(k))
    unknown = edges.where(of("key").isNull()).join(size, ["level", "key"]).join(size.withColumnsRenamed({"key": "other", "size": "other_size"}), ["level", "other"])
    choice = F.max(F.struct(of("other").isNotNull().alias("known"), "n", F.col("other"))).alias("c")
    first = (
        unknown.where(of("other").isNotNull() | (rank("other_size", "other") > rank("size", "key")))
        .groupBy("level", "key")
        .agg(choice)
        .select("level", "key", F.coalesce(of("c.other"), F.col("c.other")).alias("name"))
    )
    names = cut(first, "names")
    while True:  # each round doubles the links that a name has followed
        step = names.select("level", F.col("key").alias("name"), F.col("name").alias("further"))
        jumped = names.join(step, ["level", "name"], "left").select("level", "key", F.coalesce("further", "name").alias("name"), F.col("further").isNotNull().alias("moved"))
        if jumped.where("moved").isEmpty():
            return names
        names = cut(jumped.drop("moved"), "names")


def _renamed(v: Column, names: Column, level: str) -> Column:
    """The variant object with its keys renamed by the map; as it is where two keys would get one name."""
    parts = F.try_variant_get(v, "$", "map<string,variant>")
    keys = F.map_keys(parts)
    named = F.transform(keys, lambda k: F.coalesce(names[F.concat(F.lit(f"{level}."), k)], k))
    renamed = F.map_from_arrays(named, F.map_values(parts))
    fits = (F.size(F.array_distinct(named)) == F.size(keys)) & (named != keys)
    return F.when(fits, F.parse_json(F.to_json(F.when(fits, renamed)))).otherwise(v)


def _renamed_below(v: Column, parent: str, names: Column, level: str) -> Column:
    """The same for the keys of one of the variant's objects."""
    own = F.try_variant_get(v, f"$.{parent}", "variant")
    inner = _renamed(own, names, level)
    changed = F.schema_of_variant(own).startswith("OBJECT") & (F.to_json(own) != F.to_json(inner))
    parts = F.try_variant_get(v, "$", "map<string,variant>")
    put = F.map_from_arrays(F.map_keys(parts), F.transform(F.map_keys(parts), lambda k: F.when(k == parent, inner).otherwise(parts[k])))
    return F.when(changed, F.parse_json(F.to_json(F.when(changed, put)))).otherwise(v)


def _own_names(v: Column) -> Column:
    """The level.key that the variant's names are looked up by, sorted: its keys, and its objects' under each parent they may stand for."""
    parts = F.try_variant_get(v, "$", "map<string,variant>")
    top = F.transform(F.map_keys(parts), lambda k: F.concat(F.lit("."), k))
    below = F.flatten(F.filter(F.transform(F.map_values(parts), lambda x: F.map_keys(F.try_variant_get(x, "$", "map<string,variant>"))), lambda k: k.isNotNull()))
    under = lambda p: F.transform(below, lambda k: F.concat(F.lit(f"{p}."), k))
    every = F.concat(top, *map(under, PARENTS))
    return F.coalesce(F.array_sort(F.array_distinct(every)), F.array().cast("array<string>"))


def _looked_up(many: DataFrame, few: DataFrame, on: str, size: str) -> DataFrame:
    """``many`` joined to ``few``, which has every key of it once and by ``size`` how often; rows of frequent keys aren't shuffled."""
    total = few.agg(F.sum(size)).first()[0] or 0
    hot = F.col(size) * HOT_PARTS >= F.lit(max(total, 1))
    frequent = many.join(F.broadcast(few.where(hot).drop(size)), on)
    rest = many.join(F.broadcast(few.where(hot).select(on)), on, "left_anti")
    return frequent.unionByName(rest.join(few.where(~hot).drop(size), on))


def _with_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Adds ``__names``, map of level.key → name: one row for all records, or, where there are too many names, those of a record's own keys.

    Renaming looks up nothing but a record's own keys, so both give the same results. The
    latter are looked up once for all records of the same keys.
    """
    entry = F.struct(F.col("__key").alias("key"), F.col("name").alias("value"))
    keyed = names.select(F.concat_ws(".", "level", "key").alias("__key"), "name")
    if names.count() <= NAMES_IN_ROW:
        return rows.crossJoin(F.broadcast(keyed.agg(F.map_from_entries(F.collect_list(entry)).alias("__names"))))
    rows = rows.withColumn("__own", _own_names(F.col("__v")))
    layouts = cut(rows.groupBy("__own").agg(F.count(F.lit(1)).alias("__size")), "layouts")
    held = layouts.select("__own", F.explode("__own").alias("__key"))
    uses = cut(held.groupBy("__key").agg(F.count(F.lit(1)).alias("__uses")).join(keyed, "__key", "left"), "uses")
    named = _looked_up(held, uses, "__key", "__uses").where(F.col("name").isNotNull())
    maps = named.groupBy("__own").agg(F.map_from_entries(F.collect_list(entry)).alias("__names"))
    empty = F.create_map().cast("map<string,string>")
    maps = cut(layouts.join(maps, "__own", "left").withColumn("__names", F.coalesce("__names", empty)), "layout_names")
    return _looked_up(rows, maps, "__own", "__size").drop("__own")


def unify(records: DataFrame, keep: list[str], payload: str = "payload", names: DataFrame | None = None, file: str = "file_no", chat: str = "chat_id") -> DataFrame:
    """All payloads in one table: ``keep``, the known fields under one name and type, the rest in ``extras``.

    ``names`` are the correspondences of ``corresponding_names``: keys, those of the sender
    and content objects included, are read under the name that they stand for.
    Every spelling of a field is read, whatever layout its record has: text stays text,
    clocks become epoch milliseconds, flags become booleans. A text that stands only in the
    content's elements is their texts, joined. Whatever no column was read from is in
    ``extras``: top-level keys as they are, keys of the sender and content objects as
    parent.key (or their whole object, where a top-level key has such a name), further
    spellings of a field that is given twice, and values that couldn't be read.
    Payloads that don't parse give a row with ``parsed`` false and nulls, so no record is lost.
    """
    v = records.withColumn("__v", document(payload)).withColumn(
        "__ok", F.coalesce(F.schema_of_variant("__v").startswith("OBJECT"), F.lit(False))
    )
    v = v.withColumn("__v", F.when(F.col("__ok"), F.col("__v")))
    if names is not None and not names.isEmpty():
        v = _with_names(v, names).withColumn("__v", _renamed(F.col("__v"), F.col("__names"), ""))
        for parent in PARENTS:
            for p in ALIASES[parent]:
                v = v.withColumn("__v", _renamed_below(F.col("__v"), p, F.col("__names"), parent))

    # Readings are (path, column) in order of preference: the first that isn't null counts.
    def read(path: str, kind: str) -> F.Column:
        c = F.try_variant_get("__v", f"$.{path}", kind)
        return F.nullif(c, F.lit("")) if kind == "string" else c

    def first(group: str, kind: str = "string") -> list[tuple[str, F.Column]]:
        return [(n, read(n, kind)) for n in ALIASES[group]]

    def below(parent: str, group: str) -> list[tuple[str, F.Column]]:
        return [(f"{p}.{n}", read(f"{p}.{n}", "string")) for p in ALIASES[parent] for n in ALIASES[group]]

    def plain(parent: str) -> list[tuple[str, F.Column]]:
        """The parent where it is a text itself."""
        return [
            (p, F.when(F.schema_of_variant(F.try_variant_get("__v", f"$.{p}", "variant")) == "STRING", F.try_variant_get("__v", f"$.{p}", "string")))
            for p in ALIASES[parent]
        ]

    def element_texts(parent: str) -> F.Column:
        texts = F.transform(F.try_variant_get("__v", f"$.{parent}.elements", "array<variant>"), lambda e: F.try_variant_get(e, "$.data.text", "string"))
        return F.nullif(F.array_join(F.filter(texts, lambda t: t != ""), "\n"), F.lit(""))

    def value(readings: list[tuple[str, F.Column]]) -> F.Column:
        return F.coalesce(*[c for _, c in readings])

    def taken(readings: list[tuple[str, F.Column]]) -> F.Column:
        return F.coalesce(*[F.when(c.isNotNull(), F.lit(p)) for p, c in readings])


    def flag(group: str) -> list[tuple[str, F.Column]]:
        return first(group, "boolean") + [(n, c != 0) for n, c in first(group, "int")]

    readings = {
        "id": first("id"),
        "seq": first("seq"),
        "sender_uid": below("sender", "sender.uid"),
        "sender_uin": below("sender", "sender.uin"),
        "sender_name": below("sender", "sender.name") + plain("sender"),
        "sender_nickname": below("sender", "sender.nickname"),
        "text": plain("content") + below("content", "content.text"),
        "html": below("content", "content.html"),
        "type": first("type"),
        "is_system": flag("system"),
        "is_recalled": flag("recalled"),
    }
    clock = value(first("time"))
    time_ms = usable_millis(clock.try_cast("long"), clock)
    v = v.withColumns({f"__{n}": value(r) for n, r in readings.items()} | {"__time_ms": time_ms})
    paths = [taken(r) for r in readings.values()] + [F.when(F.col("__time_ms").isNotNull(), taken(first("time")))]
    v = v.withColumn("__taken", F.array_compact(F.array(*paths)))

    strings = "map<string,string>"
    v = v.withColumn("__top", F.from_json(F.when(F.col("__ok"), F.to_json("__v")), strings))
    folded, rest = [], []
    for p in (n for g in PARENTS for n in ALIASES[g]):
        whole = F.try_variant_get("__v", f"$.{p}", "variant")
        own = F.map_filter(
            F.from_json(F.when(F.schema_of_variant(whole).startswith("OBJECT"), F.to_json(whole)), strings), lambda _, x: x.isNotNull()
        )
        prefix = F.lit(f"{p}.")
        own = F.transform_keys(own, lambda k, _: F.concat(prefix, k))
        # Without keys to fold, or with names that are taken, the object stays whole.
        fits = (F.size(own) > 0) & ~F.arrays_overlap(F.map_keys(own), F.map_keys("__top"))
        folded.append(F.when(fits, F.lit(p)))
        rest.append(F.when(fits, own))
    v = v.withColumn("__folded", F.array_compact(F.array(*folded)))
    top = F.map_filter("__top", lambda k, _: ~F.array_contains("__folded", k))
    every = F.map_concat(top, *[F.coalesce(r, F.create_map().cast(strings)) for r in rest])
    known = sorted({n for g in ("id", "seq", "time", "sender", "content", "system", "recalled", "type") for n in ALIASES[g]})
    extras = F.map_filter(every, lambda k, x: ~F.array_contains("__taken", k) & (x.isNotNull() | ~k.isin(*known)))
    elements = F.coalesce(*[element_texts(p) for p in ALIASES["content"]])
    fields = {
        "parsed": F.col("__ok"),
        "id": F.col("__id"),
        "seq": F.col("__seq"),
        "time_ms": F.col("__time_ms"),
        **{n: F.col(f"__{n}") for n in ("sender_uid", "sender_uin", "sender_name", "sender_nickname")},
        "text": F.coalesce("__text", elements),
        **{n: F.col(f"__{n}") for n in ("html", "type", "is_system", "is_recalled")},
        "extras": extras,
    }
    return v.select(*keep, *[c.alias(n if n not in keep else f"{n}_") for n, c in fields.items()])
