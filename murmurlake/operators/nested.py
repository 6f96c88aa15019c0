"""Deeply nested records as related flat tables, in one pass over the rows.

A depth-first visitor walks the schema once, on the driver, and writes one expression:
for every object in an array of objects it emits a tagged row (table, path, path of the
parent, position, payload), followed by the rows of the object's own children. Rows are
then written partitioned by tag, and each table's schema is applied to its payloads.
No shuffle, no Python and no second scan are needed, however deep the schema is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NODE = "struct<tag:string,node_path:string,parent_path:string,position:int,payload:string>"


def _object_array(t: T.DataType) -> bool:
    return isinstance(t, T.ArrayType) and isinstance(t.elementType, T.StructType)


def own_schema(struct: T.StructType) -> T.StructType:
    """The object's own fields: without arrays of objects, which become tables."""
    fields = []
    for f in struct.fields:
        if _object_array(f.dataType):
            continue
        t = own_schema(f.dataType) if isinstance(f.dataType, T.StructType) else f.dataType
        if not (isinstance(t, T.StructType) and not t.fields):
            fields.append(T.StructField(f.name, t, True))
    return T.StructType(fields)


def _own(col: Column, struct: T.StructType) -> Column:
    parts = []
    for f in own_schema(struct).fields:
        child = col.getField(f.name)
        if isinstance(f.dataType, T.StructType):
            source = struct[f.name].dataType
            child = F.when(child.isNotNull(), _own(child, source))
        parts.append(child.alias(f.name))
    return F.struct(*parts) if parts else F.struct(F.lit(None).cast("string").alias("_"))


def _children(col: Column, struct: T.StructType, tag: str) -> list[tuple[str, str, Column, T.StructType]]:
    """(tag, name, column, schema) of each array of objects below an object, in schema order."""
    found = []
    for f in struct.fields:
        child = col.getField(f.name)
        if _object_array(f.dataType):
            found.append((f"{tag}.{f.name}", f.name, child, f.dataType.elementType))
        elif isinstance(f.dataType, T.StructType):
            found += _children(child, f.dataType, f"{tag}.{f.name}")
    return found


def _visit(array: Column, struct: T.StructType, tag: str, prefix: Column, parent: Column, payload: bool) -> Column:
    none = F.expr(f"cast(array() as array<{NODE}>)")

    def one(x: Column, i: Column) -> Column:
        path = F.concat(prefix, i.cast("string"))
        own = F.array(
            F.struct(
                F.lit(tag).alias("tag"),
                path.alias("node_path"),
                parent.alias("parent_path"),
                i.cast("int").alias("position"),
                (F.to_json(_own(x, struct)) if payload else F.lit(None).cast("string")).alias("payload"),
            )
        )
        below = [
            _visit(c, s, t, F.concat(path, F.lit(f".{name}.")), path, payload) for t, name, c, s in _children(x, struct, tag)
        ]
        return F.when(x.isNull(), none).otherwise(F.concat(own, *below) if below else own)

    return F.coalesce(F.flatten(F.transform(array, one)), none)


def root(df: DataFrame, *candidates: str) -> Column:
    """The first of the array columns that is neither null nor empty."""
    col = F.col(candidates[-1])
    for c in reversed(candidates[:-1]):
        col = F.when(F.size(F.coalesce(F.col(c), F.expr("cast(array() as " + _type_at(df.schema, c).simpleString() + ")"))) > 0, F.col(c)).otherwise(col)
    return col


def _type_at(schema: T.StructType, dotted: str) -> T.DataType:
    t: T.DataType = schema
    for part in dotted.split("."):
        t = t[part].dataType  # type: ignore[index]
    return t


def emit_objects(df: DataFrame, key: str, roots: dict[str, tuple[str, ...]], payload: bool = True) -> DataFrame:
    """(key, table, node_path, parent_path, position, payload): a row for each object.

    ``roots`` names the first-level arrays: table name → dotted columns, of which the
    first that is neither null nor empty counts. Null arrays and null objects give no
    row; null entries keep their position. ``parent_path`` is "" for first-level
    objects, whose parent is the record itself. Other columns of ``df`` are ignored,
    so clashing names do no harm. Repeated records give repeated rows.
    """
    parts = []
    for name, columns in roots.items():
        struct = _type_at(df.schema, columns[0]).elementType  # type: ignore[attr-defined]
        parts.append(_visit(root(df, *columns), struct, name, F.lit(f"{name}."), F.lit(""), payload))
    nodes = parts[0] if len(parts) == 1 else F.concat(*parts)
    return df.select(F.col(key), F.explode(nodes).alias("n")).select(
        key, F.col("n.tag").alias("table"), "n.node_path", "n.parent_path", "n.position", "n.payload"
    )


def table_names(source: DataFrame, roots: dict[str, tuple[str, ...]]) -> list[str]:
    """The names of all flat tables, as the schema has them, whether they have rows or not."""

    def below(struct: T.StructType, tag: str) -> list[str]:
        return [tag, *[t for name, s in _arrays(struct, tag) for t in below(s, name)]]

    return [t for name, columns in roots.items() for t in below(_type_at(source.schema, columns[0]).elementType, name)]  # type: ignore[attr-defined]


def _arrays(struct: T.StructType, tag: str) -> list[tuple[str, T.StructType]]:
    found = []
    for f in struct.fields:
        if _object_array(f.dataType):
            found.append((f"{tag}.{f.name}", f.dataType.elementType))
        elif isinstance(f.dataType, T.StructType):
            found += _arrays(f.dataType, f"{tag}.{f.name}")
    return found


def write_tables(tagged: DataFrame, path: str) -> None:
    """Write the tagged rows partitioned by table."""
    tagged.write.mode("overwrite").partitionBy("table").parquet(path)


def apply_schema(tagged: DataFrame, source: DataFrame, key: str, table: str, roots: dict[str, tuple[str, ...]]) -> DataFrame:
    """One flat table: the rows of ``table`` with their payload parsed by its schema."""
    first, *rest = table.split(".")
    struct = _type_at(source.schema, roots[first][0]).elementType  # type: ignore[attr-defined]
    for part in rest:
        t = struct[part].dataType
        struct = t.elementType if isinstance(t, T.ArrayType) else t
    schema = own_schema(struct)
    parsed = tagged.where(F.col("table") == table).withColumn("__o", F.from_json("payload", schema))
    taken = {key, "node_path", "parent_path", "position"}
    return parsed.select(
        key,
        "node_path",
        "parent_path",
        "position",
        *[F.col("__o").getField(f.name).alias(f"{f.name}_" if f.name in taken else f.name) for f in schema.fields],
    )


MESSAGE_ROOTS: dict[str, tuple[str, ...]] = {
    "elements": ("content.elements", "elements"),
    "mentions": ("content.mentions",),
    "badges": ("sender.member.badges",),
}
