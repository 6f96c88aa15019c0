"""Ranks and running sums that don't gather a key's rows in one task.

A window over a hot key sorts that key's rows in one task. Here rows are first split
by a bucket within the key; windows run over (key, bucket), and only one summary row
per (key, bucket) goes through a second window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucketed_prefix(
    df: DataFrame,
    keys: list[str],
    bucket: Column,
    order: list[str],
    rank: str = "rank",
    value: str | list[str] | None = None,
    before: str | list[str] = "before",
) -> DataFrame:
    """Add ``rank`` (from 0) and, with ``value``, its sum over the rows before; several values may be listed.

    The order within a key is (bucket, order); with a bucket that grows with the order
    columns this is the plain order. Null keys form a group of their own. An empty
    input gives an empty result. The order has to be total for a repeatable result.
    """
    values = [value] if isinstance(value, str) else value or []
    names = [before] if isinstance(before, str) else before
    b = df.withColumn("__bucket", bucket)
    filled = [F.coalesce(F.col(v), F.lit(0)).cast("long") for v in values]
    totals = b.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(f"__v{i}") for i, v in enumerate(filled)])
    over = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c: F.coalesce(F.sum(c).over(over), F.lit(0))
    offsets = totals.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__bucket").alias("__ob"),
        so_far("__n").alias("__on"),
        *[so_far(f"__v{i}").alias(f"__ov{i}") for i in range(len(values))],
    )
    local = Window.partitionBy(*keys, "__bucket").orderBy(*order)
    earlier = local.rowsBetween(Window.unboundedPreceding, -1)
    out = b.withColumns({"__r": F.row_number().over(local) - 1} | {f"__l{i}": F.coalesce(F.sum(v).over(earlier), F.lit(0)) for i, v in enumerate(filled)})
    on = F.col("__bucket").eqNullSafe(F.col("__ob"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    out = out.join(offsets, on, "left").withColumns(
        {rank: (F.col("__r") + F.col("__on")).cast("long")} | {names[i]: (F.col(f"__l{i}") + F.col(f"__ov{i}")).cast("long") for i in range(len(values))}
    )
    return out.select(*df.columns, rank, *names[: len(values)])


#: Keys with at least this part of all rows are joined by broadcast: there can be no more than as many.
HOT_PARTS = 1000


def join_sized(many: DataFrame, few: DataFrame, on: list[str], size: str, total: int) -> DataFrame:
    """``many`` joined to ``few``, whose keys are unique and tell by ``size`` how many rows of ``many`` have them.

    Keys with a large part of the ``total`` rows are broadcast; they are at most ``HOT_PARTS``,
    since their sizes add up to the total. No other key can fill a task.
    """
    hot = F.col(size) * HOT_PARTS >= F.lit(max(total, 1))
    return many.join(F.broadcast(few.where(hot)), on).unionByName(many.join(few.where(~hot), on))


#: Rows of one key that a bucket shall hold at most, on average.
ROWS_IN_BUCKET = 500_000


def buckets_for(rows: int) -> int:
    """How many buckets a key needs that may hold all of so many rows: their number grows with the data."""
    return max(16, -(-rows // ROWS_IN_BUCKET))


def salt(columns: list[str], rows: int) -> Column:
    """A bucket from the hash of columns that tell a key's rows apart; ``rows`` is the number of all rows."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets_for(rows))).cast("int")
