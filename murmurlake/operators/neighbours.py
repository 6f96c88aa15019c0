"""Look-back and look-ahead along a numbered sequence without one task for a hot key.

Rows that are numbered within a key are dealt into chunks of consecutive numbers; the few
rows next to a chunk's ends are copied into it as ghosts, so that lag and lead see over
the edge. Ghosts are dropped afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

CHUNK = 4096


def with_neighbours(df: DataFrame, keys: list[str], position: str, back: int, ahead: int, chunk: int = CHUNK) -> tuple[DataFrame, WindowSpec, Column]:
    """(rows and ghosts, window for lag and lead, condition that drops the ghosts).

    ``position`` numbers the rows of a key from 0 without gaps.
    """
    own = F.floor(F.col(position) / F.lit(chunk)).cast("long")
    place = F.pmod(F.col(position), F.lit(chunk))
    targets = F.array_compact(
        F.array(
            own,
            F.when((place < ahead) & (own > 0), own - 1) if ahead else F.lit(None).cast("long"),
            F.when(place >= chunk - back, own + 1) if back else F.lit(None).cast("long"),
        )
    )
    rows = df.withColumn("__own", own).withColumn("__chunk", F.explode(targets))
    window = Window.partitionBy(*keys, "__chunk").orderBy(position)
    return rows, window, F.col("__own") == F.col("__chunk")
