"""Filling fixed-capacity containers by exact-complement hashing.

Only lengths matter for a plan, and there are at most as many lengths as the capacity:
the plan is made on the histogram of lengths, never on the items. Lengths are taken from the
largest; the gap that is left is looked up in the index of available single lengths, of
sums of two and of sums of three, and a combination that fills it exactly is
consumed as often as its lengths are available. What has no exact partners is packed
best-fit, largest first. The plan comes as runs (combination, times), so that
its size too depends on the capacity alone; items then take their places by rank.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurlake.operators.ranking import bucketed_prefix, salt


@dataclass
class Plan:
    """Runs of equal containers: combos[i] (lengths) is used times[i] times."""

    capacity: int
    combos: list[tuple[int, ...]] = field(default_factory=list)
    times: list[int] = field(default_factory=list)

    def add(self, combo: tuple[int, ...], times: int) -> None:
        self.combos.append(tuple(sorted(combo, reverse=True)))
        self.times.append(times)

    @property
    def containers(self) -> int:
        return sum(self.times)

    def places(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """length → (first rank, first container, items in a container) of each run that takes it."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        used: dict[int, int] = {}
        base = 0
        for combo, times in zip(self.combos, self.times, strict=True):
            for length in set(combo):
                k = combo.count(length)
                out.setdefault(length, []).append((used.get(length, 0), base, k))
                used[length] = used.get(length, 0) + k * times
            base += times
        return {n: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for n, rows in out.items()}  # type: ignore[misc]


class _Available:
    """Counts by length, with the available lengths as bits, forwards and backwards.

    The lengths x for which x and gap - x are both there are then one shift and one AND.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.n = [0] * (capacity + 1)
        self.bits = self.back = 0
        for length, c in counts.items():
            self.set(length, c)

    def set(self, length: int, count: int) -> None:
        was, self.n[length] = self.n[length], count
        if (was > 0) != (count > 0):
            self.bits ^= 1 << length
            self.back ^= 1 << (self.capacity - length)

    def single(self, gap: int) -> tuple[int, ...] | None:
        return (gap,) if self.n[gap] > 0 else None

    def pair(self, gap: int) -> tuple[int, ...] | None:
        """Two lengths of sum ``gap``, the most unequal pair first: large pieces are the hard ones."""
        both = self.bits & (self.back >> (self.capacity - gap))
        if not both:
            return None
        small = (both & -both).bit_length() - 1
        if 2 * small == gap and self.n[small] < 2:
            return None
        return gap - small, small

    def triple(self, gap: int) -> tuple[int, ...] | None:
        todo = self.bits & ((1 << max(gap - 1, 0)) - 1)
        while (a := todo.bit_length() - 1) * 3 >= gap:
            todo ^= 1 << a
            count = self.n[a]
            self.set(a, count - 1)
            rest = self.pair(gap - a)
            self.set(a, count)
            if rest:
                return (a, *rest)
        return None

    def take(self, combo: tuple[int, ...]) -> int:
        """Consume the combination as often as it can be, and say how often."""
        need = {x: combo.count(x) for x in combo}
        times = min(self.n[x] // k for x, k in need.items())
        for x, k in need.items():
            self.set(x, self.n[x] - k * times)
        return times


def plan_containers(counts: dict[int, int], capacity: int) -> Plan:
    """A plan for ``counts`` items of each length from 1 to ``capacity``."""
    plan = Plan(capacity)
    left = _Available(counts, capacity)
    rest: dict[int, int] = {}
    for length in range(capacity, 0, -1):
        while left.n[length]:
            gap = capacity - length
            left.set(length, left.n[length] - 1)  # the item itself isn't its own partner
            fill = () if gap == 0 else left.single(gap) or left.pair(gap) or left.triple(gap)
            left.set(length, left.n[length] + 1)
            if fill is None:
                rest[length] = left.n[length]
                left.set(length, 0)
                break
            plan.add((length, *fill), left.take((length, *fill)))
    _best_fit(plan, rest)
    return plan


def _best_fit(plan: Plan, rest: dict[int, int]) -> None:
    """Best fit, largest first, on runs of equal open containers."""
    room: list[int] = []  # distinct free spaces, ascending
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(space: int, combo: tuple[int, ...], times: int) -> None:
        if space not in open_:
            open_[space] = []
            insort(room, space)
        open_[space].append((combo, times))

    for length in sorted(rest, reverse=True):
        n = rest[length]
        while n:
            at = bisect_left(room, length)
            if at == len(room):
                per = plan.capacity // length
                if n >= per:
                    put(plan.capacity - per * length, (length,) * per, n // per)
                if n % per:
                    put(plan.capacity - n % per * length, (length,) * (n % per), 1)
                break
            space = room[at]
            combo, times = open_[space].pop()
            if not open_[space]:
                del open_[space]
                room.pop(at)
            k = min(n, times)
            if times > k:
                put(space, combo, times - k)
            put(space - length, (*combo, length), k)
            n -= k
    for runs in open_.values():
        for combo, times in runs:
            plan.add(combo, times)


def pieces(sizes: DataFrame, containers: DataFrame, key: str = "doc_id") -> DataFrame:
    """(container_kind, capacity_tokens, key, piece, from_token, size): items, split only where larger than the container.

    Items without tokens need no place and have no piece. Repeated kinds of a container
    count once; kinds without a positive capacity are left out.
    """
    kinds = containers.where("capacity_tokens > 0 and container_kind is not null").groupBy("container_kind").agg(F.max("capacity_tokens").alias("capacity_tokens"))
    items = sizes.where("n_tokens > 0").select(key, "n_tokens").crossJoin(F.broadcast(kinds))  # a fixed list of kinds
    cap = F.col("capacity_tokens")
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / cap).cast("int")))
    cut_up = items.select("container_kind", "capacity_tokens", key, "n_tokens", part.alias("piece"))
    start = (F.col("piece") * cap).cast("long")
    return cut_up.select(
        "container_kind", "capacity_tokens", key, "piece", start.alias("from_token"), F.least(cap.cast("long"), F.col("n_tokens") - start).cast("int").alias("size")
    )


def plans(parts: DataFrame) -> dict[str, Plan]:
    """A plan for each kind; what is collected is a histogram, at most one row a token of capacity."""
    rows = parts.groupBy("container_kind", "capacity_tokens", "size").agg(F.count(F.lit(1)).alias("n")).collect()
    counts: dict[tuple[str, int], dict[int, int]] = {}
    for r in rows:
        counts.setdefault((r["container_kind"], r["capacity_tokens"]), {})[r["size"]] = r["n"]
    return {kind: plan_containers(c, capacity) for (kind, capacity), c in counts.items()}


def pack(sizes: DataFrame, containers: DataFrame, key: str = "doc_id") -> DataFrame:
    """(container_kind, container_id, key, piece, from_token, size): each piece's container.

    ``sizes`` has key and n_tokens and should be a written table, since it is read twice.
    """
    parts = pieces(sizes, containers, key)
    made = plans(parts)
    spark = sizes.sparkSession
    rows = max((sum(len(c) * t for c, t in zip(p.combos, p.times, strict=True)) for p in made.values()), default=0)
    places = spark.sparkContext.broadcast({k: p.places() for k, p in made.items()})  # bounded by the capacities
    ranked = bucketed_prefix(parts, ["container_kind", "size"], salt([key, "piece"], rows), [key, "piece"])
    kind = parts.schema[key].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column(0).to_pylist()
            size = batch.column(4).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            ids = np.empty(batch.num_rows, np.int64)
            names = np.array(kinds, object)
            for name in set(kinds):
                own = np.flatnonzero(names == name)
                order = own[np.argsort(size[own], kind="stable")]
                cuts = np.flatnonzero(np.append(True, np.diff(size[order]) != 0))
                for group in np.split(order, cuts[1:]):
                    first, base, per = places.value[name][int(size[group[0]])]
                    run = np.searchsorted(first, rank[group], side="right") - 1
                    ids[group] = base[run] + (rank[group] - first[run]) // per[run]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids), batch.column(1), batch.column(2), batch.column(3), batch.column(4)],
                names=["container_kind", "container_id", "key", "piece", "from_token", "size"],
            )

    placed = ranked.select("container_kind", F.col(key).alias("key"), "piece", "from_token", "size", "rank")
    out = placed.mapInArrow(work, f"container_kind string, container_id long, key {kind}, piece int, from_token long, size int")
    return out.withColumnRenamed("key", key)


def report(sizes: DataFrame, containers: DataFrame, key: str = "doc_id") -> DataFrame:
    """(container_kind, capacity_tokens, n_pieces, n_containers, least_containers, exact_containers, fill_rate) of each kind."""
    made = plans(pieces(sizes, containers, key))
    rows = []
    for kind, p in sorted(made.items()):
        used = sum(sum(c) * t for c, t in zip(p.combos, p.times, strict=True))
        n = sum(len(c) * t for c, t in zip(p.combos, p.times, strict=True))
        full = sum(t for c, t in zip(p.combos, p.times, strict=True) if sum(c) == p.capacity)
        rows.append((kind, p.capacity, n, p.containers, -(-used // p.capacity), full, round(used / (p.containers * p.capacity), 6)))
    schema = "container_kind string, capacity_tokens int, n_pieces long, n_containers long, least_containers long, exact_containers long, fill_rate double"
    return sizes.sparkSession.createDataFrame(rows, schema)
