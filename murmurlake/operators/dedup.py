"""Duplicates among blocks: exact ones beyond a limit, and near ones greedily in block order.

Near-duplicates are pairs whose sets of character pairs have a Jaccard similarity of at least
the threshold. Texts that are equal without white space form one class first, so copies
don't multiply pairs. Candidates then come from sketches: parities of the pairs by hash. Two
sketches can't differ in more bits than the sets differ in pairs, and two sets of that
similarity differ in few; sizes must fit too. Sketches of all texts of fitting sizes are compared, block
by block, and whatever can reach the threshold is verified, nothing is dropped. The greedy choice is a fixpoint over pairs:
a class without undecided or kept earlier neighbours is kept, later neighbours of kept ones go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from murmurlake.operators.ranking import bucketed_prefix, join_sized
from murmurlake.session import cut

#: A sketch has this many bits a pair at least, up to MOST_BITS. Fewer bits let more pairs through that are then compared in full.
BITS_A_PAIR = 2
MOST_BITS = 1 << 15
#: Rows are compared by blocks. Each is sent to all that it may have similar sets with, so their number
#: is bounded; only beyond MOST_IN_BLOCK rows or BYTES_IN_BLOCK, which a task has to hold twice, there are more.
BLOCKS = 12
LEAST_IN_BLOCK, MOST_IN_BLOCK, BYTES_IN_BLOCK = 2_048, 131_072, 32_000_000
#: Texts to compare are picked by broadcast up to so many.
BROADCAST_IDS = 1_000_000
_CHARS_AT_ONCE = 1_000_000
_TILE = 8, 4096
_FOUND_AT_ONCE = 500_000
#: The side of rows that are compared among themselves.
ITSELF = 2
_MOST_TASKS = 10_000


def limit_copies(blocks: DataFrame, bucket: Column, order: list[str], keep: int) -> DataFrame:
    """Rejects each copy of a my_text after the first ``keep``, already rejected blocks included.

    ``bucket`` has to grow with ``order``; it splits the copies of one text among tasks.
    """
    hashed = blocks.withColumn("__sha", F.sha2(F.coalesce("my_text", F.lit("")), 256))
    ranked = bucketed_prefix(hashed, ["__sha"], bucket, order, rank="__rank")
    over = F.col("__rank") >= keep
    return ranked.withColumns(
        {
            "bucket": F.when(over, F.lit("rejected")).otherwise(F.col("bucket")),
            "reasons": F.when(over, F.array_append("reasons", F.lit(f"exact_duplicate:kept_{keep}_already"))).otherwise(F.col("reasons")),
        }
    ).drop("__sha", "__rank")


def text_classes(blocks: DataFrame, key: str, text: str) -> DataFrame:
    """(key, rep, t): each block's class, named by its first block; t is the text without white space.

    A text that many blocks have, the empty one say, is joined by broadcast, not in one task.
    """
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"(?U)[\s\x1C-\x1F]+", "")
    base = blocks.select(F.col(key).alias("key"), t.alias("t")).withColumn("sha", F.sha2("t", 256))
    reps = cut(base.groupBy("sha").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("n")), "reps")
    total = reps.agg(F.sum("n")).first()[0] or 0
    return join_sized(base, reps, ["sha"], "n", total).select("key", "rep", "t")


def _mixed(codes: np.ndarray) -> np.ndarray:
    """A hash of each code whose low bits depend on all of its bits."""
    h = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h >> np.uint64(32)


def pair_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, code): the distinct character pairs of each text, each pair as one number, in order of both."""
    chars = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    both = (rows[:-1] << 42) | (chars[:-1] << 21) | chars[1:]
    both = np.sort(both[rows[:-1] == rows[1:]])
    if len(both):
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
    return both >> 42, both & ((1 << 42) - 1)


def sketches_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(size, width, bytes) of each text's set: bit i of its sketch is the parity of the pairs with hash i.

    Hashes are taken modulo the width, a power of two that grows with the set. Halves of a sketch that are
    laid over each other by exclusive or make the sketch of half the width.
    """
    rows, codes = pair_sets(texts)
    sizes = np.bincount(rows, minlength=len(texts))
    width = np.clip(1 << np.ceil(np.log2(np.maximum(BITS_A_PAIR * sizes, 1))).astype(np.int64), 64, MOST_BITS)
    start = np.cumsum(width) - width
    at = start[rows] + (_mixed(codes).astype(np.int64) & (width[rows] - 1))
    parity = np.bincount(at, minlength=int(width.sum())).astype(np.uint8) & 1
    return sizes, width, np.packbits(parity, bitorder="little")


def _jaccard(left: str, right: str) -> float:
    a, b = pair_sets([left])[1], pair_sets([right])[1]
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about ``_CHARS_AT_ONCE`` characters each."""
    first = held = 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= _CHARS_AT_ONCE:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _sketches(texts: DataFrame) -> DataFrame:
    """(id, size, sketch) of the texts that have a pair."""
    kind = texts.schema["rep"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(1).to_pylist()
            for first, end in _chunks(held):
                sizes, width, sketch = sketches_of(held[first:end])
                offsets = np.concatenate([[0], np.cumsum(width // 8)]).astype(np.int32)
                binary = pa.Array.from_buffers(pa.binary(), end - first, [None, pa.py_buffer(offsets), pa.py_buffer(sketch)])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(sizes, pa.int32()), binary], names=["id", "size", "sketch"])

    return texts.select("rep", "t").mapInArrow(work, f"id {kind}, size int, sketch binary")


def _plan(classes: list, threshold: float) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(blocks, meetings): blocks are (class, number of the first block, how many); meetings are (block, group, side).

    ``classes`` has a row a class of sizes: its name, rows, bytes of sketches, least and greatest size. Classes
    that hold little share a block, others are split by hash. A group is what two blocks that may have similar
    sets make together; a block meets itself on one side.
    """
    rows = min(max(sum(c["n"] for c in classes) // BLOCKS, LEAST_IN_BLOCK), MOST_IN_BLOCK)
    blocks, spans, held = [], [], 0.0
    for c in sorted(classes, key=lambda c: c["low"]):
        share = max(c["n"] / rows, c["bytes"] / BYTES_IN_BLOCK)
        if share > 1 or held + share > 1 or not spans:
            parts = max(1, math.ceil(share))
            blocks.append((c["class"], len(spans), parts))
            spans += [(c["low"], c["high"])] * parts
            held = 1.0 if parts > 1 else share
        else:
            blocks.append((c["class"], len(spans) - 1, 1))
            spans[-1] = (spans[-1][0], c["high"])
            held += share
    meetings, group = [], 0
    for i, (_, high) in enumerate(spans):
        for j in range(i, len(spans)):
            if spans[j][0] * threshold <= high + 1e-9:
                meetings += [(i, group, ITSELF)] if i == j else [(i, group, 0), (j, group, 1)]
                group += 1
    return blocks, meetings


class _Side:
    """The sketches of one side of a group by width, each ordered by size, as words by rows."""

    def __init__(self, sizes: np.ndarray, sketches: pa.Array):
        self.parts = []
        width = pc.binary_length(sketches).to_numpy()
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            at = at[np.argsort(sizes[at], kind="stable")]
            words = np.frombuffer(sketches.take(pa.array(at)).buffers()[2], np.uint64, len(at) * int(w) // 8)
            self.parts.append((at, sizes[at], np.ascontiguousarray(words.reshape(len(at), -1).T)))


def _folded(words: np.ndarray, n: int) -> np.ndarray:
    while len(words) > n:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bits each column of x differs from each of y."""
    bits = np.zeros((x.shape[1], y.shape[1]), np.uint16)
    for a, b in zip(x, y):
        bits += np.bitwise_count(a[:, None] ^ b)
    return bits


def _close(left: _Side, right: _Side, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of both sides whose sketches differ in no more bits than sets of that similarity may differ in pairs.

    Sketches of half the width come first; where these rule out most, the others are looked at one by one.
    Where very many texts are alike their pairs come by ``_FOUND_AT_ONCE``, so that they need not be held at once.
    """
    part = (1 - threshold) / (1 + threshold)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    for p, (at, sizes, words) in enumerate(left.parts):
        for q, (bt, others, more) in enumerate(right.parts):
            if same and q < p:
                continue
            n = min(len(words), len(more))
            x, y, reach = _folded(words, n), _folded(more, n), others * threshold
            fx, fy = _folded(x, max(n // 2, 1)), _folded(y, max(n // 2, 1))
            for i in range(0, len(at), _TILE[0]):
                s = sizes[i : i + _TILE[0]]
                first = int(np.searchsorted(others, s[0] * threshold - 1e-9))
                first = max(first, i + 1) if same and p == q else first
                end = int(np.searchsorted(reach, s[-1] + 1e-9, side="right"))
                for j in range(first, end, _TILE[1]):
                    o = others[j : min(j + _TILE[1], end)]
                    own, their = slice(i, i + len(s)), slice(j, j + len(o))
                    most = np.minimum(part * (s[-1] + o) + 1e-6, MOST_BITS).astype(np.uint16)
                    near = _differing(fx[:, own], fy[:, their]) <= most
                    if np.count_nonzero(near) * 16 > near.size:
                        near = _differing(x[:, own], y[:, their]) <= most
                    a, b = np.divmod(np.flatnonzero(near), len(o))
                    if not len(a):
                        continue
                    sa, sb = s[a], o[b]
                    bits = np.bitwise_count(x[:, a + i] ^ y[:, b + j]).sum(axis=0, dtype=np.int64)
                    ok = (bits <= part * (sa + sb) + 1e-6) & (np.minimum(sa, sb) >= threshold * np.maximum(sa, sb) - 1e-9)
                    if same and p == q:
                        ok &= b + j > a + i
                    found.append((at[a[ok] + i], bt[b[ok] + j]))
                    held += len(found[-1][0])
                    if held >= _FOUND_AT_ONCE:
                        yield np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                        found, held = [], 0
    if held:
        yield np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _candidates(sketches: DataFrame, threshold: float) -> DataFrame:
    """(a, b): the pairs that similar sets' sketches don't rule out, each once, a < b."""
    spark = sketches.sparkSession
    named = sketches.withColumn("class", F.floor(F.log2("size") * 16).cast("int"))
    classes = named.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("sketch")).alias("bytes"), F.min("size").alias("low"), F.max("size").alias("high")).collect()
    blocks, meetings = _plan(classes, threshold)
    kind = sketches.schema["id"].dataType.simpleString()
    if not blocks:
        return spark.createDataFrame([], f"a {kind}, b {kind}")
    first = spark.createDataFrame(blocks, "class int, first int, parts int")
    meets = spark.createDataFrame(meetings, "block int, group int, side int")
    block = (F.col("first") + F.pmod(F.xxhash64("id"), F.col("parts"))).cast("int")
    rows = named.join(F.broadcast(first), "class").withColumn("block", block).join(F.broadcast(meets), "block").select("group", "side", "id", "size", "sketch")
    groups = max(g for _, g, _ in meetings) + 1

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        side, sizes = table.column("side").to_numpy(), table.column("size").to_numpy().astype(np.int64)
        ids, sketch = table.column("id").combine_chunks(), table.column("sketch").combine_chunks().cast(pa.binary())
        same = side[0] == ITSELF
        rows = [np.flatnonzero(side == k) for k in ((ITSELF, ITSELF) if same else (0, 1))]
        left = _Side(sizes[rows[0]], sketch.take(pa.array(rows[0])))
        right = left if same else _Side(sizes[rows[1]], sketch.take(pa.array(rows[1])))
        del table, sketch
        for a, b in _close(left, right, same, threshold):
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[0][a])), ids.take(pa.array(rows[1][b]))], names=["x", "y"])

    pairs = rows.repartition(min(groups, _MOST_TASKS), "group").groupBy("group").applyInArrow(work, f"x {kind}, y {kind}")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def similar_pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity): pairs of class representatives, a < b, with at least the threshold.

    ``classes`` holds one row per representative: rep and t. Texts below two
    characters have no pairs.
    """
    texts = classes.select("rep", "t").where(F.length("t") > 1)
    pairs = cut(_candidates(cut(_sketches(texts), "sketches"), threshold), "candidates")
    few = cut(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "compared")
    texts = texts.join(F.broadcast(few) if few.count() <= BROADCAST_IDS else few, "rep", "left_semi")
    full = pairs.join(texts.withColumnsRenamed({"rep": "a", "t": "ta"}), "a").join(texts.withColumnsRenamed({"rep": "b", "t": "tb"}), "b")
    kind = texts.schema["rep"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ta, tb = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            similarity = pa.array([_jaccard(x, y) for x, y in zip(ta, tb)], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), similarity], names=["a", "b", "similarity"])

    return full.select("a", "b", "ta", "tb").mapInArrow(work, f"a {kind}, b {kind}, similarity double").where(F.col("similarity") >= threshold)


def greedy_keep(pairs: DataFrame) -> DataFrame:
    """(id, similarity): the representatives that go, with their greatest similarity to an earlier kept one.

    Each round decides every node whose earlier neighbours are decided; a node goes at
    once when an earlier neighbour is kept. Rounds are cut from their lineage.
    """
    edges = cut(pairs, "pairs")
    nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().select("id", F.lit(None).cast("boolean").alias("kept"))
    nodes = cut(nodes, "nodes")
    while True:
        state = edges.join(nodes.withColumnsRenamed({"id": "a", "kept": "ka"}), "a").groupBy(F.col("b").alias("id")).agg(
            F.max(F.coalesce(F.col("ka"), F.lit(False))).alias("hit"), F.max(F.col("ka").isNull()).alias("waits")
        )
        joined = nodes.join(state, "id", "left")
        hit, waits = F.coalesce("hit", F.lit(False)), F.coalesce("waits", F.lit(False))
        nodes = cut(joined.select("id", F.coalesce("kept", F.when(hit, F.lit(False)).when(~waits, F.lit(True))).alias("kept")), "nodes", replaces=nodes)
        if not nodes.where("kept is null").limit(1).count():
            break
    kept = nodes.where("kept").select(F.col("id").alias("a"))
    gone = edges.join(kept, "a").groupBy(F.col("b").alias("id")).agg(F.max("similarity").alias("similarity"))
    return gone.join(nodes.where("not kept"), "id", "left_semi")


def near_duplicates(blocks: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """(key, rep, similarity): every block that is removed, with its class and similarity.

    ``key`` is a number that orders the blocks. Later copies of a kept text have similarity 1.
    """
    classes = cut(text_classes(blocks, key, text), "classes")
    gone = greedy_keep(similar_pairs(classes.where("key = rep"), threshold))
    joined = classes.select("key", "rep").join(gone.withColumnRenamed("id", "rep"), "rep", "left")
    similarity = F.coalesce("similarity", F.when(F.col("key") != F.col("rep"), F.lit(1.0)))
    return joined.select(F.col("key").alias(key), "rep", similarity.alias("similarity")).where("similarity is not null")


def reject_near(blocks: DataFrame, key: str, threshold: float) -> DataFrame:
    """Rejects near-duplicates among the blocks that aren't rejected yet."""
    live = blocks.where(F.coalesce("bucket", F.lit("")) != "rejected")
    gone = near_duplicates(live, key, "my_text", threshold).select(F.col(key).alias("__key"), F.col("similarity").alias("__sim"))
    joined = blocks.join(gone, F.col(key) == F.col("__key"), "left")
    hit = F.col("__sim").isNotNull() & (F.coalesce("bucket", F.lit("")) != "rejected")
    return joined.withColumns(
        {
            "reasons": F.when(hit, F.array_append("reasons", F.format_string("near_duplicate:similarity=%.2f", "__sim"))).otherwise(F.col("reasons")),
            "bucket": F.when(hit, F.lit("rejected")).otherwise(F.col("bucket")),
        }
    ).select(*blocks.columns)
