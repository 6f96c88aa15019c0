"""Long exact spans that records share, found by difference-cover anchors.

Windows are hashed only at positions whose remainder by a period v lies in a difference
cover of v. For any two positions i and j some shift below v moves both onto the cover, so
two records that share a run of at least ``length`` characters share an aligned window
(an anchor) of length - v + 1 characters: no match is lost, at |cover| / v hashes a character.

1. Copies are one class; what follows is done once for each class, on its representative.
2. Anchors are sorted, packed and compressed by each task before they are shuffled (about 9
   bytes an anchor). An anchor that a task has of two texts is proven shared there, and only
   one text goes on to meet other tasks', so no common anchor gathers anywhere.
3. Shared anchors are extended, on their own texts, by up to v - 1 characters to the left and
   right to every window of ``length`` characters that holds them. Windows are known by 128
   bits of hash and counted; those of two texts are the shared runs.
4. Links: windows of the same set of texts are one set, known by sums of hashes. A set's
   pairs are made in blocks, so that no task or row holds a set of any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from murmurlake.operators.ranking import join_sized
from murmurlake.session import cut

LENGTH = 60
# A perfect difference set modulo 21.
PERIOD, COVER = 21, (0, 1, 4, 14, 16)
#: Members of a block; a set of more is split into blocks, and pairs are made block by block.
BLOCK = 1000
#: Tables of at most this many 64-bit numbers, counted before, are joined by broadcast; larger ones by exchange.
BROADCAST_NUMBERS = 1_000_000

_CHARS_AT_ONCE = 500_000
_ANCHORS_IN_FLUSH = 1_000_000
_ANCHORS_IN_TASK = 400_000
_ROWS_AT_ONCE = 50_000
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def is_cover(period: int, cover: tuple[int, ...]) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def window_hashes(chars: np.ndarray, at: np.ndarray, size: int, base: int = _BASES[0]) -> np.ndarray:
    """64-bit hashes of the windows [p, p + size) for the positions ``at``."""
    n = len(chars)
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_mix(chars.astype(np.uint64) + np.uint64(base & 0xFFFF)) * np.cumprod(powers), out=prefix[1:])
    powers[1:] = np.uint64(pow(base, -1, 2**64))
    back = np.cumprod(powers)
    return _mix((prefix[at + size] - prefix[at]) * back[at])


def _anchors(refs: np.ndarray, texts: list[np.ndarray], window: int, period: int, cover: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, ref, position in the text) of all anchors of some texts."""
    sizes = np.array([len(t) for t in texts])
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    chars = np.concatenate(texts)
    place = np.arange(len(chars)) - np.repeat(first, sizes)
    on_cover = np.zeros(period, bool)
    on_cover[cover] = True
    fits = np.repeat(sizes, sizes) - place >= window
    at = np.flatnonzero(on_cover[place % period] & fits)
    return window_hashes(chars, at, window), np.repeat(refs, sizes)[at], place[at]


def _planes(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes()


def _pack(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers, the first sorted, as differences from it or from their least, by byte planes, compressed."""
    first = np.concatenate([columns[0][:1], np.diff(columns[0])])
    lows = [int(c.min()) for c in columns[1:]]
    body = b"".join([_planes(first), *[_planes(c.astype(np.int64) - low) for c, low in zip(columns[1:], lows, strict=True)]])
    head = np.array([len(first), *lows], np.int64).tobytes()
    return head + pa.compress(body, codec="zstd", asbytes=True)


def _unpack(data: bytes, columns: int) -> list[np.ndarray]:
    head = np.frombuffer(data[: 8 * columns], np.int64)
    n = int(head[0])
    body = np.frombuffer(pa.decompress(data[8 * columns :], 8 * columns * n, codec="zstd", asbytes=True), np.uint8).reshape(columns, 8, n)
    raw = [np.ascontiguousarray(p.T).view(np.uint64).ravel() for p in body]
    return [np.cumsum(raw[0], dtype=np.uint64), *[c.astype(np.int64) + low for c, low in zip(raw[1:], head[1:], strict=True)]]


def _shared_runs(h: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted hashes: (whether an entry's hash is of two texts or more, whether it is the first of its hash)."""
    first = np.append(True, h[1:] != h[:-1])
    starts = np.flatnonzero(first)
    many = np.maximum.reduceat(refs, starts) != np.minimum.reduceat(refs, starts)
    return np.repeat(many, np.diff(np.append(starts, len(h)))), first


def _found(refs: np.ndarray, h: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(refs, pa.int64()), pa.array(h.view(np.int64))], names=["ref", "anchor"])


def anchor_parts(texts: DataFrame, parts: int, length: int, period: int, cover: tuple[int, ...], flush_at: int = _ANCHORS_IN_FLUSH) -> DataFrame:
    """(part, anchors) of ``texts`` (ref, text): packed anchors by the part of their hash.

    Parts from ``parts`` on hold anchors already proven shared.
    """
    window, where = length - period + 1, np.array(cover)

    def flush(held: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        h, refs = (np.concatenate(c) for c in zip(*held, strict=True))
        part = (h % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((h, part))
        h, refs, part = h[order], refs[order], part[order]
        proven, first = _shared_runs(h, refs)
        blobs: list[bytes] = []
        numbers: list[int] = []
        for chosen, base in ((~proven | first, 0), (proven, parts)):
            hs, rs, own = h[chosen], refs[chosen], part[chosen]
            if not len(hs):
                continue
            cuts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            for a, b in zip(cuts, np.append(cuts[1:], len(own)), strict=True):
                blobs.append(_pack(hs[a:b], rs[a:b]))
                numbers.append(int(own[a]) + base)
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], names=["part", "anchors"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            at, rows = 0, batch.num_rows
            own_texts = batch.column(1)
            while at < rows:
                some: list[np.ndarray] = []
                own: list[int] = []
                size = 0
                while at < rows and (not some or size < _CHARS_AT_ONCE):
                    chars = code_points(own_texts[at].as_py())
                    some.append(chars)
                    own.append(keys[at])
                    size += len(chars)
                    at += 1
                held.append(_anchors(np.array(own, np.int64), some, window, period, where)[:2])
                count += len(held[-1][0])
                if count >= flush_at:
                    yield from flush(held)
                    held, count = [], 0
        if count:
            yield from flush(held)

    return texts.mapInArrow(work, "part int, anchors binary")


def shared_anchors(texts: DataFrame, length: int, period: int, cover: tuple[int, ...], flush_at: int = _ANCHORS_IN_FLUSH) -> DataFrame:
    """(ref, anchor): the anchors that at least two texts have, by their hash; one may come twice."""
    if length < period or not is_cover(period, cover):
        raise ValueError("the cover has to be a difference cover of a period no longer than the spans")
    chars = texts.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    tasks = max(4, math.ceil(chars * len(cover) / period / _ANCHORS_IN_TASK))
    parts = 4 * tasks

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                columns = _unpack(data.as_py(), 2)
                if part >= parts:
                    yield _found(columns[1], columns[0])
                else:
                    held.append(columns)
        if held:
            h, refs = (np.concatenate(c) for c in zip(*held, strict=True))
            order = np.argsort(h, kind="stable")
            h, refs = h[order], refs[order]
            many, _ = _shared_runs(h, refs)
            yield _found(refs[many], h[many])

    return anchor_parts(texts, parts, length, period, cover, flush_at).repartition(tasks, "part").mapInArrow(meet, "ref long, anchor long")


def extended_windows(texts: DataFrame, anchors: DataFrame, length: int, period: int, cover: tuple[int, ...]) -> DataFrame:
    """(w1, w2, ref, pos, new): every window of ``length`` characters that holds a shared anchor.

    w1 and w2 are its hash; new tells the first place of a window in its text.
    """
    by_text = anchors.groupBy("ref").agg(F.collect_set("anchor").alias("shared"))  # as many as the text has anchors at most
    by_text = cut(by_text, "anchors")
    if (by_text.agg(F.sum(F.size("shared") + 2)).first()[0] or 0) <= BROADCAST_NUMBERS:
        by_text = F.broadcast(by_text)
    rows = texts.join(by_text, "ref").select("ref", "text", "shared")
    window, where = length - period + 1, np.array(cover)
    names = ["w1", "w2", "ref", "pos", "new"]

    def rows_of(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held, strict=True)], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0
        for batch in batches:
            for ref, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                chars = code_points(text.as_py())
                n = len(chars) - length + 1
                if n < 1:
                    continue
                anchored = np.zeros(len(chars) + period, np.int64)
                h, _, places_of = _anchors(np.array([ref]), [chars], window, period, where)
                at = places_of[np.isin(h, places.values.to_numpy(zero_copy_only=False).view(np.uint64))]
                # A window that starts up to period - 1 characters before an anchor holds it.
                low = np.maximum(at - (period - 1), 0)
                np.add.at(anchored, low, 1)
                np.add.at(anchored, at + 1, -1)
                starts = np.flatnonzero(np.cumsum(anchored)[:n] > 0)
                if not len(starts):
                    continue
                w1, w2 = (window_hashes(chars, starts, length, b).view(np.int64) for b in _BASES)
                _, firsts = np.unique(w1, return_index=True)
                new = np.zeros(len(starts), bool)
                new[firsts] = True
                held.append((w1, w2, np.full(len(starts), ref, np.int64), starts.astype(np.int32), new))
                count += len(starts)
                if count >= _ROWS_AT_ONCE:
                    yield rows_of(held)
                    held, count = [], 0
        if held:
            yield rows_of(held)

    return rows.mapInArrow(work, "w1 long, w2 long, ref long, pos int, new boolean")


def text_classes(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    """(key, ref, rep, copies) of the records long enough: rep is the least key of the class of equal texts.

    ref is the representative's number: the key itself where that is a whole number.
    Keys are unique; a key that comes with two texts stands for both of them.
    """
    digests = docs.where(F.length(text) >= length).select(F.col(key).alias("key"), F.unhex(F.sha2(text, 256)).alias("digest"))
    groups = digests.groupBy("digest").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("copies"))
    if isinstance(docs.schema[key].dataType, T.IntegralType):
        groups = groups.withColumn("ref", F.col("rep").cast("long"))
    else:
        groups = groups.withColumn("ref", F.monotonically_increasing_id())
    groups = cut(groups, "text-classes")
    total = groups.agg(F.sum("copies")).first()[0] or 0
    return cut(join_sized(digests, groups, ["digest"], "copies", total).select("key", "ref", "rep", "copies"), "members")


class SharedSpans:
    """The runs that the records of a collection share, found once; its tables are written ones."""

    def __init__(self, docs: DataFrame, key: str, text: str, length: int = LENGTH, period: int = PERIOD, cover: tuple[int, ...] = COVER, flush_at: int = _ANCHORS_IN_FLUSH, block: int = BLOCK):
        self.docs, self.key, self.text, self.length, self.block = docs, key, text, length, block
        self.members = text_classes(docs, key, text, length)
        own = docs.where(F.length(text) >= length).select(F.col(key).alias("key"), F.col(text).alias("text"))
        if isinstance(docs.schema[key].dataType, T.IntegralType):
            copies = self.members.where("key <> ref").select("key")
            if copies.count() <= BROADCAST_NUMBERS:
                copies = F.broadcast(copies)
            once = own.join(copies, "key", "left_anti").select(F.col("key").cast("long").alias("ref"), "text")
            texts = own.select(F.col("key").cast("long").alias("ref"), "text")  # copies have no anchors, so they drop out by themselves
        else:
            once = texts = own.join(self.members.where("key = rep").select("key", "ref"), "key").select("ref", "text")
        anchors = shared_anchors(once, length, period, cover, flush_at)
        self.windows = cut(extended_windows(texts, anchors, length, period, cover), "windows")
        one = F.xxhash64(F.lit(1), "ref").cast("decimal(20,0)")
        two = F.xxhash64(F.lit(2), "ref").cast("decimal(20,0)")
        counted = self.windows.groupBy("w1", "w2").agg(
            F.min("ref").alias("low"),
            F.max("ref").alias("high"),
            F.count(F.lit(1)).alias("places"),
            F.count_if("new").alias("texts"),
            F.sum(F.when(F.col("new"), one)).alias("s1"),
            F.sum(F.when(F.col("new"), two)).alias("s2"),
        )
        self.shared = cut(counted.where("low <> high").drop("low", "high"), "shared")

    def _at_shared(self, few: DataFrame) -> DataFrame:
        total = self.windows.count()
        return join_sized(self.windows, few, ["w1", "w2"], "places", total)

    def coverage(self) -> DataFrame:
        """(ref, shared_chars): characters of a text that lie in runs which another text has."""
        starts = self._at_shared(self.shared.select("w1", "w2", "places")).groupBy("ref").agg(F.sort_array(F.collect_set("pos")).alias("at"))
        # Each window adds what the next one doesn't cover.
        nexts = F.slice("at", F.lit(2), F.size("at"))
        added = F.zip_with("at", nexts, lambda a, b: F.least(F.coalesce(b - a, F.lit(self.length)), F.lit(self.length)))
        return starts.select("ref", F.aggregate(added, F.lit(0), lambda s, x: s + x).cast("long").alias("shared_chars"))

    def links(self) -> DataFrame:
        """(ref_a, ref_b): each pair of classes that share a run, ref_a < ref_b, once."""
        sets = self.shared.groupBy("texts", "s1", "s2").agg(F.min(F.struct("w1", "w2", "places")).alias("w")).select("w.w1", "w.w2", "w.places", "texts")
        inside = self._at_shared(sets).where("new").select(F.struct("w1", "w2").alias("set"), F.col("ref").alias("member"), F.col("texts").alias("size"))
        return pairs_of_sets(inside, self.block).distinct().withColumnsRenamed({"a": "ref_a", "b": "ref_b"})

    def pairs(self) -> DataFrame:
        """(a, b): every pair of records that share a run, copies of one text among them; a < b, once."""
        names = self.members.select("key", "ref")
        left = self.links().join(names.withColumnsRenamed({"key": "x", "ref": "ref_a"}), "ref_a")
        both = left.join(names.withColumnsRenamed({"key": "y", "ref": "ref_b"}), "ref_b")
        apart = both.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        copies = pairs_of_sets(self.members.where("copies > 1").select(F.col("ref").alias("set"), F.col("key").alias("member"), F.col("copies").alias("size")).distinct(), self.block)
        return apart.unionByName(copies).distinct()

    def classes(self) -> DataFrame:
        """(key, class, copies, n_links) of every record: its class of equal texts and how many other classes that shares a run with.

        Records too short to share anything are left with a null class.
        """
        ends = self.links().select(F.explode(F.array("ref_a", "ref_b")).alias("ref"))
        linked = ends.groupBy("ref").agg(F.count(F.lit(1)).alias("n_links"))
        known = self.members.join(linked, "ref", "left").select(F.col("key").alias("__key"), F.col("rep").alias("class"), "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
        out = self.docs.select(self.key).join(known.distinct(), F.col(self.key) == F.col("__key"), "left")
        return out.select(self.key, "class", F.coalesce("copies", F.lit(1)).alias("copies"), F.coalesce("n_links", F.lit(0)).alias("n_links"))

    def report(self) -> DataFrame:
        """(key, n_chars, shared_chars, shared_rate) of every record, those without text included. No pairs are made."""
        whole = self.members.join(self.coverage(), "ref", "left").select(F.col("key").alias("__key"), (F.col("copies") > 1).alias("__copied"), "shared_chars")
        known = whole.groupBy("__key").agg(F.max("__copied").alias("__copied"), F.max("shared_chars").alias("__shared"))
        base = self.docs.select(self.key, F.coalesce(F.length(self.text), F.lit(0)).cast("long").alias("n_chars"))
        out = base.join(known, F.col(self.key) == F.col("__key"), "left")
        shared = F.when(F.col("__copied"), F.col("n_chars")).otherwise(F.coalesce("__shared", F.lit(0))).cast("long")
        return out.select(
            self.key,
            "n_chars",
            shared.alias("shared_chars"),
            F.when(F.col("n_chars") > 0, F.round(shared / F.col("n_chars"), 6)).otherwise(F.lit(0.0)).alias("shared_rate"),
        )


def pairs_of_sets(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b), a < b: the pairs within each set of ``members`` (set, member, size); pairs of several sets come several times.

    A set of more than ``block`` members is dealt into blocks, and each pair of blocks is a
    row of its own: rows have about two blocks of members however large the set is.
    """
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("member"), blocks).cast("int")
    others = F.sequence(F.lit(0), blocks - 1)
    met = members.withColumn("own", own).select(
        "set", "member", "own", F.explode(F.transform(others, lambda x: F.struct(F.least("own", x).alias("i"), F.greatest("own", x).alias("j")))).alias("p")
    )
    rows = met.groupBy("set", "p.i", "p.j").agg(F.sort_array(F.collect_set(F.struct("own", "member"))).alias("m"), F.first("p.i").alias("low"))
    rows = rows.select((F.col("i") == F.col("j")).alias("same"), F.transform("m", lambda m: m["member"]).alias("m"), F.size(F.filter("m", lambda m: m["own"] == F.col("low"))).alias("n"))
    kind = members.schema["member"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, pa.Array]] = []
        count = 0
        for batch in batches:
            for same, m, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                values = m.values
                for x in range(n):
                    partners = values.slice(x + 1) if same else values.slice(n)
                    if len(partners):
                        held.append((values.take(pa.array(np.full(len(partners), x))), partners))
                        count += len(partners)
                    if count >= _ROWS_AT_ONCE:
                        yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*held, strict=True)], names=["x", "y"])
                        held, count = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(c) for c in zip(*held, strict=True)], names=["x", "y"])

    made = rows.mapInArrow(work, f"x {kind}, y {kind}")
    return made.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
