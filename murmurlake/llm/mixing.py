"""Mixing sources to target weights.

Each source's texts, in a pseudorandom order, are laid end to end and cut into blocks
of a fixed number of tokens. Every output shard draws how many blocks it takes of each
source from a multinomial; a source's n-th draw in the whole output takes block
permutation(n) of the pass n // blocks, where each pass has its own pseudorandom permutation.
So a block comes once a pass, a text at most as often as there are passes, and blocks
are joined by index alone.

Draws add up to the targets only on average. The difference – of order √n – is settled
by numbering: draws beyond a source's quota are handed, in order, to the sources
that are short of theirs, by arithmetic on one number a source.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmurlake.operators.ranking import bucketed_prefix, buckets_for

BLOCK = 512
SHARD_SLOTS = 256


@dataclass(frozen=True)
class Source:
    name: str
    share: float
    max_repeats: int
    tokens: int
    blocks: int
    quota: int  # blocks of the mix, repeats counted
    drawn: int = 0


def quotas(targets: list[tuple[str, float, int]], tokens: dict[str, int], block: int = BLOCK) -> list[Source]:
    """The largest mix that gives every source its share within its repeats.

    Sources without tokens can't reach a share and are left out, the other shares
    scaled up. Sources come in the order of their names.
    """
    listed = sorted((s, w, max(0, r), tokens.get(s, 0)) for s, w, r in targets if w > 0)
    usable = [x for x in listed if x[2] > 0 and x[3] > 0]
    weight = sum(x[1] for x in usable)
    if not usable:
        return []
    # Whole passes over whole blocks: a last short block counts by its tokens.
    size = min(r * t / (w / weight) for _, w, r, t in usable)
    out = []
    for s, w, r, t in usable:
        blocks = math.ceil(t / block)
        mean = t / blocks  # tokens of a block, the last one included
        out.append(Source(s, w / weight, r, t, blocks, max(1, min(r * blocks, round(size * w / weight / mean)))))
    return out


def permuted(index: np.ndarray, blocks: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of range(blocks): a four-round Feistel network with cycle walking."""
    if blocks < 2:
        return np.zeros_like(index)
    half = max(1, math.ceil(math.log2(blocks) / 2))
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1B54A32D192ED03) % 2**64) for r in range(1, 5)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            f = (right + k) * np.uint64(0xBF58476D1CE4E5B9)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while (far := out >= blocks).any():
        out[far] = once(out[far])
    return out.astype(np.int64)


def block_parts(sizes: DataFrame, sources: list[str], key: str, source: str, block: int = BLOCK) -> DataFrame:
    """(source, block, key, from_token, tokens): which tokens of which text make up each block."""
    kept = sizes.where(F.col(source).isin(*sources) & (F.col("n_tokens") > 0)).select(
        F.col(source).alias("source"), F.col(key), F.col("n_tokens"), F.xxhash64(F.col(key), F.lit(17)).alias("__h")
    )
    laid = bucketed_prefix(kept, ["source"], F.pmod(F.col("__h"), F.lit(buckets_for(sizes.count()))).cast("int"), ["__h", key], value="n_tokens", before="__at")
    first, last = F.floor(F.col("__at") / block), F.floor((F.col("__at") + F.col("n_tokens") - 1) / block)
    cut_up = laid.select("source", key, "n_tokens", "__at", F.explode(F.sequence(first, last)).alias("block"))
    start = F.greatest(F.lit(0), F.col("block") * block - F.col("__at"))
    stop = F.least(F.col("n_tokens"), (F.col("block") + 1) * block - F.col("__at"))
    return cut_up.select("source", "block", key, start.alias("from_token"), (stop - start).alias("tokens"))


def slots(spark, plan: list[Source], seed: int = 0, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """(shard, source, pass, block): the blocks of each output shard."""
    total = sum(s.quota for s in plan)
    shares = np.array([s.quota / total for s in plan])
    shards = math.ceil(total / shard_slots)

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k in pdf["id"]:
                n = min(shard_slots, total - int(k) * shard_slots)
                rows += [(int(k), i, int(c)) for i, c in enumerate(np.random.default_rng([seed, int(k)]).multinomial(n, shares)) if c]
            yield pd.DataFrame(rows, columns=["shard", "s", "n"])

    drawn = spark.range(shards).mapInPandas(draw, "shard long, s int, n long")
    counts = {r["s"]: r["n"] for r in drawn.groupBy("s").agg(F.sum("n").alias("n")).collect()}  # one row a source
    got = np.array([counts.get(i, 0) for i in range(len(plan))])
    quota = np.array([s.quota for s in plan])
    over, short = np.maximum(got - quota, 0), np.maximum(quota - got, 0)
    over_at, short_at = np.concatenate([[0], np.cumsum(over)]), np.concatenate([[0], np.cumsum(short)])
    numbered = bucketed_prefix(drawn, ["s"], F.floor(F.col("shard") / 1024).cast("long"), ["shard"], value="n", before="at")
    each = numbered.select("shard", "s", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("j"))
    blocks, names = [s.blocks for s in plan], [s.name for s in plan]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            s, j = pdf["s"].to_numpy().copy(), pdf["j"].to_numpy().copy()
            late = j >= quota[s]
            u = over_at[s[late]] + j[late] - quota[s[late]]
            to = np.searchsorted(short_at, u, side="right") - 1
            s[late], j[late] = to, got[to] + u - short_at[to]
            size = np.array(blocks)[s]
            turn, block = j // size, np.empty_like(j)
            for i in np.unique(s):
                for p in np.unique(turn[s == i]):
                    own = (s == i) & (turn == p)
                    block[own] = permuted(j[own] % blocks[i], blocks[i], seed * 1_000_003 + int(i) * 1009 + int(p))
            yield pd.DataFrame({"shard": pdf["shard"], "source": np.array(names, object)[s], "pass": turn.astype(np.int64), "block": block})

    return each.mapInPandas(place, "shard long, source string, pass long, block long")


def plan_mix(sizes: DataFrame, targets: DataFrame, source: str = "source", block: int = BLOCK) -> list[Source]:
    named = targets.where("source is not null and target_share is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min(F.coalesce("max_repeats", F.lit(0))).alias("max_repeats"))
    listed = [(r["source"], float(r["target_share"]), int(r["max_repeats"])) for r in named.orderBy("source").collect()]  # a row a source of the targets
    have = sizes.join(F.broadcast(targets.select(F.col("source").alias("__s")).distinct()), F.col(source) == F.col("__s")).groupBy("__s").agg(F.sum("n_tokens").alias("n"))
    return quotas(listed, {r["__s"]: int(r["n"] or 0) for r in have.collect()}, block)


def mix(sizes: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", block: int = BLOCK, seed: int = 0) -> DataFrame:
    """(shard, source, pass, block, key, from_token, tokens): the texts of each block of each shard.

    ``sizes`` has key, source and n_tokens and should be a written table. Rows of other
    sources, null sources and texts without tokens aren't used. Without any usable
    source the mix is empty.
    """
    plan = plan_mix(sizes, targets, source, block)
    parts = block_parts(sizes, [s.name for s in plan] or [""], key, source, block)
    if not plan:
        empty = "shard long, source string, pass long, block long"
        return sizes.sparkSession.createDataFrame([], empty).join(parts, ["source", "block"]).select("shard", "source", "pass", "block", key, "from_token", "tokens")
    chosen = slots(sizes.sparkSession, plan, seed)
    # (source, block) is a fine key: a block holds at most ``block`` tokens of texts.
    return chosen.join(parts, ["source", "block"]).select("shard", "source", "pass", "block", key, "from_token", "tokens")


def mix_report(sizes: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", block: int = BLOCK, seed: int = 0) -> DataFrame:
    """(source, target_share, actual_share, tokens, blocks, max_repeats, most_repeats) of each target."""
    mixed = mix(sizes, targets, key, source, block, seed)
    by_part = mixed.groupBy("source", key, "from_token").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("uses"))
    by_source = by_part.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.max("uses").alias("most_repeats"))
    total = by_source.agg(F.sum("tokens").alias("all_tokens"))
    shares = by_source.crossJoin(F.broadcast(total))  # one row
    return targets.select("source", "target_share", F.col("max_repeats").cast("long").alias("max_repeats")).join(shares, "source", "left").select(
        "source",
        "target_share",
        F.round(F.coalesce(F.col("tokens") / F.col("all_tokens"), F.lit(0.0)), 6).alias("actual_share"),
        F.coalesce("tokens", F.lit(0)).alias("tokens"),
        "max_repeats",
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
    )
