import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from murmurlake.llm import keyness, mixing, packing, spans, tokens


def test_counts_take_the_last_row_of_a_run(spark):
    import datetime as dt

    d = lambda n: dt.datetime(2012, 1, n)
    rows = [(1, " a", {"x": 2, "y": None}, 9, 0.5, d(1)), (1, "a ", None, 7, None, d(2)), (1, "b", {}, 3, None, d(1)), (2, "a", None, None, None, None), (None, "a", None, 1, None, d(1)), (1, " ", None, 1, None, d(1)), (1, None, None, 1, None, d(1))]
    df = spark.createDataFrame(rows, "run_id long, phrase string, bucket_freq map<string,long>, freq long, style_keyness double, mined_at timestamp")
    assert sorted(tuple(r) for r in keyness.latest_counts(df).select("run_id", "phrase", "n").collect()) == [(1, "a", 7), (1, "b", 0), (2, "a", 0)]


def test_common_terms_count_little_and_bursts_much(spark):
    rng = random.Random(5)
    rows = [(r, "the", rng.randint(40, 60)) for r in range(60)] + [(r, f"own{r}", 30) for r in range(3)] + [(r, "rare", 25 if r == 7 else 1) for r in (7, 8, 9)]
    df = spark.createDataFrame(rows, "run_id long, phrase string, n long")
    got = {(r["run_id"], r["phrase"]): r for r in keyness.score_terms(df).collect()}
    assert got[(7, "rare")]["posterior"] > 0.99 > 0.5 > np.mean([got[(r, "the")]["posterior"] for r in range(60)])
    assert got[(8, "rare")]["posterior"] < 0.5
    assert {(r["run_id"], r["phrase"]) for r in keyness.characteristic(keyness.score_terms(df)).collect()} == {(7, "rare")}
    assert keyness.score_terms(df.limit(0)).count() == 0


def test_a_run_that_a_term_dominates_hides_no_other(spark):
    uneven = [(800, "term", 1200), (800, "fill", 800), (801, "term", 60), (801, "fill", 1940)]
    df = spark.createDataFrame([(r, "fill", 1119) for r in range(800)] + uneven, "run_id long, phrase string, n long")
    scored = keyness.score_terms(df)
    assert {(r["run_id"], r["phrase"]) for r in keyness.characteristic(scored).collect()} == {(800, "term"), (801, "term")}
    assert keyness.characteristic(keyness.score_terms(df, steps=0)).count() == 0  # without the fit nothing is told apart


def test_em_finds_two_rates():
    rng = np.random.default_rng(1)
    size = np.full(400, 100.0)
    count = rng.poisson(np.where(np.arange(400) < 40, 0.3, 0.02) * size).astype(float)
    have = count > 0
    (fit,) = keyness.fit_histograms([list(zip(count[have], size[have], np.ones(have.sum()), strict=True))], [count.sum() / size.sum()])
    low, elite, share = fit[0]
    assert abs(elite - 0.3) < 0.03 and 0.05 < share < 0.15 and abs(low - 0.02) < 0.005


def _plain_em(cells, overall, steps=500):
    """One term's fit written out cell by cell, with sums in plain Python."""
    import math

    low = elite = overall
    share, posts = 0.1, [0.9 if c / s > overall else 0.1 for c, s, _ in cells]
    for step in range(steps):
        if step:
            posts = []
            for c, s, _ in cells:
                a = c * math.log(elite) - elite * s - math.log(1 - math.exp(-elite * s)) + math.log(share)
                b = c * math.log(low) - low * s - math.log(1 - math.exp(-low * s)) + math.log(1 - share)
                posts.append(1 / (1 + math.exp(b - a)) if b - a < 700 else 0.0)
        n1 = sum(w * p * c for (c, _, w), p in zip(cells, posts, strict=True))
        t1 = sum(w * p * s / (1 - math.exp(-elite * s)) for (_, s, w), p in zip(cells, posts, strict=True))
        n0 = sum(w * (1 - p) * c for (c, _, w), p in zip(cells, posts, strict=True)) + keyness.PRIOR
        t0 = sum(w * (1 - p) * s / (1 - math.exp(-low * s)) for (_, s, w), p in zip(cells, posts, strict=True)) + keyness.PRIOR / overall
        share = (sum(w * p for (_, _, w), p in zip(cells, posts, strict=True)) + 0.1) / (sum(w for _, _, w in cells) + 1)
        was, (elite, low) = (elite, low), (n1 / t1, n0 / t0)
        if step and max(abs(math.log(elite / was[0])), abs(math.log(low / was[1]))) < keyness.EM_TOLERANCE:
            break
    return low, elite, share


def test_fits_equal_a_plain_one_and_don_t_depend_on_their_batch():
    rng = random.Random(3)
    hists = [[(float(rng.randint(1, 40)), float(rng.choice([120, 300, 900])), float(rng.randint(1, 5))) for _ in range(rng.randint(1, 12))] for _ in range(40)]
    overall = [sum(c * w for c, _, w in h) / (sum(s * w for _, s, w in h) * rng.choice([1.5, 20])) for h in hists]
    together = keyness.fit_histograms(hists, overall)
    for h, o, fits in zip(hists, overall, together, strict=True):
        assert np.allclose(fits[0], _plain_em(h, o), rtol=1e-4)
        assert np.allclose(fits, keyness.fit_histograms([h], [o])[0], rtol=1e-9)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=25))
def test_plans_place_every_item_once(counts):
    plan = packing.plan_containers(counts, 40)
    used: dict[int, int] = {}
    for combo, times in zip(plan.combos, plan.times, strict=True):
        assert sum(combo) <= 40 and times > 0
        for x in combo:
            used[x] = used.get(x, 0) + times
    assert used == counts
    total = sum(k * v for k, v in counts.items())
    assert plan.containers >= -(-total // 40)
    for length, (first, base, per) in plan.places().items():
        ids = [base[i] + (r - first[i]) // per[i] for r in range(counts[length]) for i in [np.searchsorted(first, r, side="right") - 1]]
        assert len(ids) == counts[length] and max(ids) < plan.containers


def test_complements_are_found_exactly():
    plan = packing.plan_containers({60: 4, 40: 1, 25: 3, 15: 2, 20: 1}, 100)
    assert all(sum(c) == 100 for c in plan.combos[:2])
    assert packing._Available({10: 1, 20: 1}, 100).pair(20) is None and packing._Available({10: 2}, 100).pair(20) == (10, 10)
    assert packing._Available({5: 1, 6: 1, 9: 1}, 100).triple(20) == (9, 6, 5)
    assert packing._Available({5: 2, 10: 1}, 100).triple(20) == (10, 5, 5)
    assert packing.plan_containers({}, 10).containers == 0


def test_packing_keeps_every_token(spark):
    rng = random.Random(2)
    sizes = spark.createDataFrame([(i, rng.choice([0, 3, 3, 3, 7, 50, 100, 101, 250, 999])) for i in range(300)] + [(999, None)], "doc_id long, n_tokens long")
    kinds = spark.createDataFrame([("s", 100), ("s", 100), ("b", 512), ("bad", 0), (None, 5)], "container_kind string, capacity_tokens int")
    rows = packing.pack(sizes, kinds).cache()
    total = sizes.agg(F.sum("n_tokens")).first()[0]
    assert {r["container_kind"]: r["t"] for r in rows.groupBy("container_kind").agg(F.sum("size").alias("t")).collect()} == {"s": total, "b": total}
    full = rows.groupBy("container_kind", "container_id").agg(F.sum("size").alias("t"))
    assert {r["container_kind"]: r["m"] <= c for r in full.groupBy("container_kind").agg(F.max("t").alias("m")).collect() for c in [100 if r["container_kind"] == "s" else 512]} == {"s": True, "b": True}
    split = rows.groupBy("container_kind", "doc_id").agg(F.count(F.lit(1)).alias("k"), F.sum("size").alias("t")).where("k > 1").collect()
    assert split and all(r["t"] > (100 if r["container_kind"] == "s" else 512) for r in split)
    assert rows.groupBy("container_kind", "doc_id", "piece").count().where("count > 1").count() == 0
    ids = {r["container_kind"]: (r["n"], r["m"]) for r in full.groupBy("container_kind").agg(F.count(F.lit(1)).alias("n"), F.max("container_id").alias("m")).collect()}
    plans = {r["container_kind"]: r["n_containers"] for r in packing.report(sizes, kinds).collect()}
    assert {k: n for k, (n, _) in ids.items()} == plans and all(n == m + 1 for n, m in ids.values())
    assert packing.pack(sizes.limit(0), kinds).count() == 0


def sizes(spark):
    rng = random.Random(4)
    rows = [(i, "big" if i < 300 else "small" if i < 320 else None if i < 325 else "other", rng.randint(0, 90)) for i in range(340)]
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long").cache()


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, target_share double, max_repeats int")


def test_mix_reaches_shares_within_repeats(spark):
    t = targets(spark, ("big", 0.6, 1), ("small", 0.3, 4), ("missing", 0.1, 2), (None, 0.1, 2))
    mixed = mixing.mix(sizes(spark), t, block=32).cache()
    shares = {r["source"]: r["t"] for r in mixed.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    assert set(shares) == {"big", "small"} and abs(shares["small"] / sum(shares.values()) - 1 / 3) < 0.02
    uses = mixed.groupBy("source", "doc_id", "from_token").count().groupBy("source").agg(F.max("count").alias("m")).collect()
    assert {r["source"]: r["m"] <= (1 if r["source"] == "big" else 4) for r in uses} == {"big": True, "small": True}
    blocks = mixed.groupBy("shard", "source", "pass", "block").agg(F.sum("tokens").alias("t"))
    assert blocks.where("t > 32").count() == 0 and blocks.groupBy("source", "pass", "block").count().where("count > 1").count() == 0
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, mixing.mix(sizes(spark).repartition(5), t, block=32).collect()))
    report = {r["source"]: r["tokens"] for r in mixing.mix_report(sizes(spark), t, block=32).collect()}
    assert report["missing"] == 0 and report["small"] == shares["small"]


def test_blocks_hold_each_token_once(spark):
    parts = mixing.block_parts(sizes(spark), ["big", "small"], "doc_id", "source", 32)
    got = {r["doc_id"]: r["t"] for r in parts.groupBy("doc_id").agg(F.sum("tokens").alias("t")).collect()}
    assert got == {r["doc_id"]: r["n_tokens"] for r in sizes(spark).where("source in ('big', 'small') and n_tokens > 0").collect()}
    full = [r["t"] for r in parts.groupBy("source", "block").agg(F.sum("tokens").alias("t")).collect()]
    assert sum(t < 32 for t in full) <= 2 and max(full) == 32


def test_no_usable_source_gives_an_empty_mix(spark):
    assert mixing.mix(sizes(spark), targets(spark, ("none", 1.0, 1))).count() == 0
    assert mixing.mix(sizes(spark), targets(spark)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutations(n):
    for key in range(3):
        assert sorted(mixing.permuted(np.arange(n), n, key).tolist()) == list(range(n))


def brute(rows, length):
    out = set()
    have = {k: {t[i : i + length] for i in range(len(t) - length + 1)} for k, t in rows if t}
    for a in have:
        for b in have:
            if a < b and have[a] & have[b]:
                out.add((a, b))
    return out


def test_cover_moves_any_two_positions_onto_it():
    assert spans.is_cover(spans.PERIOD, spans.COVER)
    assert all(any((i + d) % 21 in spans.COVER and (j + d) % 21 in spans.COVER for d in range(21)) for i in range(21) for j in range(21))


@pytest.mark.parametrize("seed", range(3))
def test_shared_spans_against_all_pairs(spark, seed):
    """Whatever is proven within a task, and however sets are dealt into blocks."""
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("甲乙丙丁abc ，\n😀") for _ in range(n))
    shared = [word(n) for n in (59, 60, 61, 90)]
    rows = [(i, word(rng.randint(0, 150)) + rng.choice([*shared, "", ""]) + word(rng.randint(0, 50))) for i in range(40)]
    rows += [(100, None), (101, ""), (102, "x" * 500), (103, "y" + "x" * 70), (104, rows[0][1]), (105, rows[0][1]), (106, "ab" * 300), (107, "ba" * 40)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key int").repartition(3)
    found = spans.SharedSpans(df, "doc_id", "text", flush_at=(100, 3000, 10**6)[seed], block=(2, 1000, 7)[seed])
    whole = brute(rows, 60)
    pairs = [(r["a"], r["b"]) for r in found.pairs().collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == whole
    first = {}
    for k, t in rows:
        first.setdefault(t, k)
    rep = {k: first[t] for k, t in rows}
    between = {(min(x, y), max(x, y)) for x, y in ((rep[a], rep[b]) for a, b in whole) if x != y}
    assert {(r["ref_a"], r["ref_b"]) for r in found.links().collect()} == between
    classes = {r["doc_id"]: r for r in found.classes().collect()}
    for k, t in rows:
        assert classes[k]["n_links"] == sum(rep[k] in p for p in between)
        assert classes[k]["class"] == (rep[k] if t and len(t) >= 60 else None)
    parts = {r["doc_id"]: r for r in found.report().collect()}
    assert len(parts) == len(rows) and parts[100]["shared_rate"] == 0.0
    for k, t in rows:
        covered = set()
        for o, u in rows:
            if o != k and t and u:
                covered |= {p for i in range(len(t) - 59) if t[i : i + 60] in u for p in range(i, i + 60)}
        assert parts[k]["shared_chars"] == len(covered)


def test_spans_of_records_with_text_keys_and_repeats(spark):
    body = "".join(random.Random(9).choice("abcdefgh ") for _ in range(80))
    df = spark.createDataFrame([("p", "1" + body), ("q", body + "2"), ("r", body + "2"), ("r", body + "2"), ("s", "x" * 100)], "name string, text string")
    found = spans.SharedSpans(df, "name", "text")
    assert {(r["a"], r["b"]) for r in found.pairs().collect()} == {("p", "q"), ("p", "r"), ("q", "r")}
    assert {r["name"]: r["shared_chars"] for r in found.report().collect()} == {"p": 80, "q": 81, "r": 81, "s": 0}


def test_a_text_or_passage_that_many_have_stays_in_small_pieces(spark):
    """A third of all records are copies of one text, a third have one passage: links are few, rows of blocks small."""
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("甲乙丙丁戊己庚辛") for _ in range(n))
    copy, passage = word(200), word(70)
    rows = [(i, copy) for i in range(300)] + [(i, word(40) + passage + word(40)) for i in range(300, 400)] + [(i, word(120)) for i in range(400, 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = spans.SharedSpans(df, "doc_id", "text", flush_at=500, block=16)
    assert found.links().count() == 100 * 99 // 2
    assert found.pairs().count() == 100 * 99 // 2 + 300 * 299 // 2
    assert sorted((r["copies"], r["n"]) for r in found.classes().groupBy("copies").agg(F.count(F.lit(1)).alias("n")).collect()) == [(1, 300), (300, 300)]


def test_spans_of_empty_tables_and_bad_covers(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    found = spans.SharedSpans(df, "doc_id", "text")
    assert found.pairs().count() == 0 and found.report().count() == 0
    with pytest.raises(ValueError):
        spans.SharedSpans(df, "doc_id", "text", 60, 21, (0, 1))


def test_token_counts(spark):
    import os

    if not os.path.exists(tokens.DEFAULT):
        pytest.skip("no tokenizer files")
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "<|endoftext|>")], "doc_id long, text string")
    for name in ("byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"):
        got = {r["doc_id"]: r["n_tokens"] for r in tokens.token_counts(df, ["doc_id"], "text", f"/opt/tokenizers/{name}").collect()}
        assert got[1] >= 2 and got[2] == got[3] == 0 and got[4] > 1
