import random

import numpy as np
import pyarrow as pa

from murmurlake.operators import dedup


def test_sketches_differ_no_more_than_sets_and_fold():
    rng = random.Random(2)
    texts = ["".join(rng.choices("abcdefgh😀的了", k=rng.randrange(2, 400))) for _ in range(60)]
    sizes, width, data = dedup.sketches_of(texts)
    sets = [{t[i : i + 2] for i in range(len(t) - 1)} for t in texts]
    assert [len(s) for s in sets] == sizes.tolist()
    parts = [np.frombuffer(p.tobytes(), np.uint64)[:, None] for p in np.split(data, np.cumsum(width // 8)[:-1])]
    for i, x in enumerate(parts):
        assert dedup._folded(x, 1).item() == np.bitwise_xor.reduce(x).item()
        for j, y in enumerate(parts):
            n = min(len(x), len(y))
            assert dedup._differing(dedup._folded(x, n), dedup._folded(y, n)).item() <= len(sets[i] ^ sets[j])


def test_texts_of_the_same_pairs_make_few_candidates(spark, monkeypatch):
    """No pair is rare here; texts are compared within and among many blocks, ids are structs as in the pipeline."""
    monkeypatch.setattr(dedup, "LEAST_IN_BLOCK", 16)
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(40, 120))) for _ in range(400)]
    texts += [t[:-3] + "xyz" for t in texts[::9]] + [t + "q" * rng.randrange(1, 9) for t in texts[::7]] + ["", "x", "xy", "xyx"]
    pairs = [{t[i : i + 2] for i in range(len(t) - 1)} for t in texts]
    brute = {(i, j): len(x & y) / len(x | y) for i, x in enumerate(pairs) for j, y in enumerate(pairs) if i < j and x and y and len(x & y) >= 0.8 * len(x | y)}
    classes = spark.createDataFrame([((i // 7, i), t) for i, t in enumerate(texts)], "rep struct<f: int, i: int>, t string").cache()
    found = dedup.similar_pairs(classes, 0.8).collect()
    assert {(r["a"]["i"], r["b"]["i"]): r["similarity"] for r in found} == brute and len(found) == len(brute) > 90
    candidates = dedup._candidates(dedup._sketches(classes.where("length(t) > 1")), 0.8).count()
    assert len(brute) <= candidates < 2 * len(brute)


def test_blocks_meet_where_sizes_fit(monkeypatch):
    monkeypatch.setattr(dedup, "LEAST_IN_BLOCK", 10)
    monkeypatch.setattr(dedup, "MOST_IN_BLOCK", 10)
    classes = [{"class": k, "n": n, "bytes": n * 64, "low": low, "high": high} for k, n, low, high in ((3, 4, 10, 11), (4, 5, 12, 12), (5, 25, 13, 15), (9, 2, 40, 44))]
    blocks, meetings = dedup._plan(classes, 0.8)
    assert blocks == [(3, 0, 1), (4, 0, 1), (5, 1, 3), (9, 4, 1)]
    groups = {}
    for b, g, side in meetings:
        groups.setdefault(g, []).append((b, side))
    met = {tuple(b for b, _ in sorted(m, key=lambda x: x[1])) for m in groups.values()}
    assert met == {(0,), (0, 1), (0, 2), (0, 3), (1,), (1, 2), (1, 3), (2,), (2, 3), (3,), (4,)} and len(met) == len(groups)
    assert dedup._plan([], 0.8) == ([], [])


def test_pairs_of_texts_that_are_all_alike_come_in_parts(spark, tmp_path, monkeypatch):
    from murmurlake.plans.core_queries import QUERIES

    body = "今天去公园散步看见一只很大的白鸟停在湖边的石头上然后慢慢飞走了"
    texts = [body + chr(0x5000 + i) for i in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["near_dup_pairs"](spark, str(tmp_path)).collect()
    assert sorted((r["a"], r["b"]) for r in found) == [(i, j) for i in range(300) for j in range(i + 1, 300)]

    monkeypatch.setattr(dedup, "_FOUND_AT_ONCE", 1000)
    sizes, width, data = dedup.sketches_of(texts)
    sketches = pa.array([x.tobytes() for x in np.split(data, np.cumsum(width // 8)[:-1])], pa.binary())
    side = dedup._Side(sizes, sketches)
    parts = list(dedup._close(side, side, True, 0.8))
    assert max(len(a) for a, _ in parts) < 1000 + dedup._TILE[0] * len(texts)
    assert len({(min(x, y), max(x, y)) for a, b in parts for x, y in zip(a.tolist(), b.tolist())}) == sum(len(a) for a, _ in parts) == 300 * 299 // 2
