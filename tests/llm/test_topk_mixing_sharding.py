import math
import random
from collections import defaultdict

import numpy as np

from noticeflow.llm import mixing, sharding, topk


def test_top_k_against_brute_force(spark, monkeypatch):
    r = random.Random(1)
    hot = [r.uniform(-1, 1) for _ in range(16)]
    rows = [(k, [r.gauss(0, 0.3) for _ in range(16)] if k % 3 else hot) for k in range(400)]
    rows += [(1000, None), (1050, []), (1100, [float("nan")] * 16), (1150, [1.0, None] * 8), (1200, [float("inf")] * 16), (None, hot), (1250, [1.0, 2.0]), (1300, [0.5, 0.25]), (150, hot), (1500, [1e7] + [0.0] * 15), (1550, [1.0] * 16), (None, [2e6] + [0.0] * 15), (1350, [3e38] * 16), (1400, [3e6] * 16), (1450, [-2.9e6] * 16)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int").repartition(5)
    monkeypatch.setattr(topk, "BLOCK", 64)
    got = {(x.query_id, x.rank, x.vec_id, x.score) for x in topk.top_k(df, df.where("vec_id % 50 = 0"), 5).collect()}
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q, x in good:
        if q is not None and q % 50 == 0:
            clip = lambda s: max(-(2**63), min(2**63 - 1, s))
            scores = sorted((-clip(sum(a * b for a, b in zip(x, y))), i is None, i or 0) for i, y in good if i != q and len(y) == len(x))[:5]
            want |= {(q, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(scores)}
    assert got == want and any(i is None for _, _, i, _ in got) and any(s == 2**63 - 1 for *_, s in got)
    assert topk.top_k(df.limit(0), df.limit(0)).collect() == []


def test_mix(spark):
    r = random.Random(2)
    rows = [(k, " ".join("w" * r.randint(1, 5) for _ in range(r.choice([0, 3, 20, 20, 300]))), r.choice(["b", "a", "a", "a", "a", None, "é", "tiny"])) for k in range(2000)]
    rows = [(i, t, s if s != "tiny" or i % 40 == 0 else "a") for i, t, s in rows] + [(9999, "x " * 40_000, "b"), (None, "n u l l", "a"), (3, rows[3][1], rows[3][2]), (10_000, None, "only blank"), (10_001, "\n", "only blank")]
    rows += [(None, "seven words that many rows have alike", "b")] * 700
    df = spark.createDataFrame([(i, t, s, 1, 2.0) for i, t, s in rows], "doc_id long, text string, source string, size int, z double").repartition(4)
    got = mixing.mix(df).collect()
    size, weight = defaultdict(int), {}
    for _, t, s in rows:
        size[s] += len((t or "").split())
    for k, s in enumerate(sorted(size, key=lambda s: (s is None, s or ""))):
        weight[s] = k % 3 + 1
    target, open_, left = {}, set(size), sum(size.values())
    while True:
        shares = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if shares[s] > 3 * size[s]}
        if not over:
            target |= shares
            break
        for s in over:
            target[s] = 3 * size[s]
            left -= 3 * size[s]
        open_ -= over
    taken, largest = defaultdict(int), defaultdict(int)
    for x in got:
        assert x.source_size == size[x.source] and abs(x.target - target[x.source]) < 1e-6 * max(1, target[x.source]) and 0 <= x.taken <= 3 * x.size and x.taken == x.copies * x.size
        taken[x.source] += x.taken
        largest[x.source] = max(largest[x.source], x.size)
    assert len(got) == len(rows) and all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in size)
    assert sorted(map(repr, mixing.mix(df.repartition(3)).collect())) == sorted(map(repr, got))
    assert mixing.mix(df.limit(0)).collect() == []
    # Ranked by random odds over inclusion odds: longer documents are taken more often than shorter ones of their source.
    own = spark.createDataFrame([(k, "w " * (400 if k % 2 else 25), "a" if k < 4000 else "b") for k in range(6000)], "doc_id long, text string, source string")
    many = [x for x in mixing.mix(own, weights=(1, 8)).collect() if x.source == "a"]
    share = {n: sum(x.copies for x in many if x.size == n) / sum(x.size == n for x in many) for n in (25, 400)}
    odds = {n: p / (1 - p) for n, p in share.items()}
    assert 2.8 < odds[400] / odds[25] < 5.6  # (400 / 25) ** 0.5 is 4
    alike = spark.createDataFrame([(5, "one two three", "a")] * 900 + [(6, "w " * 3000, "b")] * 2, "doc_id long, text string, source string").repartition(7)
    assert abs(sum(x.taken for x in mixing.mix(alike, weights=(1, 2)).collect() if x.source == "a") - 2900) <= 1.5


def test_shards(spark):
    r = random.Random(3)
    rows = [(k, "".join(r.choice("ab é") for _ in range(r.choice([5, 50, 700]))), r.choice(["en", "de", None]), f"src{r.randrange(5)}") for k in range(1500)]
    rows += [(5000 + k, "the same text " * 4, "en", f"src{k % 9}") for k in range(200)] + [(None, None, None, None), (1, "", "en", "src0"), (1, "", "en", "src0")]
    df = spark.createDataFrame([(*x, 0) for x in rows], "doc_id long, text string, lang string, source string, h int").repartition(6)
    got = sharding.shard(df, 8).collect()
    size, slots, group = defaultdict(int), defaultdict(list), defaultdict(set)
    for x in got:
        size[x.shard] += x.size
        slots[x.shard].append(x.slot)
        group[x.text_crc32, x.size].add(x.shard)
    assert len(got) == len(rows) and set(size) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(g) == 1 for g in group.values()) and max(size.values()) < 1.1 * sum(size.values()) / 8 and min(size.values()) > 0.9 * sum(size.values()) / 8
    assert sharding.shard(df.limit(0)).collect() == []
    one = sharding.shard(spark.createDataFrame([(k, "same", "en", "s") for k in range(20)], "doc_id long, text string, lang string, source string")).collect()
    assert len({x.shard for x in one}) == 1 and sorted(x.slot for x in one) == list(range(20))


def plain_tree(groups, shards, ranges=None, first=0):
    """The shard of each (coordinates, hash, weight) by a k-d tree in the plainest way."""
    if shards == 1 or not groups:
        return {g: first for g in groups}
    dims = range(len(groups[0][0]))
    width = [max(g[0][d] for g in groups) - min(g[0][d] for g in groups) for d in dims]
    ranges = ranges or [w or 1.0 for w in width]
    dim = max(dims, key=lambda d: width[d] / ranges[d])
    order = sorted(groups, key=lambda g: (g[0][dim], g[1]))
    goal, before, cut = sum(g[2] for g in groups) * (shards // 2) / shards, 0, 0
    while cut < len(order) and before + order[cut][2] < goal:
        before += order[cut][2]
        cut += 1
    if cut < len(order) and before + order[cut][2] - goal < goal - before:
        cut += 1
    return plain_tree(order[:cut], shards // 2, ranges, first) | plain_tree(order[cut:], shards - shards // 2, ranges, first + shards // 2)


def test_tree_against_a_plain_one(spark, monkeypatch):
    monkeypatch.setattr(sharding, "NEAR", 0.0)
    monkeypatch.setattr(sharding, "LEVEL_BINS", 256)
    r = random.Random(4)
    rows = {((float(r.choice([0, 0, 0, 1, 7])), r.choice([0.0, 1.0]), round(r.random() * 9, 2)), r.randrange(2**62), r.randrange(1, 50)) for _ in range(400)}
    df = spark.createDataFrame([(*c, h, w) for c, h, w in rows], "a double, b double, c double, h long, w long").repartition(5)
    for shards in (1, 7):
        got, _ = sharding.split_tree(df, ["a", "b", "c"], shards)
        assert {((x.a, x.b, x.c), x.h, x.w): x.shard for x in got.collect()} == plain_tree(list(rows), shards)


def test_sources_are_told_apart_to_the_last_character(spark):
    rows = [(k, f"text {k:05d}", "en", f"a_long_common_beginning_{'ab'[k % 2]}") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    got = {x.doc_id: x.shard for x in sharding.shard(df, 2).collect()}
    assert len({got[k] for k in range(0, 400, 2)}) == 1 and len(set(got.values())) == 2
    assert max(x.shard for x in sharding.shard(df, target=500).collect()) == -(-400 * 11 // 500) - 1


def test_blocks_of_queries_are_searched_together(monkeypatch):
    """Ties, own ids, few candidates and values beyond single precision, block by block; each level is one product for all queries."""
    r = np.random.default_rng(3)
    x = np.floor(40 * r.normal(size=(700, 12)))
    x[::7] = x[0]
    x[600:, 0] *= 2.0**20
    ids = np.r_[np.arange(699), topk.NONE]
    queries, own = np.vstack([x[::9], np.zeros((1, 12)), x[640:641] * 2.0**30]), np.r_[ids[::9], 9999, 640]
    seen, resolved = [], topk._resolved
    monkeypatch.setattr(topk, "_resolved", lambda lists, best, x, at, *rest: seen.append((len(at), x.dtype)) or resolved(lists, best, x, at, *rest))
    for few, kind in ((67, np.float32), (len(queries), np.float64)):
        own_, asked, want = own[:few], queries[:few], []
        best = topk.Best(own_, asked, 5)
        for a in range(0, 600 if few == 67 else 700, 200):
            topk.search(topk.Lists(ids[a : a + 200], x[a : a + 200]), best)
        for k, (o, q) in enumerate(zip(own_.tolist(), asked, strict=True)):
            scores = sorted((-max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(q, y)))), i) for i, y in zip(ids[:a + 200].tolist(), x) if o == topk.NONE or i != o)
            want += [(k, -s, i) for s, i in scores[:5]]
        assert list(zip(best.at.tolist(), best.score.tolist(), best.id.tolist())) == want
        assert len(seen) <= 4 * 8 < few and np.dtype(kind) in {d for _, d in seen}
        seen.clear()
