import random

import pytest
import xxhash

from noticeflow.llm import simhash


def brute(rows, n=3, bits=2):
    def fp(text):
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))] if words else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in parts]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits and group[i] != group[j]:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    low = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in set(group)}
    return sorted(((rows[k][0], f"{fps[k]:016x}", low[group[k]]) for k in range(len(rows))), key=repr)


def test_against_brute_force(spark):
    r = random.Random(3)
    base = [" ".join(r.choice("abcdefgh") * r.randint(1, 4) for _ in range(60)) for _ in range(12)]
    rows = []
    for k in range(150):
        words = r.choice(base).split(" ")
        for _ in range(r.choice([0, 0, 1, 2])):
            words[r.randrange(len(words))] = r.choice(["zz", "YY", "x\ty", "Éa"])
        rows.append((500 - k, " ".join(words)))
    rows += [(9001, None), (9000, ""), (9002, " \n\t "), (9003, "one"), (9004, "One two"), (None, "one"), (7, rows[0][1]), (7, rows[0][1])]
    rows.append((9999, "word " * 70000))
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, fp string, root string")
    got = simhash.near_duplicates(docs)
    assert sorted(((x.doc_id, x.fingerprint, x.component_id) for x in got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("large", [simhash.LARGE, 3])
def test_links_find_all_components_of_a_large_group(spark, monkeypatch, large):
    monkeypatch.setattr(simhash, "LARGE", large)
    r = random.Random(5)
    centre = r.getrandbits(64)
    fps = {centre}
    for _ in range(400):  # chains away from the centre, two bits at a time
        x = r.choice(list(fps))
        fps.add(x ^ (1 << r.randrange(64)) ^ (1 << r.randrange(64)))
    fps |= {r.getrandbits(64) for _ in range(50)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    for bits in (1, 2, 5):
        links = simhash.links(spark.createDataFrame([(signed(x),) for x in fps], "fp long"), bits)
        got = {frozenset((x.a & (2**64 - 1), x.b & (2**64 - 1))) for x in links.collect()}
        parent = {x: x for x in fps}

        def root(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in map(tuple, got):
            assert (a ^ b).bit_count() <= bits
            parent[root(a)] = root(b)
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= bits:
                    assert root(a) == root(b)


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
