import random
import re
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from noticeflow.llm import audit

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = [f"w{k}" for k in range(80)]


def fails(rows):
    """The set of failed filters of each row, straight from the rules."""
    out = []
    for doc, text, _ in rows:
        t = text or ""
        w = WORDS.findall(t)
        own = {f for f, c in {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search(r"[#$%&*|]", t))}.items() if c}
        if doc is not None and any(d is not None and d < doc and (x or "") == t for d, x, _ in rows):
            own.add("E")
        out.append(own)
    return out


def brute(rows, labels):
    found, out = fails(rows), set()
    for part in {s or "" for _, _, s in rows}:
        own = [(f, labels.get(d, (0, 0))) for f, (d, _, s) in zip(found, rows, strict=True) if (s or "") == part]
        orders = ["".join(p) for p in permutations("ABCDE")]
        first = {f: sum(next((x for x in o if x in fs), None) == f for o in orders for fs, _ in own) for f in "ABCDE"}
        for o in orders:
            alive = own
            for k, f in enumerate(o):
                gone = [(fs, lab) for fs, lab in alive if f in fs]
                early = sum(f in fs and bool(fs & set(o[:k])) for fs, _ in own)
                alive = [(fs, lab) for fs, lab in alive if f not in fs]
                out.add((part, o, k + 1, len(alive), len(gone), early, sum(fs == {f} for fs, _ in own), sum(lab[0] == 1 for _, lab in gone), sum(lab[1] == 1 for _, lab in gone), first[f]))
    return out


def made(n=400, seed=4):
    r = random.Random(seed)
    texts = [None, "", " ", "short", "short ", "SHORT", " ".join(PLAIN), " ".join(PLAIN) + "\x0b", " ".join(PLAIN[:20] * 4), " ".join(PLAIN) + " #", "É" * 70, "x" * 64 + "a" * 1000 + "b", "x" * 64 + "a" * 1000 + "c", "y" * 2000, "\x1c " * 60]
    rows = [(k, r.choice([*texts, f"unlike {k}"]), r.choice([None, "", "s1", "s2"])) for k in range(n)]
    return rows + [rows[5], rows[6], (None, "short", "s1"), (None, None, None)]


def frames(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    return docs, spark.createDataFrame([(d, *x) for d, x in labels.items()], "doc_id long, quality int, toxic int")


def test_every_order_is_that_of_the_rules(spark):
    rows = made()
    labels = {k: (k % 2, k % 3 % 2) for k in range(0, 300, 2)}
    docs, known = frames(spark, rows, labels)
    got = {tuple(r) for r in audit.interactions(docs.selectExpr("*", "1 as mask", "'x' as part", "2 as size", "3 as n"), known.union(known.where("doc_id is null"))).collect()}
    want = brute(rows, labels)
    assert len(want) == 600 * 3 and got == want


@pytest.mark.parametrize("hashed", [lambda c: F.lit(7).cast("long"), lambda c: F.length(c).cast("long")])
def test_texts_decide_where_hashes_clash(spark, hashed):
    rows = made(150, seed=6)
    docs, _ = frames(spark, rows, {0: (0, 0)})
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    keys = audit.block_keys(F.col("text"), hashed)
    table = docs.select("doc_id", F.col("source").alias("part"), *[c.alias(k) for k, c in keys.items()])
    got = sorted(r[0] for r in audit.duplicates(docs, table, keys).select("doc_id").collect())
    assert got == sorted(d for (d, _, _), f in zip(rows, fails(rows), strict=True) if "E" in f)


def test_edges(spark):
    docs, labels = frames(spark, [], {})
    assert audit.interactions(docs, labels).collect() == []
    docs, labels = frames(spark, [(1, "a", "s")], {})
    assert audit.interactions(docs, labels).count() == 600
    twice = spark.createDataFrame([(1, 1, None), (1, 0, 1)], "doc_id long, quality int, toxic int")
    row = audit.interactions(docs, twice).where("filter_order = 'ABCDE' and step = 1").first()
    assert (row.removed, row.good_lost, row.toxic_lost, row.shapley) == (1, 1, 1, 120)
