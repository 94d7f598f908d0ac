"""Sharding by a k-d tree: split at weighted medians along the widest metadata dimension until leaves reach the target bytes.

Equal texts form one group that stays together. A group's coordinates are the smallest of its rows, its weight their bytes.
Each level of the tree takes a few aggregations over the groups for all of its nodes at once: histograms of bytes narrow down
the median, along the dimension first and then, among groups at the same place, along a hash, so that a crowded place is
split as well. What is known of a level's nodes is a small table that is joined to the groups.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Bins of all histograms of a level at most and of one, and the share of a node's bytes that a cut may be off without a finer one.
LEVEL_BINS, BINS, NEAR = 1 << 16, 8192, 0.0002
#: Levels between two that are written down, and names (of sources, languages) up to which their ranks are broadcast.
WRITTEN, FEW_NAMES = 4, 200_000
#: Ends of the hashes: from 0 to below this.
SPAN = 2**62
#: Parts that a join on a name is dealt to where there are too many names to broadcast.
SALTS = 64


def ranked(df: DataFrame, column: str, name: str) -> DataFrame:
    """Adds `name`: the place of the string in `column` among all of them by code point, as a double; null is -1.

    The different strings are put in order by ranges, so that no task sees all of them.
    """
    names = df.select(F.col(column).alias("_name")).where("_name is not null").distinct().withColumn("_one", F.lit(0).cast("long"))
    order = common.stored(common.numbered(names.repartitionByRange("_name").sortWithinPartitions("_name"), "_one", "_rank").select("_name", "_rank"))
    if order.count() <= FEW_NAMES:
        out = df.join(F.broadcast(order), F.col(column) == F.col("_name"), "left")
    else:
        salted = order.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = df.withColumn("_own", F.pmod(F.xxhash64("h"), F.lit(SALTS)).cast("int"))
        out = own.join(salted, (F.col(column) == F.col("_name")) & (F.col("_own") == F.col("_salt")), "left").drop("_own", "_salt")
    return out.withColumn(name, F.coalesce(F.col("_rank").cast("double"), F.lit(-1.0))).drop("_name", "_rank", column)


def split_tree(groups: DataFrame, dims: list[str], shards: int) -> tuple[DataFrame, list[dict]]:
    """`groups` (dims, h, w, others) with the shard of each row, and the cuts made.

    h is a hash in [0, 2^62), w the weight. A node of k shards is cut where k // 2 of them end, along the dimension that is
    widest there in relation to its range over all groups. The driver holds LEVEL_BINS numbers, or 16 for each node if more.
    """
    spark = groups.sparkSession
    now = groups.withColumn("node", F.lit(1).cast("long"))
    left, shard_of, cuts, ranges, level = {1: shards}, {1: 0}, [], {}, 0
    at = F.array(*[F.col(d) for d in dims])
    while any(k > 1 for k in left.values()):
        found = now.groupBy("node").agg(F.sum("w").alias("w"), *[f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))])
        stats = {r["node"]: r.asDict() for r in found.collect()}  # one row for each node
        if not ranges:
            ranges = {d: (stats[1][f"hi_{d}"] - stats[1][f"lo_{d}"] if 1 in stats else 0) or 1.0 for d in dims}
        todo = {n: _node(stats.get(n), dims, ranges, k) for n, k in left.items() if k > 1}
        _narrow(now.withColumn("at", at), todo)
        after, shard_after = {}, {}
        for n, k in left.items():
            parts = ((2 * n, k // 2, 0), (2 * n + 1, k - k // 2, k // 2)) if k > 1 else ((2 * n, 1, 0),)
            for child, own, before in parts:
                after[child], shard_after[child] = own, shard_of[n] + before
            if k > 1:
                cuts.append({"node": n, "dim": dims[todo[n]["dim"]], "value": todo[n]["value"], "hash": todo[n]["hash"]})
        cut = todo.values()
        table = common.small(spark, {"node": (pa.int64(), list(todo)), "_dim": (pa.int32(), [t["dim"] for t in cut]), "_value": (pa.float64(), [t["value"] for t in cut]), "_hash": (pa.int64(), [t["hash"] for t in cut])})
        v = at[F.col("_dim")]
        right = F.coalesce((v > F.col("_value")) | ((v == F.col("_value")) & (F.col("h") >= F.col("_hash"))), F.lit(False))
        now = now.join(table, "node", "left").withColumn("node", 2 * F.col("node") + right.cast("long")).drop("_dim", "_value", "_hash")
        left, shard_of, level = after, shard_after, level + 1
        if level % WRITTEN == 0:
            now = common.stored(now)
    table = common.small(spark, {"node": (pa.int64(), list(shard_of)), "shard": (pa.int32(), list(shard_of.values()))})
    return now.join(table, "node").drop("node"), cuts


def _node(s: dict | None, dims: list[str], ranges: dict[str, float], k: int) -> dict:
    if s is None:  # nothing in it: its shards stay empty
        return {"dim": 0, "value": 0.0, "hash": 0, "done": True}
    dim = max(range(len(dims)), key=lambda d: (s[f"hi_{dims[d]}"] - s[f"lo_{dims[d]}"]) / ranges[dims[d]])
    return {"dim": dim, "goal": s["w"] * (k // 2) / k, "w": s["w"], "before": 0, "lo": s[f"lo_{dims[dim]}"], "hi": s[f"hi_{dims[dim]}"], "value": None, "hash": 0, "span": SPAN, "done": False}


def _narrow(groups: DataFrame, todo: dict[int, dict]) -> None:
    """Finds where the weight before the cut is nearest to each node's goal: a value, and a hash among those that have it."""
    spark = groups.sparkSession
    while work := {n: t for n, t in todo.items() if not t["done"]}:
        many = max(16, min(BINS, LEVEL_BINS // len(work)))
        for t in work.values():
            t["width"] = (t["hi"] - t["lo"]) / many if t["value"] is None else 0.0
            t["step"] = max(1, -(-t["span"] // many))
        kinds = {"dim": pa.int32(), **dict.fromkeys(("value", "lo", "hi", "width"), pa.float64()), **dict.fromkeys(("hash", "span", "step"), pa.int64())}
        table = common.small(spark, {"node": (pa.int64(), list(work)), **{c: (k, [t[c] for t in work.values()]) for c, k in kinds.items()}})
        here = groups.select("node", "at", "h", "w").join(table, "node").withColumn("v", F.col("at")[F.col("dim")])
        along = F.col("value").isNull()
        inside = F.when(along, F.col("v").between(F.col("lo"), F.col("hi"))).otherwise((F.col("v") == F.col("value")) & (F.col("h") >= F.col("hash")) & (F.col("h") - F.col("hash") < F.col("span")))
        place = F.when(F.col("width") > 0, F.least(F.floor((F.col("v") - F.col("lo")) / F.col("width")), F.lit(many - 1))).otherwise(F.lit(0).cast("long"))
        bin_ = F.when(along, place).otherwise(F.expr("(h - hash) div step")).cast("long")
        found = here.where(inside).groupBy("node", bin_.alias("bin")).agg(F.sum("w").alias("w"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
        bins: dict[int, list] = {}
        for b in sorted(found, key=lambda b: b["bin"]):
            bins.setdefault(b["node"], []).append(b)
        for n, t in work.items():
            _closer(t, bins.get(n, []))


def _closer(t: dict, bins: list) -> None:
    """Goes on in the bin in which the goal lies, or ends at one of its sides."""
    total = t["before"]
    for b in bins:
        if total + b["w"] >= t["goal"]:
            break
        total += b["w"]
    else:
        t.update(value=t["hi"] if t["value"] is None else t["value"], hash=SPAN, done=True)
        return
    near = min(abs(t["goal"] - total), abs(total + b["w"] - t["goal"])) <= NEAR * t["w"]
    upper = total + b["w"] - t["goal"] < t["goal"] - total
    t["before"] = total
    if t["value"] is not None:
        start = t["hash"] + b["bin"] * t["step"]
        if near or t["step"] == 1:
            t.update(hash=start + (t["step"] if upper else 0), done=True)
        else:
            t.update(hash=start, span=t["step"])
        return
    if near and not upper:
        t.update(value=b["lo"], hash=0, done=True)
    elif near and upper and b["lo"] < b["hi"]:
        t.update(value=b["hi"], hash=SPAN, done=True)
    elif near:
        t.update(value=b["lo"], hash=SPAN, done=True)
    elif b["lo"] == b["hi"] or (t["lo"], t["hi"]) == (b["lo"], b["hi"]):
        t["value"] = b["lo"]
    t["lo"], t["hi"] = b["lo"], b["hi"]


def shard(docs: DataFrame, shards: int | None = None, target: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; equal texts share a shard.

    There are `shards` shards, or as many as it takes for `target` bytes in each. The law is `bytes`: sizes (UTF-8 bytes of the
    text, null none, plus 1) are near equal over the shards, as far as groups of equal texts allow. Null and empty texts differ
    in no way and form one group. slot counts from 0 within a shard, in no given order. grown_shard is null. Null doc_ids and
    repeated rows stay; an empty table gives no rows. Dimensions are source and lang by their order among all of them, and the
    logarithm of size.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    slim = common.stored(docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.xxhash64(text).alias("th"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
    ))
    if shards is None:
        total = slim.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // (target or 1)))
    key = ["th", "text_crc32", "size"]
    groups = slim.groupBy(*key).agg(F.sum("size").alias("w"), F.min("source").alias("source"), F.min("lang").alias("lang"))
    groups = common.stored(groups.withColumn("size_at", F.log2(F.col("size").cast("double"))).withColumn("h", F.shiftrightunsigned(F.xxhash64("th", "text_crc32"), 2)))
    groups = common.stored(ranked(ranked(groups, "source", "source_at"), "lang", "lang_at"))
    placed, _ = split_tree(groups, ["source_at", "lang_at", "size_at"], shards)
    leaves = common.stored(placed.select(*key, F.col("shard").cast("long").alias("shard")))
    out = common.numbered(slim.join(leaves, key).select("doc_id", "size", "text_crc32", "shard"), "shard", "slot")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
