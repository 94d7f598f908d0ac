"""Filter interaction audit: what each of five filters removes, in every order, and what another one would have removed anyway.

Duplicates are found by partition refinement: texts are split by their length in code points, then by the hash of one block after
the other; texts that are alone in their class go after each split. The full texts of those that are left are compared. What
each row fails is a mask; all orders are worked out from the counts of masks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

FILTERS = "ABCDE"
#: Where blocks of a text end, in code points; the last one has all that is left.
BLOCKS = (64, 1024, None)


def quality_mask(docs: DataFrame, words: int = 50, distinct: int = 65, capitals: int = 5, marks: str = "#$%&*|") -> DataFrame:
    """Adds mask to rows with a text that is not null: 1 for too few words, 2 for too few different ones (percent), 4 for too many
    capitals (percent of the code points), 8 for any of the marks."""
    bare = F.btrim("text", F.lit(" \t\n\x0b\x0c\r"))
    found = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    without = lambda letters: F.length("text") - F.length(F.translate("text", letters, ""))
    counted = docs.withColumns({"n_": F.size(found), "d_": F.size(F.array_distinct(found)), "caps_": without("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "marks_": without(marks), "size_": F.length("text")})
    fails = [F.col("n_") < words, 100 * F.col("d_") < distinct * F.col("n_"), 100 * F.col("caps_") > capitals * F.col("size_"), F.col("marks_") > 0]
    return counted.withColumn("mask", sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))).drop("n_", "d_", "caps_", "marks_", "size_")


def block_keys(text: Column, hashed: Callable[[Column], Column] = F.xxhash64, blocks: Sequence[int | None] = BLOCKS) -> dict[str, Column]:
    """The length of a text and the hash of each block; a block beyond the text's end is empty."""
    ends = [0, *blocks]
    cut = [F.substring(text, a + 1, (b or (1 << 31) - 1) - a) for a, b in zip(ends, ends[1:], strict=False)]
    return {"size": F.length(text), **{f"block{k}": hashed(c) for k, c in enumerate(cut)}}


def duplicates(docs: DataFrame, rows: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """Those of `rows` (doc_id, the columns of `keys` and any others) whose whole text a smaller doc_id of `docs` has as well.

    A null doc_id is no duplicate and makes none; rows of the same doc_id aren't duplicates of each other. Each split counts the
    rows of its classes (combined on the map side) and drops classes of one; only numbers are shuffled for it. The texts of what is
    left are read once more and grouped as they are, so that no hash decides; where hashes clash, rows are told apart by their texts.
    """
    names: list[str] = []
    left = rows.where("doc_id is not null")
    for name in keys:
        names.append(name)
        left = left.join(left.groupBy(*names).agg(F.count("*").alias("n")).where("n > 1").select(*names), names, "left_semi")
    left = common.stored(left)
    ident = F.xxhash64(*names)
    again = docs.where("doc_id is not null").select("doc_id", "text", *[c.alias(k) for k, c in keys.items()]).withColumn("h", ident)
    texts = common.maybe_in(again, "h", common.bitmap(left.select(ident).distinct()), "likely").where("likely")
    first = common.stored(texts.groupBy(*names, "text").agg(F.min("doc_id").alias("least")))
    classes = first.groupBy(*names).agg(F.count("*").alias("texts"), F.min("least").alias("least"))
    later = F.col("doc_id") > F.col("least")
    found = left.join(classes.where("texts = 1").select(*names, "least"), names).where(later).select(*rows.columns)
    mixed = classes.where("texts > 1").select(*names)
    if not mixed.limit(1).count():
        return found
    apart = docs.select("doc_id", "text").distinct().join(first.join(mixed, names).select("text", "least"), "text").where(later).select("doc_id", *[c.alias(k) for k, c in keys.items()])
    return found.union(left.join(apart, ["doc_id", *names], "left_semi").select(*rows.columns))


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every part of `docs`
    (its source; null: the empty string), every order of the five filters and every step, zeros included.

    Filters: A under 50 words, B under 65 % different words, C over 5 % capitals, D any of #$%&*|, E the text of a smaller doc_id.
    Words are maximal runs without white space. A null text is empty: it fails A and, from the second doc_id on, E. good_lost and
    toxic_lost count rows whose doc_id `labels` marks; of several labels of a doc_id any counts. Repeated rows count each. An
    empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    keys = block_keys(F.col("text"))
    seen = common.stored(quality_mask(whole).select("doc_id", "part", "mask", *[c.alias(k) for k, c in keys.items()]))
    marked = common.stored(duplicates(whole, seen, keys))
    # a row that E marks leaves the mask without E and joins the one with it
    moved = seen.select("doc_id", "part", "mask", F.lit(1).alias("w")).union(marked.select("doc_id", "part", "mask", F.lit(-1))).union(marked.select("doc_id", "part", F.col("mask") + 16, F.lit(1)))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    labelled = moved.join(marks.where("good = 1 or toxic = 1"), "doc_id")
    zero = F.lit(0).cast("long")
    counts = moved.groupBy("part", "mask").agg(F.sum("w").alias("n"), zero.alias("good"), zero.alias("toxic")).union(
        labelled.groupBy("part", "mask").agg(zero, F.sum(F.col("w") * F.coalesce("good", F.lit(0))), F.sum(F.col("w") * F.coalesce("toxic", F.lit(0))))
    )
    return orders(counts)


def orders(counts: DataFrame) -> DataFrame:
    """Every order and step from the counts (part, mask, n, good, toxic) of rows by what they fail; masks may repeat."""
    every = [("".join(p), k) for p in permutations(FILTERS) for k in range(len(FILTERS))]
    bits = {f: 1 << k for k, f in enumerate(FILTERS)}
    steps = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(k + 1).alias("s"), F.lit(bits[o[k]]).alias("own"), F.lit(sum(bits[f] for f in o[:k])).alias("before")) for o, k in every])
    each = counts.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")]).withColumn("x", F.explode(steps))
    own, before = F.col("mask").bitwiseAND(F.col("x.own")) > 0, F.col("mask").bitwiseAND(F.col("x.before")) > 0
    sums = {
        "kept": (~own & ~before, "n"), "removed": (own & ~before, "n"), "redundant": (own & before, "n"), "unique_fails": (F.col("mask") == F.col("x.own"), "n"),
        "good_lost": (own & ~before, "good"), "toxic_lost": (own & ~before, "toxic"),
    }
    share = F.when(own, (F.col("n") * 120 / F.bit_count("mask")).cast("long")).otherwise(0)  # of all orders, those in which this filter comes first of those that it fails
    return each.groupBy("part", F.col("x.o").alias("filter_order"), F.col("x.s").alias("step")).agg(
        *[F.sum(F.when(c, F.col(v)).otherwise(0)).alias(k) for k, (c, v) in sums.items()], F.sum(share).alias("shapley"),
    )
