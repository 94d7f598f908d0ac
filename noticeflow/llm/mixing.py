"""Mixing sources to target weights by Pareto order sampling.

A source's target over its size is how often each of its documents is wanted. The whole part are certain copies. The rest is an
unequal-probability sample: a document's inclusion odds are in proportion to its size to the power of `favour`, by one factor
for each source. Documents are ranked by their random odds u / (1 - u) over their inclusion odds and taken in that order until
the words left to the target are reached, a sample of fixed size in words; the source's factor, the same for all of its
documents, changes no rank. u comes from a hash of doc_id, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Steps of the logarithm of the odds ratio: a coarse one, and a fine one within the coarse step that holds the cut.
COARSE, FINE = 64, 4096
#: Stands for a null doc_id where documents are put in order.
FIRST = -(2**63)


def sizes(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): words of the whole text, 0 for null."""
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(common.WORD))
    return docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), words.cast("long").alias("size"))


def targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, take the weights in turn and share the sum of all sizes. Where a share exceeds `most`
    times its source's size, it stops there and the excess is shared again by weight: with the sources by source_size /
    weight, the first ones stop, and from the first that doesn't all get the same for each unit of weight. One row for each
    source is put in order by one task.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    named = sources.withColumn("w", w).withColumn("full", most * F.col("source_size") / F.col("w"))
    before = Window.orderBy("full", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = named.select(
        "*",
        (F.sum("source_size").over(whole) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left"),
        (F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))).alias("wl"),
    ).withColumn("level", F.col("left") / F.col("wl"))
    free = F.min(F.when(F.col("full") >= F.col("level"), F.struct("full", "level"))).over(whole)["level"]
    return level.withColumn("free", free).select(
        "source", "source_size",
        F.when(F.col("full") <= F.col("free"), most * F.col("source_size").cast("double")).otherwise(F.col("w") * F.col("free")).alias("target"),
    )


def uniform(doc_id: Column) -> Column:
    """A number within (0, 1) from 52 bits of the MD5 of doc_id; a null doc_id counts as -."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("-")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, favour: float = 0.5) -> DataFrame:
    """(doc_id, size, source, source_size, target, copies, taken): how often each document is in the mix.

    taken = copies * size. Within each source, taken words differ from the target by half a document at most. A null source
    is a source of its own. Documents without words are taken 0 times over and above the certain copies. Repeated rows
    count each by itself; of those alike in (doc_id, size) any may be the ones taken. An empty table gives no rows.

    The place of the cut in a source comes from sums by steps of the rank, first coarse, then fine within one coarse step;
    only the different (doc_id, size) of one fine step (a millionth of a source) are put in order by one task.
    """
    slim = common.stored(sizes(docs))
    goal = common.stored(targets(slim.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = (
        goal.withColumn("rate", rate).withColumn("sure", F.floor("rate").cast("long"))
        .withColumn("p", F.col("rate") - F.col("sure"))
        .withColumn("rest", F.col("target") - F.col("sure") * F.col("source_size"))
        .withColumnRenamed("source", "s")
    )
    u = uniform(F.col("doc_id"))
    ranked = (
        slim.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        .withColumn("z", F.log(u) - F.log(1 - u) - favour * F.log(F.greatest("size", F.lit(1)).cast("double")))
        .withColumn("coarse", F.floor(F.col("z") * COARSE))
        .withColumn("fine", F.floor((F.col("z") * COARSE - F.col("coarse")) * FINE))
        .withColumn("here", F.struct("z", F.coalesce("doc_id", F.lit(FIRST)).alias("doc_id"), "size"))
    )
    open_ = ranked.where("p > 0 and size > 0")
    first = _cut(open_.groupBy("source", "coarse").agg(F.sum("size").alias("n"), F.first("rest").alias("rest")), "coarse")
    first = first.select(F.col("source").alias("s1"), F.col("at").alias("at1"), F.col("before").alias("before1"))
    inside = open_.join(first, F.col("source").eqNullSafe(F.col("s1")) & (F.col("coarse") == F.col("at1")))
    alike = inside.groupBy("source", "fine", "here").agg(F.count("*").alias("c"), F.first(F.col("rest") - F.col("before1")).alias("rest"))
    alike = common.stored(alike.withColumn("n", F.col("c") * F.col("here.size")))
    second = _cut(alike.groupBy("source", "fine").agg(F.sum("n").alias("n"), F.first("rest").alias("rest")), "fine")
    second = second.select(F.col("source").alias("s2"), F.col("at").alias("at2"), F.col("before").alias("before2"))
    last = alike.join(second, F.col("source").eqNullSafe(F.col("s2")) & (F.col("fine") == F.col("at2")))
    order = Window.partitionBy("source").orderBy("here").rowsBetween(Window.unboundedPreceding, -1)
    room = (F.col("rest") - F.col("before2") - F.coalesce(F.sum("n").over(order), F.lit(0))) / F.col("here.size")
    last = last.withColumn("m", F.least(F.floor(room + 0.5), F.col("c"))).where("m > 0")
    # The last documents taken of each source, and how many of those alike; where none of the fine step is, all before that step.
    ends = last.groupBy("source").agg(F.max(F.struct("here", "m", "c")).alias("end")).withColumnRenamed("source", "s3")
    cuts = common.stored(
        first.join(second, F.col("s1").eqNullSafe(F.col("s2")), "left").join(ends, F.col("s1").eqNullSafe(F.col("s3")), "left")
        .select(F.col("s1").alias("cs"), "at1", "at2", F.col("end.here").alias("end"), F.when(F.col("end.m") < F.col("end.c"), F.col("end.m")).alias("some"))
    )
    in_step = F.col("end").isNotNull() & (F.col("fine") == F.col("at2"))
    within = F.when(in_step, F.col("here") <= F.col("end")).otherwise(F.col("fine") < F.coalesce("at2", F.lit(FINE + 1)))
    taken = F.coalesce(F.when(F.col("coarse") == F.col("at1"), within).otherwise(F.col("coarse") < F.col("at1")), F.lit(True))
    placed = ranked.join(cuts, F.col("source").eqNullSafe(F.col("cs")), "left").withColumn("extra", F.col("p").isNotNull() & (F.col("p") > 0) & (F.col("size") > 0) & taken)
    edge = F.coalesce(F.col("some").isNotNull() & (F.col("here") == F.col("end")), F.lit(False))
    kept = ["doc_id", "size", "source", "source_size", "target", "sure", "extra"]
    some = common.numbered(placed.where(edge).select(*kept, "some", F.xxhash64(F.col("source").isNull(), "source").alias("grp")), "grp", "nr")
    out = placed.where(~edge).select(*kept).union(some.withColumn("extra", F.col("nr") < F.col("some")).select(*kept))
    out = out.withColumn("copies", F.col("sure") + F.col("extra").cast("int"))
    return out.select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _cut(steps: DataFrame, step: str) -> DataFrame:
    """(source, at, before): the step of each source in which the running sum of n passes `rest`, and the sum before it."""
    order = Window.partitionBy("source").orderBy(step).rowsBetween(Window.unboundedPreceding, 0)
    run = steps.withColumn("upto", F.sum("n").over(order)).where(F.col("upto") > F.col("rest"))
    low = run.groupBy("source").agg(F.min(F.struct(F.col(step).alias("at"), (F.col("upto") - F.col("n")).alias("before"))).alias("x"))
    return low.select("source", "x.at", "x.before")
