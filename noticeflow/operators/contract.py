"""Operators whose rules are prose: regions, overdue records, statuses, attachments, matches, brands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T
from ..functions import time as D
from ..functions.url import absolute, links
from ..functions.variant import bound


def region_table(spark) -> DataFrame:
    return spark.createDataFrame([(p, r) for r, ps in rules.REGION_PROVINCES.items() for p in ps], "province string, region string")


def with_region(df: DataFrame, province: str, table: DataFrame, default: str = rules.NO_REGION) -> DataFrame:
    """Adds region by province; `default` where there is none. A province is in `table` once."""
    j = df.join(table.select(F.col("province").alias("_p"), "region"), F.col(province) == F.col("_p"), "left").drop("_p")
    return j.withColumn("region", F.coalesce("region", F.lit(default)))


def close_overdue(seen: DataFrame, as_of: Column) -> DataFrame:
    """Updates for active records whose deadline has passed: closed, all other fields as they are."""
    late = seen.where(D.overdue(F.col("status"), F.col("deadline"), as_of))
    fields = [F.lit("closed").alias(f) if f == "status" else F.lit("status_change").alias(f) if f == "change_type" else F.col(f) for f in rules.UPDATE_FIELDS]
    return late.select(*fields)


def status_of(notice_type: Column, deadline: Column, as_of: Column, intel: Sequence[str] = rules.INTEL_NOTICES) -> Column:
    """intel for notices that are no tender or whose deadline has passed, else active."""
    return F.when(T.has_any(notice_type, intel), "intel").when(F.coalesce(D.deadline(deadline) < as_of, F.lit(False)), "intel").otherwise("active")


def change_of(title: Column, new_deadline: Column, old_deadline: Column) -> Column:
    """(change_type, status) of an update: an award closes, a failure cancels, else a new deadline or a correction."""
    award, failed = T.has_any(title, ("中标", "成交", "合同公告")), T.has_any(title, ("废标", "流标", "终止", "撤销"))
    moved = F.coalesce((new_deadline != "null") & ~new_deadline.eqNullSafe(old_deadline), F.lit(False))
    kind = F.when(award | failed, "status_change").when(moved, "deadline_change").otherwise("correction")
    return F.struct(kind.alias("change_type"), F.when(failed, "canceled").when(award, "closed").alias("status"))


def attachments(
    pages: DataFrame, types: Sequence[str] | None = rules.ATTACHMENT_TYPES, first: Sequence[str] = rules.ATTACHMENT_ORDER, sizes: DataFrame | None = None
) -> DataFrame:
    """(page_id, ord, url, main): each link of the types by its extension, completed to an absolute URL.

    main is the first whose URL holds one of the words of `first`, in their order; else the largest by `sizes` (url, length; the
    length is added then, null where it isn't known); else the first of all.
    """
    each = pages.select("page_id", F.col("url").alias("_page"), F.posexplode(links(F.col("html"), tuple(types) if types else None)).alias("ord", "_href"))
    full = each.select("page_id", "ord", absolute(F.col("_href"), F.col("_page")).alias("url"))
    decoded = F.coalesce(F.try_url_decode("url"), F.col("url"))
    rank = F.coalesce(*[F.when(F.contains(decoded, F.lit(w)), F.lit(k)) for k, w in enumerate(first)], F.lit(len(first)))
    if sizes is not None:
        known = sizes.groupBy(F.col("url").alias("_at")).agg(F.max("length").alias("length"))
        full = full.join(known, F.col("url") == F.col("_at"), "left").drop("_at")
    largest = [F.when(rank == len(first), F.col("length")).desc_nulls_last()] if sizes is not None else []
    best = F.row_number().over(Window.partitionBy("page_id").orderBy(rank, *largest, "ord")) == 1
    return full.withColumn("main", best)


def best_category(matched: Column, text: Column, order: Sequence[str] = rules.MATCHED_CATEGORIES, generic: Sequence[str] = rules.GENERIC_WORDS) -> Column:
    """(matched_category, category, match_level, others) from all matched categories: the first in `order`, others for notes.

    A product named as such makes the match full, or partial where the notice also buys under a generic name; without one the
    level is unknown, whatever the generic name suggests.
    """
    ranked = F.array_compact(F.array(*[F.when(F.array_contains(matched, c), F.lit(c)) for c in order]))
    top = F.when(F.size(ranked) > 0, ranked[0]).otherwise(F.lit("其他"))
    kinds = F.create_map(*[F.lit(x) for pair in rules.CATEGORY_OF.items() for x in pair])
    level = F.when(F.size(ranked) == 0, "unknown").when(T.has_any(text, generic), "partial").otherwise("full")
    return F.struct(top.alias("matched_category"), kinds[top].alias("category"), level.alias("match_level"), F.array_except(ranked, F.array(top)).alias("others"))


def tags(text: Column, own: Sequence[str], others: Sequence[str], methods: Sequence[str] = rules.METHOD_WORDS, doubtful: Sequence[str] = rules.PRESCREEN_WORDS) -> Column:
    """Own and other brands and methods that a notice names, and whether its words make it doubtful (a flag, no filter); the text
    is read once for all of them."""
    found = T.Found([*own, *others, *methods, *doubtful])
    return bound(found.scan(text), lambda seen: F.struct(
        *[T.words_seen(text, words, found, seen).alias(n) for n, words in (("own_brands", own), ("other_brands", others), ("methods", methods))], found.any_of(seen, doubtful).alias("doubtful"),
    ))


def masked_defaults(records: DataFrame) -> DataFrame:
    """Fields that a third party's page hides get their fixed values; other missing ones are the string null, 0 or false."""
    fixed = {"purchaser": rules.MASKED_PURCHASER, "region": rules.NO_REGION}
    return records.select(*[
        F.coalesce(c, F.lit(0) if c in rules.NUMBER_FIELDS else F.lit(False) if c in rules.BOOL_FIELDS else F.lit(fixed.get(c, "null"))).alias(c) if c in rules.CREATE_FIELDS else F.col(c)
        for c in records.columns
    ])
