"""Hits of many queries to distinct candidates, with the queries that found each, and statistics by query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.url import normalize_url, strip

KEPT = ("title", "site_name", "publish_time", "auth_info_level", "auth_info_des", "rank_score", "summary", "content")


def successes(hits: DataFrame) -> DataFrame:
    """Rows of queries that didn't fail; an empty error is none."""
    return hits.where(F.coalesce(F.col("error"), F.lit("")) == "")


def dedup_hits(hits: DataFrame, normalized: bool = False) -> DataFrame:
    """One row for each trimmed URL: the first hit's fields by (query_no, pos), and all queries that found it, sorted.

    `ord` is the first hit's (query_no, pos) as one number. Hits with a blank URL go. `normalized` takes URLs that only
    differ in tracking parameters or trailing slashes as one, which the default does not.
    """
    url = strip(F.coalesce(F.col("url"), F.lit("")))
    key = normalize_url(url) if normalized else url
    kept = [c for c in KEPT if c in hits.columns]
    first = F.struct("query_no", "pos", url.alias("url"), *kept)
    rows = hits.where(url != "").groupBy(key.alias("_key")).agg(
        F.min_by(first, F.struct("query_no", "pos")).alias("f"), F.array_sort(F.collect_set("query_no")).alias("found_by_query")
    )
    order = (F.col("f.query_no").cast("long") * F.lit(1 << 32) + F.col("f.pos")).alias("ord")
    return rows.select(order, F.col("f.url").alias("url"), *[F.col(f"f.{c}").alias(c) for c in kept], "found_by_query")


def light_index(candidates: DataFrame) -> DataFrame:
    """The candidates without their full texts, with id, fingerprint, teaser and where the content lies."""
    ident = T.candidate_id(F.col("url"))
    return candidates.select(
        "ord", ident.alias("candidate_id"), "title", T.title_fingerprint(F.col("title")).alias("title_fingerprint"), "site_name", "url",
        "publish_time", "auth_info_level", "auth_info_des", "rank_score", "found_by_query",
        T.teaser(F.col("summary"), F.col("content")).alias("teaser"), F.concat(F.lit("content/"), ident, F.lit(".json")).alias("content_path"),
    )


def contents(candidates: DataFrame) -> DataFrame:
    return candidates.select(T.candidate_id(F.col("url")).alias("candidate_id"), "title", F.col("url").alias("source_url"), "summary", "content")


def query_stats(hits: DataFrame, candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_no, raw, unique, pushed) for every query: hits of any kind, and candidates that no other query found."""
    raw = hits.groupBy("query_no").agg(F.count("*").alias("raw"))
    alone = candidates.where(F.size("found_by_query") == 1).groupBy(F.col("found_by_query")[0].alias("query_no")).agg(F.count("*").alias("unique"))
    out = queries.select("query_no").distinct().join(raw, "query_no", "left").join(alone, "query_no", "left")
    return out.select("query_no", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("raw", "unique")], F.lit(0).cast("long").alias("pushed"))


def redundancy(stats: DataFrame) -> DataFrame:
    """Adds the share of each query's hits that others found as well, null without hits."""
    return stats.withColumn("redundancy", F.when(F.col("raw") > 0, 1 - F.col("unique") / F.col("raw")))


def contribution(stats: DataFrame) -> DataFrame:
    """(query_no, contributes): whether a query found what no other did, by number."""
    return stats.select("query_no", (F.col("unique") > 0).alias("contributes")).orderBy(F.col("query_no").cast("int"))


def failed() -> Column:
    return F.coalesce(F.col("error"), F.lit("")) != ""


def hit_counts() -> dict[str, Column]:
    """Aggregates of hits that can be observed while they are written: those of good queries, and failed queries, a row each."""
    return {"raw": F.count_if(~failed()), "query_failed": F.count_if(failed())}


def index_counts() -> dict[str, Column]:
    """Aggregates of an index likewise: candidates, and those that one query only found."""
    return {"candidates": F.count("*"), "single": F.count_if(F.size("found_by_query") == 1)}


def run_totals(hits: DataFrame, queries: DataFrame) -> DataFrame:
    """One row: queries that went well and failed, hits, candidates, and those found by one query only.

    The hits are read once: by URL, or by query where it failed, and then summed up.
    """
    url = strip(F.coalesce(F.col("url"), F.lit("")))
    each = hits.groupBy(F.when(failed(), F.lit(None)).otherwise(url).alias("u"), F.when(failed(), F.col("query_no")).alias("f")).agg(F.count("*").alias("n"), F.min("query_no").alias("lo"), F.max("query_no").alias("hi"))
    there = F.col("u") != ""
    sums = each.agg(
        F.count_if(F.col("f").isNotNull()).alias("query_failed"), F.coalesce(F.sum(F.when(F.col("f").isNull(), F.col("n"))), F.lit(0)).alias("raw"),
        F.count_if(there).alias("candidates"), F.count_if(there & (F.col("lo") == F.col("hi"))).alias("single"),
    )
    both = queries.agg(F.countDistinct("query_no").alias("queries")).crossJoin(sums)  # single rows
    return both.select((F.col("queries") - F.col("query_failed")).alias("query_ok"), "query_failed", "raw", "candidates", "single")


def histogram(df: DataFrame, column: Column, empty: str) -> DataFrame:
    """(key, n), sorted by key, null and empty counting as `empty`."""
    return df.groupBy(F.coalesce(T.blank_to_null(column), F.lit(empty)).alias("key")).agg(F.count("*").alias("n")).orderBy("key")


def preview(candidates: DataFrame, n: int | None = 20) -> DataFrame:
    """The first n candidates in order; all, if n is None."""
    return candidates.orderBy("ord") if n is None else candidates.orderBy("ord").limit(n)


def retirement(stats: DataFrame, days: int = 14) -> DataFrame:
    """(query_no, day, verdict) where the last `days` run days of a query had no unique hit (retire), or none pushed (review)."""
    from pyspark.sql import Window

    w = Window.partitionBy("query_no").orderBy("day").rowsBetween(1 - days, 0)
    seen = stats.select("query_no", "day", F.max("unique").over(w).alias("u"), F.max("pushed").over(w).alias("p"), F.count("*").over(w).alias("n"))
    verdict = F.when(F.col("u") == 0, F.lit("retire")).when(F.col("p") == 0, F.lit("review"))
    return seen.where(F.col("n") == days).select("query_no", "day", verdict.alias("verdict")).where("verdict is not null")
