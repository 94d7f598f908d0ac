"""Reprints of one notice as one candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .route import in_ranges, numbered

SHORT = 8


def cluster_key(short: int = SHORT) -> Column:
    """The title's fingerprint; a candidate whose fingerprint is null or has fewer than `short` characters stays by itself."""
    return F.when(F.length(F.coalesce("title_fingerprint", F.lit(""))) < short, F.concat(F.lit("#"), F.col("candidate_id"))).otherwise(F.col("title_fingerprint"))


def members(candidates: DataFrame, short: int = SHORT, parts: int | None = None) -> DataFrame:
    """(cluster_key, number, ord, candidate_id, site_name, url): every candidate as a member of its cluster, numbered by `ord` from 0,
    the representative. A cluster of any size is dealt over ranges of ord: no task sees all of its rows."""
    rows = candidates.select(cluster_key(short).alias("cluster_key"), "ord", "candidate_id", "site_name", "url")
    return numbered(in_ranges(rows, parts), "number", ["cluster_key"]).select("cluster_key", "number", "ord", "candidate_id", "site_name", "url")


def cluster(candidates: DataFrame, short: int = SHORT, most: int | None = None) -> DataFrame:
    """One row for each title fingerprint: the first candidate by `ord`, its members and alternates, all queries.

    The lists have all members, or the first `most` of them; then a cluster of any size fits in its row, n_members is added, and
    `members` has the rest. Candidates with a fingerprint of fewer than `short` characters stay by themselves.
    """
    member = F.struct("ord", "candidate_id", "site_name", "url")
    rows = candidates.groupBy(cluster_key(short).alias("cluster_key")).agg(
        F.min_by(F.struct(*candidates.columns), F.col("ord")).alias("first"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("found_by_query")))).alias("queries"),
        F.count("*").alias("n_members"), *([F.array_sort(F.collect_list(member)).alias("all")] if most is None else []),
    )
    if most is not None:
        some = members(candidates, short).where(F.col("number") < most).groupBy("cluster_key").agg(F.array_sort(F.collect_list(member)).alias("all"))
        rows = rows.join(some, "cluster_key")
    kept = [F.col(f"first.{c}").alias(c) for c in candidates.columns if c != "found_by_query"]
    return rows.select(
        *kept, F.col("queries").alias("found_by_query"), F.col("all.candidate_id").alias("cluster_members"),
        F.transform(F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0))), lambda m: F.struct(m["candidate_id"].alias("candidate_id"), m["site_name"].alias("site_name"), m["url"].alias("url"))).alias("alternate_sources"),
        *([] if most is None else ["n_members"]),
    )
