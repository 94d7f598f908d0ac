"""Payloads and counts of decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules


def payloads(results: DataFrame) -> DataFrame:
    """(flow, candidate_id, path, json, sha256): one JSON text of the fixed fields in their order for each create and update.

    `results` has decision, candidate_id and the record's fields as columns.
    """
    frames = []
    for flow, fields in (("create", rules.CREATE_FIELDS), ("update", rules.UPDATE_FIELDS)):
        have = [F.col(f) if f in results.columns else F.lit(None).cast("string").alias(f) for f in fields]
        json = F.to_json(F.struct(*[wire(c, f).alias(f) for c, f in zip(have, fields, strict=True)]))
        rows = results.where(F.col("decision") == flow).select(F.lit(flow).alias("flow"), "candidate_id", json.alias("json"))
        frames.append(rows)
    out = frames[0].union(frames[1])
    path = F.concat(F.lit("payloads/"), F.col("flow"), F.lit("/"), F.col("candidate_id"), F.lit(".json"))
    return out.select("flow", "candidate_id", path.alias("path"), "json", F.sha2("json", 256).alias("sha256"))


def wire(c: Column, field: str) -> Column:
    """A field as it is sent: no null, but the string null, 0 or false."""
    return F.coalesce(c, F.lit(0) if field in rules.NUMBER_FIELDS else F.lit(False) if field in rules.BOOL_FIELDS else F.lit("null"))


def counts(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """One row with a count for each value of a fixed domain, zero included."""
    return df.agg(*[F.count_if(F.col(column).eqNullSafe(F.lit(x))).alias(x) for x in domain])


def summary(results: DataFrame, stats: DataFrame | None = None, failures: DataFrame | None = None) -> DataFrame:
    """(part, n): how the run's results split, each part there, zero included.

    With `failures` (query_no) also the queries that failed, with `stats` (raw, unique, pushed) hits, candidates of one query
    only and pushed ones.
    """
    d, s = F.col("decision"), F.col("status")
    parts = {
        "active": (d == "create") & (s == "active"), "intel": (d == "create") & (s == "intel"), "pushed_manual": (d == "create") & (s == "manual"),
        "local_manual": d == "manual", "excluded": d == "exclude", "update": d == "update",
    }
    row = results.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(p) for p, c in parts.items()])
    if failures is not None:
        row = row.crossJoin(failures.agg(F.countDistinct("query_no").alias("failed")))  # one row
    if stats is not None:
        row = row.crossJoin(stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"attribution_{c}") for c in ("raw", "unique", "pushed")]))  # one row
    names = row.columns
    return row.select(F.explode(F.map_from_arrays(F.array(*[F.lit(p) for p in names]), F.array(*[F.col(p) for p in names]))).alias("part", "n"))
