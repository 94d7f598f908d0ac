"""What a run says about itself: a manifest row, a compact status, a text report."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..operators import dedup, route, state


def manifest(run_id: str, mode: str, batch_size: int, funnel: DataFrame, batches: DataFrame, totals: DataFrame | None = None, payloads: DataFrame | None = None, ledger: DataFrame | None = None) -> DataFrame:
    """One row: the run, its state and next action, all counts. Nothing of it is stored state; it follows from the tables."""
    b = batches.agg(F.count("*").alias("batches"), F.count_if(F.col("status") == "completed").alias("batches_done")).crossJoin(route.next_batch(batches).withColumnRenamed("batch_id", "next_batch"))
    out = funnel.crossJoin(b)  # single rows
    if payloads is not None and ledger is not None:
        out = out.crossJoin(state.push_counts(ledger, payloads).select("expected", "confirmed"))
    else:
        out = out.withColumns({"expected": F.lit(0).cast("long"), "confirmed": F.lit(0).cast("long")})
    if totals is not None:
        out = out.crossJoin(totals)
    st = state.run_state(F.col("batches") - F.col("batches_done"), F.col("batches"), F.col("expected"), F.col("confirmed"))
    out = out.withColumns({"run_id": F.lit(run_id), "mode": F.lit(mode), "batch_size": F.lit(batch_size)}).withColumn("state", st)
    return out.withColumn("next_action", state.next_action(F.col("state"), F.col("confirmed"), F.col("mode")))


def compact(row: DataFrame) -> dict:
    """The manifest as a dictionary, without what is null."""
    return {k: v for k, v in row.first().asDict().items() if v is not None}


def lines(stats: DataFrame, totals: DataFrame, index: DataFrame, failures: DataFrame, limit: int | None = 20) -> Iterator[str]:
    """Totals, failed queries, attribution by query, authority histogram and a preview; `limit` None previews all, of which the
    driver holds a part at a time."""
    t = totals.first()
    lines = [f"queries ok {t.query_ok}, failed {t.query_failed}; hits {t.raw}; candidates {t.candidates}, of one query only {t.single}"]
    lines += [f"failed {r.query_no}: {r.error}" for r in failures.select("query_no", "error").distinct().orderBy("query_no").collect()]
    rows = dedup.redundancy(stats).orderBy(F.col("query_no").cast("int")).collect()
    lines += [f"query {r.query_no}: raw {r.raw}, unique {r.unique}" + (f", redundancy {r.redundancy:.2f}" if r.redundancy is not None else "") for r in rows if r.unique]
    if none := [str(r.query_no) for r in rows if not r.unique]:
        lines.append("no contribution: " + ", ".join(none))
    lines += [f"{r.key}: {r.n}" for r in dedup.histogram(index, F.col("auth_info_des"), rules.NO_AUTHORITY).collect()]
    yield from lines
    for r in dedup.preview(index, limit).select("title", "site_name", "url").toLocalIterator():
        yield f"{r.title} | {r.site_name} | {r.url}"


def text(*tables: DataFrame, limit: int | None = 20) -> str:
    return "\n".join(lines(*tables, limit=limit))
