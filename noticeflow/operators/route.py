"""Where each candidate goes, evidence of those that stay, and batches for review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T

ROUTES = ("update", "already_seen", "screened_out", "create")


def route(
    matched: DataFrame, exclusions: Sequence[rules.Rule] = rules.EXCLUSIONS, intent: Sequence[str] = rules.INTENT_WORDS, updates: Sequence[str] = rules.UPDATE_WORDS
) -> DataFrame:
    """Adds route, skip_reason and flow_hint. The first that holds decides: known with an update word (update), known by
    URL (already_seen), an exclusion or no word of intent in the title (screened_out), else create."""
    title = F.col("title")
    known = F.size("matched_seen_record_ids") > 0
    excluded = T.first_match(title, exclusions)
    where = (
        F.when(known & T.has_any(title, updates), "update").when(known, "already_seen").when(excluded.isNotNull(), "screened_out")
        .when(~T.has_any(title, intent), "screened_out").otherwise("create")
    )
    out = matched.withColumn("route", where)
    reason = (
        F.when(F.col("route") == "already_seen", F.lit("seen"))
        .when((F.col("route") == "screened_out") & excluded.isNotNull(), F.concat(F.lit("excluded: "), excluded))
        .when(F.col("route") == "screened_out", F.lit("no intent"))
    )
    return out.withColumn("skip_reason", reason).withColumn("flow_hint", F.when(F.col("route").isin("update", "create"), F.col("route")))


def with_evidence(routed: DataFrame, contents: DataFrame, signals: Sequence[rules.Rule] = rules.SIGNALS) -> DataFrame:
    """Adds search_evidence to the rows of the create route, from their contents; content is read for those rows only."""
    texts = contents.select("candidate_id", F.concat_ws("\n", F.coalesce("summary", F.lit("")), F.coalesce("content", F.lit(""))).alias("_text"))
    created = routed.where("route = 'create'").join(texts, "candidate_id", "left")
    evidence = F.struct(
        F.lit(True).alias("title_has_procurement_intent"), T.all_matches(F.coalesce("_text", F.lit("")), signals).alias("target_category_signals"), "content_path"
    )
    created = created.withColumn("search_evidence", evidence).drop("_text")
    return created.unionByName(routed.where("route <> 'create'"), allowMissingColumns=True)


def funnel(routed: DataFrame, indexed: int | Column) -> DataFrame:
    """One row: indexed, clusters, queued, possible_updates, already_seen, screened_out."""
    n = F.lit(indexed) if isinstance(indexed, int) else indexed
    r = F.col("route")
    return routed.agg(
        F.max(n).cast("long").alias("indexed"), F.count("*").alias("clusters"), F.count_if(r.isin("create", "update")).alias("queued"),
        F.count_if(r == "update").alias("possible_updates"), F.count_if(r == "already_seen").alias("already_seen"), F.count_if(r == "screened_out").alias("screened_out"),
    )


def in_ranges(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Adds _part: which of `parts` ranges of `ord` a row is in, each with about as many rows as any other however ord is spread.

    The ends are quantiles from a sketch, one row of at most `parts` numbers; equal values of ord are in one range. As many ranges as
    there are shuffle partitions, unless told otherwise.
    """
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if n < 2:
        return df.withColumn("_part", F.lit(0))
    ends = df.agg(F.percentile_approx("ord", [k / n for k in range(1, n)], 100 * n).alias("_ends"))
    cut = F.size(F.filter(F.array_distinct("_ends"), lambda e: e < F.col("ord")))
    return df.crossJoin(F.broadcast(ends)).withColumn("_part", cut).drop("_ends")  # one row


def numbered(ranged: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds `name`: 0, 1, ... in the order of `ord` within each value of `by`, from rows that have their _part, which goes.

    Rows are numbered within each range; a range starts at the sum of those before it, so that no task sees all rows of a value.
    """
    counts = ranged.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    same = F.col("_part") == F.col("_p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    n = F.row_number().over(Window.partitionBy(*by, "_part").orderBy("ord")) - 1 + F.col("_start")
    return ranged.join(starts, same).withColumn(name, n.cast("long")).drop("_part", "_p", "_start", *[f"_{c}" for c in by])


def assign_batches(queue: DataFrame, size: int = 5, parts: int | None = None) -> DataFrame:
    """Adds batch_id: `size` rows each in the order of `ord` (not null, distinct), batch-0001 on."""
    if not 1 <= size <= 20:
        raise ValueError("a batch has 1 to 20 rows")
    out = numbered(in_ranges(queue, parts), "_number")
    return out.withColumn("batch_id", F.format_string("batch-%04d", F.floor(F.col("_number") / size) + 1)).drop("_number")


def batches(queue: DataFrame, done: DataFrame) -> DataFrame:
    """(batch_id, count, status) of assigned rows; `done` has the batch_id of the completed ones."""
    n = queue.groupBy("batch_id").agg(F.count("*").alias("count"))
    flagged = n.join(done.select("batch_id").distinct().withColumn("_d", F.lit(True)), "batch_id", "left")
    return flagged.select("batch_id", "count", F.when(F.col("_d"), "completed").otherwise("pending").alias("status"))


def next_batch(all_batches: DataFrame) -> DataFrame:
    """One row: the first pending batch, or null."""
    return all_batches.agg(F.min(F.when(F.col("status") == "pending", F.col("batch_id"))).alias("batch_id"))
