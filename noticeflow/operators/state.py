"""The run's state, history and ledger: receipts, idempotent upserts, push statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions.url import normalize_url

META = ("dedup_key", "first_seen", "last_seen", "pushed", "found_by_query")


def run_state(pending: Column, total: Column, expected: Column | None = None, confirmed: Column | None = None) -> Column:
    """COMPLETE_NO_CANDIDATES, VERIFYING, VALIDATED, or PUSHED once all expected receipts are there."""
    pushed = F.lit(False) if expected is None or confirmed is None else (expected > 0) & (confirmed >= expected)
    return F.when(total == 0, "COMPLETE_NO_CANDIDATES").when(pending > 0, "VERIFYING").when(pushed, "PUSHED").otherwise("VALIDATED")


def next_action(state: Column, confirmed: Column, mode: Column) -> Column:
    """What is to be done, derived from the ledger rather than stored."""
    may = mode.isin(*rules.PUSHES)
    return (
        F.when(state == "VERIFYING", "SUBMIT_BATCHES").when((state == "VALIDATED") & may & (confirmed > 0), "PUSH_REMAINING")
        .when((state == "VALIDATED") & may, "REVIEW_PAYLOADS").otherwise("NONE")
    )


def dedup_key(code: Column, purchaser: Column, url: Column) -> Column:
    """Project code and purchaser, or the normalized URL where there is no code."""
    return F.when(code != "null", F.concat_ws("|", code, purchaser)).otherwise(normalize_url(url))


def _keys(rows: DataFrame, id_: str, dedup: Column) -> DataFrame:
    """(id_, n, k, k0, k1): each of a row's keys that isn't null, by number, with the first two where they have lower numbers.

    Rows are dealt first: few bytes, much work.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col("record_id").cast("string"), dedup.cast("string"), normalize_url(F.col("source_url"))]
    named = rows.repartition(tasks, id_, "source_url").select(id_, F.array(*keys).alias("_keys"))
    each = named.select(id_, F.posexplode("_keys").alias("n", "k"), "_keys").where("k is not null")
    return each.select(id_, "n", "k", *[F.when(F.col("n") > i, F.col("_keys")[i]).alias(f"k{i}") for i in (0, 1)])


def _new_keys(records: DataFrame) -> DataFrame:
    return _keys(records, "candidate_id", dedup_key(F.col("project_code"), F.col("purchaser"), F.col("source_url")))


def _old_keys(seen: DataFrame) -> DataFrame:
    return _keys(seen.withColumn("seen_id", F.col("record_id")), "seen_id", F.col("dedup_key"))


def duplicates(records: DataFrame, seen: DataFrame) -> DataFrame:
    """(candidate_id, seen_id) of history rows with the same record_id, dedup_key or normalized URL, each pair once.

    Two rows meet by the first key that both have. So only pairs of an id that several rows have are compared with each other; all
    others leave the join as they are, however many a key makes.
    """
    new, old = _split(records, "candidate_id"), _split(seen, "record_id")
    pairs = lambda a, b: _met(_new_keys(a), _old_keys(b))
    rest = pairs(new[1], seen).union(pairs(new[0], old[1])).distinct()
    return pairs(new[0], old[0]).union(rest)


def _split(rows: DataFrame, id_: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose id no other has, and the others."""
    often = rows.groupBy(F.col(id_).alias("_often")).agg(F.count("*").alias("_n")).where("_n > 1").select("_often")
    same = F.col(id_).eqNullSafe(F.col("_often"))
    return rows.join(often, same, "left_anti"), rows.join(often, same, "left_semi")


def _met(new: DataFrame, old: DataFrame) -> DataFrame:
    both = new.alias("a").join(old.alias("b"), (F.col("a.n") == F.col("b.n")) & (F.col("a.k") == F.col("b.k")))
    same = lambda k: F.coalesce(F.col(f"a.{k}") == F.col(f"b.{k}"), F.lit(False))
    return both.where(~same("k0") & ~same("k1")).select("candidate_id", "seen_id")


def same_record(a: str, b: str) -> Column:
    """Whether two rows agree on all 26 fields, nulls included: what a run that broke off between two writes leaves."""
    out = F.lit(True)
    for f in rules.CREATE_FIELDS:
        out = out & F.col(f"{a}.{f}").eqNullSafe(F.col(f"{b}.{f}"))
    return out


def create_actions(creates: DataFrame, seen: DataFrame) -> DataFrame:
    """(candidate_id, action) of records to be added: append; recovered where history has the same record, all 26 fields, and
    pushed, and no other like it; conflict where it or another of `creates` has its record_id, dedup_key or URL."""
    keys = _new_keys(creates)
    ends = _old_keys(seen).groupBy("n", "k").agg(F.min("seen_id").alias("lo"), F.max("seen_id").alias("hi"), F.max(F.col("seen_id").isNull()).alias("unnamed"))
    found = keys.join(ends, ["n", "k"]).groupBy("candidate_id").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("unnamed").alias("unnamed"))
    known = found.select("candidate_id", F.when((F.col("lo") == F.col("hi")) & ~F.col("unnamed"), F.col("lo")).alias("seen_id"), F.lit(True).alias("known"))
    fields = F.struct(*rules.CREATE_FIELDS)
    old = seen.groupBy(F.col("record_id").alias("seen_id")).agg(F.count("*").alias("rows"), F.first(fields).alias("old"), F.max(F.coalesce("pushed", F.lit(False))).alias("was_pushed"))
    same = F.coalesce((F.col("rows") == 1) & F.col("was_pushed") & same_record("new", "old"), F.lit(False))
    # Only records that are like one row of history are compared with it: those without one would all meet in one task.
    like = known.where("seen_id is not null").select("candidate_id", "seen_id")
    one = creates.select("candidate_id", fields.alias("new")).join(like, "candidate_id").join(old, "seen_id").select("candidate_id", same.alias("same"), F.lit(True).alias("known"))
    none = creates.select("candidate_id").join(like, "candidate_id", "left_anti").join(known.select("candidate_id", "known"), "candidate_id", "left")
    j = one.union(none.select("candidate_id", F.lit(False).alias("same"), "known"))
    twice = _repeated(keys).withColumn("twice", F.lit(True))
    action = F.when(F.col("twice") | F.col("known") & ~F.col("same"), "conflict").when(F.col("same"), "recovered").otherwise("append")
    return j.join(twice, "candidate_id", "left").select("candidate_id", action.alias("action"))


def _repeated(keys: DataFrame) -> DataFrame:
    """(candidate_id) of records that share a record_id, dedup_key or URL with another."""
    shared = keys.groupBy("n", "k").agg(F.min("candidate_id").alias("lo"), F.max("candidate_id").alias("hi")).where("lo <> hi")
    return keys.join(shared, ["n", "k"], "left_semi").select("candidate_id").distinct()


def fold_updates(updates: DataFrame) -> DataFrame:
    """One update for each record_id: the last by confirmed_at (where given) and candidate_id, with the queries of all."""
    order = [c for c in ("confirmed_at", "candidate_id") if c in updates.columns]
    fields = [c for c in updates.columns if c not in ("record_id", "found_by_query")]
    return updates.groupBy("record_id").agg(
        F.max_by(F.struct(*fields), F.struct(*[F.col(c).alias(f"o{k}") for k, c in enumerate(order or fields)])).alias("f"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("found_by_query")))).alias("found_by_query"),
    ).select("record_id", *[F.col(f"f.{c}").alias(c) for c in fields], "found_by_query")


def check_receipts(receipts: DataFrame, payloads: DataFrame, mode: str) -> DataFrame:
    """Each receipt with its errors: payload known once, path and hash equal, HTTP 200 and code 0, flow sent in this mode."""
    known = payloads.groupBy("flow", "candidate_id").agg(F.count("*").alias("_n"), F.max("path").alias("_path"), F.max("sha256").alias("_sha"))
    j = receipts.join(known, ["flow", "candidate_id"], "left")
    tests = [
        (~F.col("flow").isin(*rules.PUSHES.get(mode, ("",))), "flow not allowed in this mode"),
        (F.coalesce("_n", F.lit(0)) != 1, "no single payload"),
        (~F.col("payload_path").eqNullSafe(F.col("_path")), "path differs"),
        (~F.col("payload_sha256").eqNullSafe(F.col("_sha")), "hash differs"),
        (~F.regexp_extract("payload_path", r"([^/]*?)(?:\.json)?$", 1).eqNullSafe(F.col("candidate_id")), "file name is not the candidate"),
        (~(F.col("http_status").eqNullSafe(F.lit(200)) & F.col("remote_code").eqNullSafe(F.lit(0))), "not confirmed"),
    ]
    return j.withColumn("errors", F.array_compact(F.array(*[F.when(t, F.lit(m)) for t, m in tests]))).drop("_n", "_path", "_sha")


def replay(receipts: DataFrame, ledger: DataFrame) -> DataFrame:
    """Adds action: append for new keys, idempotent for a known key and hash, conflict for another hash. Repeats count once."""
    one = receipts.groupBy("flow", "candidate_id").agg(F.min(F.struct("confirmed_at", "payload_sha256")).alias("r"))
    known = ledger.groupBy("flow", "candidate_id").agg(F.max("payload_sha256").alias("_sha"))
    j = one.select("flow", "candidate_id", "r.payload_sha256", "r.confirmed_at").join(known, ["flow", "candidate_id"], "left")
    action = F.when(F.col("_sha").isNull(), "append").when(F.col("_sha") == F.col("payload_sha256"), "idempotent").otherwise("conflict")
    return j.withColumn("action", action).drop("_sha")


def append_ledger(ledger: DataFrame, rows: DataFrame) -> DataFrame:
    return ledger.unionByName(rows.dropDuplicates(["flow", "candidate_id"]).join(ledger, ["flow", "candidate_id"], "left_anti"), allowMissingColumns=True)


def upsert_seen(seen: DataFrame, creates: DataFrame, updates: DataFrame, day: str) -> DataFrame:
    """History after a day's pushes. Creates are added; updates overwrite their 12 fields, one after the other.

    Both carry found_by_query, which is united with what is known. The caller checks before that creates are new
    (`create_actions`) and that updates have a history row (`missing_targets`): those whose record_id is there, or isn't, are
    left out here.
    """
    updates = fold_updates(updates)
    changed = [f for f in rules.UPDATE_FIELDS if f not in ("record_id", "change_type")]
    u = updates.select("record_id", *[F.col(f).alias(f"_{f}") for f in changed], F.col("found_by_query").alias("_q"), F.lit(True).alias("_hit"))
    j = seen.join(u, "record_id", "left")
    cols = []
    for f in seen.columns:
        if f in changed:
            cols.append(F.coalesce(F.col(f"_{f}").cast(seen.schema[f].dataType), F.col(f)).alias(f))
        elif f == "last_seen":
            cols.append(F.when(F.col("_hit"), F.lit(day)).otherwise(F.col(f)).alias(f))
        elif f == "pushed":
            cols.append((F.coalesce(f, F.lit(False)) | F.coalesce("_hit", F.lit(False))).alias(f))
        elif f == "found_by_query":
            none = F.array().cast("array<int>")
            cols.append(F.array_sort(F.array_union(F.coalesce(f, none), F.coalesce("_q", none))).alias(f))
        else:
            cols.append(F.col(f))
    added = creates.join(seen.select("record_id"), "record_id", "left_anti").dropDuplicates(["record_id"])
    added = added.withColumn("dedup_key", dedup_key(F.col("project_code"), F.col("purchaser"), F.col("source_url")))
    added = added.withColumns({"first_seen": F.lit(day), "last_seen": F.lit(day), "pushed": F.lit(True), "found_by_query": F.array_sort("found_by_query")})
    return j.select(*cols).unionByName(added.select(*[F.col(f).cast(seen.schema[f].dataType).alias(f) for f in seen.columns]))


def missing_targets(updates: DataFrame, seen: DataFrame) -> DataFrame:
    return updates.join(seen, "record_id", "left_anti").select("record_id")


def backfill(changes: DataFrame, seen: DataFrame) -> DataFrame:
    """Full update records: changed fields new, all others as history has them."""
    old = seen.select("record_id", *[F.col(f).alias(f"_{f}") for f in rules.UPDATE_FIELDS if f in seen.columns and f != "record_id"])
    j = changes.join(old, "record_id")
    pick = lambda f: F.coalesce(F.col(f), F.col(f"_{f}")) if f in changes.columns and f"_{f}" in j.columns else F.col(f if f in changes.columns else f"_{f}")
    return j.select(*[pick(f).alias(f) for f in rules.UPDATE_FIELDS])


def pushed_stats(stats: DataFrame, ledger: DataFrame, day: str) -> DataFrame:
    """A day's statistics with pushed counted anew from the ledger, so that repeating changes nothing. Other days stay."""
    counts = ledger.where(F.col("run_id") == day).select(F.explode("found_by_query").alias("query_no")).groupBy("query_no").agg(F.count("*").alias("_n"))
    j = stats.join(counts, "query_no", "left")
    return j.withColumn("pushed", F.when(F.col("day") == day, F.coalesce("_n", F.lit(0))).otherwise(F.col("pushed"))).drop("_n")


def push_counts(ledger: DataFrame, payloads: DataFrame) -> DataFrame:
    """One row: expected and confirmed sends, and the confirmed ones by flow."""
    got = payloads.join(ledger.select("flow", "candidate_id", F.lit(True).alias("_ok")), ["flow", "candidate_id"], "left")
    ok = F.coalesce("_ok", F.lit(False))
    return got.agg(F.count("*").alias("expected"), F.count_if(ok).alias("confirmed"), F.count_if(ok & (F.col("flow") == "create")).alias("create"), F.count_if(ok & (F.col("flow") == "update")).alias("update"))
