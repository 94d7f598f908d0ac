"""History as a log: a base table and what was confirmed since, merged as it is read.

A receipt writes rows in proportion to itself. Creates and updates lie in `seen_log` with their place in the order of all; reading
joins the folded updates to the base, which isn't shuffled as long as they are few. Compaction folds the log into a new base.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules, schemas
from ..operators.state import dedup_key
from .store import Commit, Snapshot, Store

BASE, LOG = "seen", "seen_log"
#: Where a row stands in history; as texts these sort like the commits and, within one, like the confirmations.
PLACED = "seen_ord string, " + schemas.SEEN
ENTRY = "op string, " + PLACED
CHANGED = tuple(f for f in rules.UPDATE_FIELDS if f not in ("record_id", "change_type"))


def merged(base: DataFrame, log: DataFrame) -> DataFrame:
    """History after all entries of `log` (op create or update): created rows are added, each update then overwrites the fields of
    its record that it gives, the later one the earlier one's, and adds its queries.

    Updates of a record that isn't there have no effect, a field that no update gives stays. An update of a row counts whether it
    comes before or after the row in `log`: entries are checked as they are appended.
    """
    rows = base.unionByName(log.where("op = 'create'").select(*base.columns))
    last = lambda f: F.max_by(f, F.when(F.col(f).isNotNull(), F.col("seen_ord")))
    folded = log.where("op = 'update'").groupBy(F.col("record_id").alias("_id")).agg(
        *[last(f).alias(f"_{f}") for f in (*CHANGED, "last_seen")], F.array_distinct(F.flatten(F.collect_set("found_by_query"))).alias("_queries"),
    )
    none = F.array().cast("array<int>")
    new = {f: F.coalesce(F.col(f"_{f}"), F.col(f)) for f in (*CHANGED, "last_seen")} | {
        "pushed": F.coalesce("pushed", F.lit(False)) | F.col("_id").isNotNull(),
        "found_by_query": F.array_sort(F.array_union(F.coalesce("found_by_query", none), F.coalesce("_queries", none))),
    }
    return rows.join(folded, F.col("record_id") == F.col("_id"), "left").select(*[new[c].alias(c) if c in new else F.col(c) for c in base.columns])


def entries(creates: DataFrame, updates: DataFrame, day: str, place: Column) -> DataFrame:
    """Log entries of a day's creates and updates, which carry found_by_query. `place` is where they stand in history."""
    added = creates.withColumns({"dedup_key": dedup_key(F.col("project_code"), F.col("purchaser"), F.col("source_url")), "first_seen": F.lit(day)})
    both = [(added, "create"), (updates, "update")]
    kind = {c.split(" ")[0]: c.split(" ", 1)[1] for c in ENTRY.split(", ")}

    def entry(df: DataFrame, op: str) -> DataFrame:
        given = {"op": F.lit(op), "seen_ord": place, "last_seen": F.lit(day), "pushed": F.lit(True), "found_by_query": F.array_sort("found_by_query")}
        keep = set(CHANGED) | {"record_id"} if op == "update" else set(df.columns)
        return df.select(*[(given[c] if c in given else F.col(c) if c in keep and c in df.columns else F.lit(None)).cast(k).alias(c) for c, k in kind.items()])

    return entry(*both[0]).unionByName(entry(*both[1]))


class History:
    def __init__(self, store: Store):
        self.store = store

    def rows(self, at: Snapshot | Commit | None = None) -> DataFrame:
        """All records with seen_ord, as a snapshot or a commit's beginning has them. A commit that reads them conflicts with others."""
        if isinstance(at, Commit):
            return merged(at.read(BASE, PLACED), at.read(LOG, ENTRY))
        at = at or self.store.latest()
        return merged(self.store.read(BASE, at, PLACED), self.store.read(LOG, at, ENTRY))

    def begin_with(self, records: DataFrame) -> None:
        """The first base, of records in the columns of schemas.SEEN and, if there is one, their order in seen_ord."""
        order = F.format_string("%020d", F.col("seen_ord").cast("long")) if "seen_ord" in records.columns else F.lit("")
        fields = [f.split(" ") for f in PLACED.split(", ")]
        with self.store.begin() as c:
            c.replace(BASE, records.select(*[(order if n == "seen_ord" else F.col(n)).cast(k).alias(n) for n, k in fields]))

    def append(self, commit: Commit, creates: DataFrame, updates: DataFrame, day: str) -> dict:
        """Stages a day's creates and updates; updates have confirmed_at, if several of a record are to be told apart."""
        said = [F.col(c).cast("string") for c in ("confirmed_at", "candidate_id") if c in creates.columns and c in updates.columns]
        place = F.concat_ws("/", F.lit(f"c{commit.base.number + 1:012d}"), *said)
        commit.read(LOG, ENTRY)
        return commit.append(LOG, entries(creates, updates, day, place), ENTRY)

    def compact(self, entries_at_least: int = 1) -> bool:
        """Folds the log into a new base, if it has so many entries. Readers of older snapshots go on with theirs."""
        commit = self.store.begin()
        log = commit.base.tables.get(LOG)
        if log is None or sum(log.rows) < entries_at_least:
            return False
        with commit:
            commit.replace(BASE, self.rows(commit))
            commit.replace(LOG, self.store.spark.createDataFrame([], ENTRY))
        return True
