"""The three steps of a run as plans over tables: prepare, submit, record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..operators import cluster, dedup, export, match, route, state, validate
from ..sources import files


class Rejected(ValueError):
    """A step that must not go on; what is wrong stands in the message."""


def check_mode(mode: str, batch_size: int, exists: bool = False, force: bool = False) -> None:
    if mode not in rules.MODES or not 1 <= batch_size <= 20:
        raise Rejected("unknown mode or batch size")
    if exists and not force:
        raise Rejected("the run is there already")


def _raise(errors: DataFrame, what: str) -> None:
    if found := errors.limit(20).collect():
        raise Rejected(f"{what}: " + "; ".join(f"{r[0]}: {r[1]}" for r in found))


@dataclass
class Prepared:
    routed: DataFrame
    queue: DataFrame
    funnel: DataFrame


def search_step(hits: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(index, contents, statistics) from the hits of a run's queries."""
    candidates = dedup.dedup_hits(dedup.successes(hits))
    return dedup.light_index(candidates), dedup.contents(candidates), dedup.query_stats(dedup.successes(hits), candidates, queries)


def prepare(index: DataFrame, contents: DataFrame, seen: DataFrame, mode: str = "report-only", batch_size: int = 5) -> Prepared:
    """Validates an index, clusters it, matches it with history, routes it and assigns batches: one lazy plan."""
    check_mode(mode, batch_size)
    _raise(validate.candidate_index(index, contents), "index")
    read = files.with_content(index.select("candidate_id", "url"), contents)
    _raise(read.where("content_error is not null").select("candidate_id", "content_error"), "contents")
    matched = match.match_seen(cluster.cluster(index), seen)
    routed = route.with_evidence(route.route(matched), contents)
    queue = route.assign_batches(routed.where("flow_hint is not null"), batch_size)
    return Prepared(routed, queue, route.funnel(routed, index.count()))


def submit(results: DataFrame, batch: DataFrame, mode: str) -> DataFrame:
    """The results of a batch, all of them right; any error rejects all."""
    _raise(validate.batch_results(results, batch, mode), "results")
    return results


@dataclass
class Confirmed:
    """What receipts bring: records to be created and updated, and rows for the ledger; nothing of it is there yet."""

    creates: DataFrame
    updates: DataFrame
    ledger: DataFrame


def confirm(receipts: DataFrame, payloads: DataFrame, ledger: DataFrame, seen: DataFrame, records: DataFrame, mode: str, day: str) -> Confirmed:
    """Checks receipts against payloads, ledger and history; anything wrong rejects them all.

    A record to be created that history has under its record_id, dedup_key or URL is refused, unless it is the very same one.
    `records` has flow, candidate_id, found_by_query and the record's fields.
    """
    checked = state.check_receipts(receipts, payloads, mode)
    _raise(checked.where("size(errors) > 0").select("candidate_id", F.array_join("errors", ",")), "receipts")
    acted = state.replay(receipts, ledger)
    _raise(acted.where("action = 'conflict'").select("candidate_id", F.lit("another payload was sent")), "ledger")
    new = acted.where("action = 'append'").drop("action")
    todo = records.join(new.select("flow", "candidate_id", "confirmed_at"), ["flow", "candidate_id"])
    creates, updates = todo.where("flow = 'create'"), todo.where("flow = 'update'")
    found = state.create_actions(creates, seen)
    _raise(found.where("action = 'conflict'").select("candidate_id", F.lit("record_id, dedup_key or URL is in history or sent twice")), "creates")
    _raise(state.missing_targets(updates, seen).select("record_id", F.lit("not in history")), "updates")
    fresh = creates.join(found.where("action = 'append'"), "candidate_id", "left_semi")
    rows = new.join(records.select("flow", "candidate_id", "record_id", "found_by_query"), ["flow", "candidate_id"]).withColumn("run_id", F.lit(day))
    return Confirmed(fresh, updates, rows)


def record(receipts: DataFrame, payloads: DataFrame, ledger: DataFrame, seen: DataFrame, records: DataFrame, mode: str, day: str) -> tuple[DataFrame, DataFrame]:
    """(history, ledger) after receipts, whole. History is to be written before the ledger: a run that breaks off between the two
    finds its records in history and adds nothing twice. Several updates of a record are taken in the order of their confirmation.
    """
    got = confirm(receipts, payloads, ledger, seen, records, mode, day)
    return state.upsert_seen(seen, got.creates, got.updates, day), state.append_ledger(ledger, got.ledger)


def decision_counts(results: DataFrame) -> DataFrame:
    return export.counts(results, "decision", rules.DECISIONS)
