"""python -m noticeflow search | prepare | status | next-batch | submit-batch | validate-payload | send | record-push

A run is a folder of versioned tables in any store that Spark reads. Exit codes: 0 done, 1 some queries failed, 2 wrong input,
3 the search was stopped by a fatal answer. Of send: 1 nothing confirmed, 2 refused.
"""

from __future__ import annotations

import argparse
import datetime
import json
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import rules, schemas
from .operators import dedup, export, route, state, validate
from .plans import report, run
from .sinks import outbox, versioned
from .sinks.history import History
from .sinks.store import Conflict, Store
from .sources import config, files, search


RESULTS = "batch_id string, candidate_id string, decision string, reason string, record string, evidence string, submitted_at string"
PAYLOADS = "flow string, candidate_id string, path string, json string, sha256 string"


def _pipeline(spark: SparkSession, run_dir: str) -> Store:
    return Store(spark, f"{run_dir}/pipeline")


def do_search(spark: SparkSession, a: argparse.Namespace) -> int:
    given = json.loads(spark.read.text(a.config, wholetext=True).first()[0]) if a.config else {}
    names = ("count", "time_range", "auth_level", "need_url", "need_content", "sites", "block_hosts", "industry", "content_format")
    options = config.SearchOptions.resolve({n: getattr(a, n) for n in names}, given.get("defaults"))
    limits = search_range(options.time_range, a.today)
    listed = not a.query
    if listed:
        every = files.read_query_list(spark, a.query_list, a.heading)
        chosen = validate.select_queries(spark, every, a.queries or "")
        declared = files.declared_total(spark, a.query_list).first().declared
        wrong = validate.query_list(every, declared).collect()
    else:
        chosen = spark.createDataFrame([(k + 1, q) for k, q in enumerate(a.query)], "query_no int, query string")
        wrong = []
        for r in validate.query_list(chosen).collect():
            print(f"warning: query {r.query_no}: {r.error}", file=sys.stderr)
    if wrong:
        raise run.Rejected("; ".join(f"query {r.query_no}: {r.error}" for r in wrong))
    queries = [(r.query_no, r.query) for r in chosen.orderBy("query_no").collect()]
    payload = options.payload("", limits)
    if a.dry_run:
        print(json.dumps(payload | {"Query": queries[0][1] if queries else ""}, ensure_ascii=False))
        return 0
    spark.dataSource.register(search.NoticeSearch)
    reader = spark.read.format("notice_search").option("queries", json.dumps(queries)).option("payload", json.dumps(payload)).option("run_id", a.today)
    if a.fixture:
        reader = reader.option("fixture", spark.read.text(a.fixture, wholetext=True).first()[0]).option("qps", "1000")
    else:
        config.api_key(a.key_variable, given)  # that there is one; the reader looks it up where it runs
        reader = reader.option("endpoint", a.endpoint or given.get("endpoint", "")).option("keyvariable", a.key_variable)
        if a.config:
            reader = reader.option("config", a.config)
    folder = f"{a.out}/{a.today}"
    store = Store(spark, folder)
    with store.begin() as commit:  # hits, index, contents and totals become current together
        counted = commit.replace("hits", reader.load(), count=dedup.hit_counts())
        hits = commit.written("hits")
        index, contents, stats = run.search_step(hits, chosen)
        counted |= commit.replace("index", index, count=dedup.index_counts())
        commit.replace("contents", contents)
        row = (len(queries) - counted["query_failed"], *(counted[k] for k in ("query_failed", "raw", "candidates", "single")))
        totals = spark.createDataFrame([row], "query_ok bigint, query_failed bigint, raw bigint, candidates bigint, single bigint")
        commit.replace("totals", totals)
    index = store.read("index")
    whole = listed and not a.queries  # a targeted search leaves the day's statistics alone
    if whole and not a.no_stats:
        versioned.replace_day(stats.withColumn("day", F.lit(a.today)), f"{a.out}/query_stats")
    failures = hits.where("coalesce(error, '') <> ''")
    for line in report.lines(stats, totals, index, failures, None if a.report_all else a.report_limit):
        print(line)
    if failures.where(F.col("error").startswith("stopped:")).limit(1).count():
        return 3
    return 1 if failures.limit(1).count() else 0


def search_range(value: str, today: str) -> str | None:
    from .functions.time import time_range

    return time_range(value, datetime.date.fromisoformat(today))


def do_prepare(spark: SparkSession, a: argparse.Namespace) -> int:
    store, found = _pipeline(spark, a.run_dir), Store(spark, a.run_dir)
    with store.begin() as commit:
        run.check_mode(a.mode, a.batch_size, "options" in commit.base.tables, a.force)
        at = found.latest()
        index = files.checked_jsonl(spark, a.index, schemas.CANDIDATE_INDEX) if a.index else found.read("index", at)
        contents = files.checked_jsonl(spark, a.contents, schemas.CANDIDATE_CONTENT) if a.contents else found.read("contents", at)
        got = run.prepare(index, contents, _seen(spark, a.seen), a.mode, a.batch_size)
        commit.replace("routed", got.routed)
        routed = commit.written("routed")
        for name, rows in versioned.routes(routed).items():
            commit.replace(f"routes_{name}", rows, "json")
        commit.replace("queue", route.assign_batches(routed.where("flow_hint is not null"), a.batch_size))
        commit.replace("batches", versioned.batch_files(commit.written("queue")), "json")
        commit.replace("funnel", route.funnel(routed, index.count()))
        commit.replace("contents", contents)
        commit.replace("results", spark.createDataFrame([], RESULTS))
        commit.replace("payloads", spark.createDataFrame([], PAYLOADS))
        commit.replace("options", spark.createDataFrame([(a.mode, a.batch_size)], "mode string, batch_size int"))
    return do_status(spark, a)


def _seen(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".json"):
        return files.read_seen(spark, path)
    return History(Store(spark, path)).rows()


def _manifest(spark: SparkSession, run_dir: str) -> DataFrame:
    store, found = _pipeline(spark, run_dir), Store(spark, run_dir)
    at = store.latest()  # all of it as of one moment
    o = store.read("options", at).first()
    batches = route.batches(store.read("queue", at), store.read("results", at))
    ledger = store.read("ledger", at, schemas.LEDGER)
    totals = found.read("totals") if found.has("totals") else None
    return report.manifest(os.path.basename(run_dir), o.mode, o.batch_size, store.read("funnel", at), batches, totals, store.read("payloads", at, PAYLOADS), ledger)


def do_status(spark: SparkSession, a: argparse.Namespace) -> int:
    """The manifest follows from the run's tables; a copy of it is written for those who only read files."""
    said = json.dumps(report.compact(_manifest(spark, a.run_dir)), ensure_ascii=False)
    versioned.put(spark, f"{a.run_dir}/pipeline/manifest.json", said + "\n")
    print(said)
    return 0


def do_next_batch(spark: SparkSession, a: argparse.Namespace) -> int:
    batch = _manifest(spark, a.run_dir).first().next_batch
    rows = _pipeline(spark, a.run_dir).read("queue").where(F.col("batch_id") == batch).orderBy("ord") if batch else None
    print(json.dumps({"batch_id": batch, "candidates": [json.loads(r[0]) for r in rows.select(F.to_json(F.struct("*"))).collect()] if batch else []}, ensure_ascii=False))
    return 0


def do_submit_batch(spark: SparkSession, a: argparse.Namespace) -> int:
    """Results: a JSON array of candidate_id, decision, reason, record and evidence; records stay as they are written."""
    commit = _pipeline(spark, a.run_dir).begin()
    o = commit.read("options").first()
    queue, done = commit.read("queue"), commit.read("results")
    batch = queue.where(F.col("batch_id") == a.batch)
    if not batch.limit(1).count() or done.where(F.col("batch_id") == a.batch).limit(1).count():
        raise run.Rejected(f"{a.batch} is not pending")
    given = json.loads(spark.read.text(a.results, wholetext=True).first()[0])
    if not isinstance(given, list) or not all(isinstance(x, dict) for x in given):
        raise run.Rejected("results must be a list of objects")
    own = lambda x, k: None if x.get(k) is None else json.dumps(x[k], ensure_ascii=False)
    rows = [(str(x.get("candidate_id")), x.get("decision"), x.get("reason"), own(x, "record"), own(x, "evidence")) for x in given]
    results = spark.createDataFrame(rows, "candidate_id string, decision string, reason string, record string, evidence string")
    bytes_ = commit.read("contents").select("candidate_id", "summary", "content", F.encode(F.to_json(F.struct("*")), "utf-8").alias("content_bytes"))
    fallback = validate.search_fallback(results.join(batch.select("candidate_id", "title", "url", "content_path"), "candidate_id").join(bytes_, "candidate_id", "left"), a.engine)
    run.submit(results, batch, o.mode)
    if wrong := fallback.where("size(fallback_errors) > 0").select("candidate_id", "fallback_errors").limit(20).collect():
        raise run.Rejected("; ".join(f"{r[0]}: {', '.join(r[1])}" for r in wrong))
    bound = F.map_zip_with(  # what was worked out here goes with the evidence
        F.coalesce(F.try_variant_get(F.try_parse_json("evidence"), "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")),
        F.map_from_arrays(F.array(F.lit("content_sha256"), F.lit("category_signals")), F.array(F.try_parse_json(F.concat(F.lit('"'), "content_sha256", F.lit('"'))), F.try_parse_json(F.to_json("category_signals")))),
        lambda _, given, own: F.coalesce(own, given),
    )
    kept = fallback.withColumn("evidence", F.when(F.col("content_sha256").isNotNull(), F.to_json(bound)).otherwise(F.col("evidence"))).select(*results.columns)
    with commit:  # results, and payloads once they are all there
        commit.append("results", kept.withColumns({"batch_id": F.lit(a.batch), "submitted_at": F.lit(a.now)}))
        every = done.unionByName(commit.written("results"))
        if not route.batches(queue, every).where("status = 'pending'").limit(1).count():
            commit.replace("payloads", _payloads(every))
    return do_status(spark, a)


def _records(results: DataFrame) -> DataFrame:
    """Results with the record's fields as columns."""
    kinds = schemas.record_type((*rules.CREATE_FIELDS, "change_type"))
    return results.where("decision in ('create', 'update')").select("candidate_id", "decision", F.col("decision").alias("flow"), F.from_json("record", kinds).alias("r")).select("candidate_id", "decision", "flow", "r.*")


def _payloads(results: DataFrame) -> DataFrame:
    return export.payloads(_records(results))


def do_validate_payload(spark: SparkSession, a: argparse.Namespace) -> int:
    text = spark.read.text(a.path, wholetext=True)
    found = text.select(validate.payload_file(a.flow, F.col("value"))).first()[0]
    print(json.dumps({"path": a.path, "errors": found}, ensure_ascii=False))
    return 2 if found else 0


def do_send(spark: SparkSession, a: argparse.Namespace) -> int:
    """One payload of a validated run to the address that an environment variable has; a confirmed send leaves a receipt."""
    folder, store = f"{a.run_dir}/pipeline", _pipeline(spark, a.run_dir)
    data = bytes(spark.read.format("binaryFile").load(a.payload).first().content) if a.payload else None
    manifest = _manifest(spark, a.run_dir).first()
    known = store.read("payloads", schema=PAYLOADS).where((F.col("flow") == a.flow) & (F.col("candidate_id") == a.candidate)).collect()
    if len(known) != 1:
        raise run.Rejected("no single validated payload of this flow and candidate")
    data = known[0].json.encode("utf-8") if data is None else data
    if wrong := spark.createDataFrame([(data.decode("utf-8"),)], "j string").select(validate.structure(F.col("j"), rules.CREATE_FIELDS if a.flow == "create" else rules.UPDATE_FIELDS)).first()[0]:
        raise run.Rejected("; ".join(wrong))
    if a.dry_run:
        print(json.dumps({"flow": a.flow, "candidate_id": a.candidate, "sha256": known[0].sha256, "bytes": len(data)}))
        return 0
    if manifest.state != "VALIDATED":
        raise run.Rejected(f"the run is {manifest.state}, not VALIDATED")
    sent = outbox.Payload(a.flow, a.candidate, f"payloads/{a.flow}/{a.candidate}.json", data, known[0].sha256)
    try:
        outbox.gate(sent, manifest.mode, a.live, known[0].path)
    except outbox.NotSent as e:
        raise run.Rejected(str(e)) from e
    url = os.environ.get(a.url_variable or f"NOTICE_{a.flow.upper()}_URL")
    try:
        if not url:
            raise outbox.NotSent("no address in the environment")
        receipt = outbox.send(sent, manifest.mode, outbox.http_post(url), a.now, a.live, known[0].path)
    except outbox.NotSent as e:
        print(f"error: {e}", file=sys.stderr)
        return 1
    path = f"{folder}/receipts/{a.flow}-{a.candidate}.json"
    versioned.put(spark, path, json.dumps(receipt, ensure_ascii=False) + "\n")
    print(json.dumps({"receipt": path}))
    return 0


def do_record_push(spark: SparkSession, a: argparse.Namespace) -> int:
    """History is written before the ledger, so that a run that breaks off between the two can be repeated. The receipt lies among the
    run's own, and the run has come so far."""
    folder, store, history = f"{a.run_dir}/pipeline", _pipeline(spark, a.run_dir), History(Store(spark, a.seen))
    if not config.within(a.receipt, f"{folder}/receipts"):
        raise run.Rejected("the receipt is not among the run's receipts")
    reached = _manifest(spark, a.run_dir).first()
    if reached.state not in ("VALIDATED", "PUSHED"):
        raise run.Rejected(f"the run is {reached.state}: nothing can have been sent")
    receipts = files.read_json(spark, a.receipt, schemas.RECEIPT)
    day = os.path.basename(a.run_dir)
    commit, past = store.begin(), history.store.begin()
    ledger, seen = commit.read("ledger", schemas.LEDGER), history.rows(past)
    queries = commit.read("queue").select("candidate_id", "found_by_query")
    records = _records(commit.read("results")).join(queries, "candidate_id")
    replayed = state.replay(receipts, ledger).where("action <> 'append'").limit(1).count() == 1
    got = run.confirm(receipts, commit.read("payloads", PAYLOADS), ledger, seen, records, reached.mode, day)
    if not replayed:
        with past:
            history.append(past, got.creates, got.updates, day)
        with commit:
            commit.append("ledger", got.ledger, schemas.LEDGER)
        history.compact(a.compact)
    if a.stats:
        stats = spark.read.schema(schemas.QUERY_STATS).parquet(a.stats)
        rows = state.pushed_stats(stats.where(F.col("day") == day), store.read("ledger", schema=schemas.LEDGER), day)
        with store.begin() as counted:
            counted.replace("stats", rows)
        versioned.replace_day(store.read("stats"), a.stats)
    print(json.dumps(report.compact(_manifest(spark, a.run_dir)) | {"idempotent": replayed}, ensure_ascii=False))
    return 0


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="noticeflow")
    sub = out.add_subparsers(dest="command", required=True)
    s = sub.add_parser("search")
    s.add_argument("--heading", default="## 5.")
    for name in ("--config", "--query-list", "--queries", "--endpoint", "--time-range", "--sites", "--block-hosts", "--industry", "--content-format", "--fixture"):
        s.add_argument(name)
    s.add_argument("--query", action="append")
    s.add_argument("--key-variable", default="NOTICE_SEARCH_KEY")
    s.add_argument("--count", type=int)
    s.add_argument("--auth-level", type=int)
    s.add_argument("--need-url", type=int)
    s.add_argument("--need-content", type=int)
    s.add_argument("--out", default="runs")
    s.add_argument("--today", default=str(datetime.date.today()))
    s.add_argument("--report-limit", type=int, default=20)
    for name in ("--report-all", "--no-stats", "--dry-run"):
        s.add_argument(name, action="store_true")
    s.set_defaults(do=do_search)
    for name, do in (("prepare", do_prepare), ("status", do_status), ("next-batch", do_next_batch), ("submit-batch", do_submit_batch), ("record-push", do_record_push)):
        p = sub.add_parser(name)
        p.add_argument("run_dir")
        p.set_defaults(do=do)
        if name == "prepare":
            p.add_argument("--seen", required=True)
            p.add_argument("--mode", default="report-only")
            p.add_argument("--batch-size", type=int, default=5)
            p.add_argument("--force", action="store_true")
            p.add_argument("--index", help="JSON lines instead of the search's index")
            p.add_argument("--contents", help="JSON lines instead of the search's contents")
        if name == "submit-batch":
            p.add_argument("--batch", required=True)
            p.add_argument("--results", required=True)
            p.add_argument("--engine", required=True, help="pattern of the search engine's names")
            p.add_argument("--now", default=datetime.datetime.now().astimezone().isoformat(timespec="seconds"))
        if name == "record-push":
            p.add_argument("--receipt", required=True)
            p.add_argument("--seen", required=True)
            p.add_argument("--stats")
            p.add_argument("--compact", type=int, default=10_000, help="log entries from which on history is compacted")
    p = sub.add_parser("send", help="the address comes from the environment only")
    p.add_argument("run_dir")
    p.add_argument("--flow", choices=("create", "update"), required=True)
    p.add_argument("--candidate", required=True)
    p.add_argument("--payload", help="a file with the bytes to send; by default those of the run")
    p.add_argument("--url-variable")
    p.add_argument("--now", default=datetime.datetime.now().astimezone().isoformat(timespec="seconds"))
    for name in ("--live", "--dry-run"):
        p.add_argument(name, action="store_true")
    p.set_defaults(do=do_send)
    p = sub.add_parser("validate-payload")
    p.add_argument("--flow", choices=("create", "update"), required=True)
    p.add_argument("path")
    p.set_defaults(do=do_validate_payload)
    return out


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    spark = spark or SparkSession.builder.appName("noticeflow").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if hasattr(a, "run_dir"):
        a.run_dir = config.run_folder(a.run_dir)
    try:
        return a.do(spark, a)
    except (run.Rejected, Conflict, ValueError, FileNotFoundError) as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
