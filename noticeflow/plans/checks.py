"""Queries of the rules and validators, and SQL with the same rows.

The fixture tables have no notices: rows become notices by their values or their number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T
from ..functions import time as D
from ..operators import cluster, contract, dedup, match, route, state, validate
from ..sinks import history as history_table
from ..sources import files
from . import report
from .queries import AS_OF, EXCLUSIONS, INTENT, UPDATES as WORDS, _order_records, candidates, history, hits, table
from .sql import _BATCH, _CAND, _DEDUP, _FP, _ORD, _SEEN, _TITLE

DAY = "1998-01-01"


def _kinds(number: Column, texts: list[str | None]) -> Column:
    """The text of a row's kind, the kinds taking turns by number."""
    return F.element_at(F.array(*[F.lit(x) for x in texts]).cast("array<string>"), (F.pmod(number, F.lit(len(texts))) + 1).cast("int"))


def required_evidence(s, d):
    """Documents whose languages and sources are the fields with evidence."""
    proof = F.to_json(F.struct(F.create_map("lang", F.lit("seen"), "source", F.lit("seen")).alias("field_evidence")))
    docs = table(s, d, "documents").where("lang is not null and source is not null")
    return docs.select("doc_id", F.array_join(validate.evidenced(proof, F.array(F.lit("en"), F.lit("src1"), F.lit("src2"))), "; ").alias("errors"))


def fallback_check(s, d):
    """Pages as candidates that rest on search content, in turn with one fault each."""
    pages = candidates(s, d).select("ord", "candidate_id", "url", "content_path", F.lit("医院采购公告").alias("title"))
    record = F.to_json(F.struct(F.lit("manual").alias("status"), F.when(F.col("ord") % 6 == 1, F.lit("http://else.example/")).otherwise(F.col("url")).alias("source_url"), F.lit("甲引擎 打不开 人工").alias("notes"), F.when(F.col("ord") % 6 == 2, "酶标仪").otherwise("总IgE试剂").alias("matched_category")))
    evidence = F.to_json(F.struct(F.lit("search_content").alias("verification_level"), F.when(F.col("ord") % 6 == 3, "x").otherwise(F.col("content_path")).alias("content_path"), F.when(F.col("ord") % 6 == 4, "given").alias("content_sha256")))
    decision = F.when(F.col("ord") % 6 == 5, "update").otherwise("create")
    rows = pages.select("candidate_id", "title", "url", "content_path", decision.alias("decision"), record.alias("record"), evidence.alias("evidence"), F.lit("").alias("summary"), F.lit("总IgE 试剂").alias("content"), F.encode("url", "utf-8").alias("content_bytes"))
    out = validate.search_fallback(rows, "甲引擎")
    return out.select("candidate_id", F.array_join("fallback_errors", "; ").alias("errors"), "content_sha256", F.array_join("category_signals", ",").alias("signals"))


def query_subset(s, d):
    q = table(s, d, "orders").select(F.col("o_orderkey").cast("int").alias("query_no"))
    return validate.select_queries(s, q, "1-40,100, 200-300,7")


def query_composition(s, d):
    """Queries of one to nine words of two groups, some without a word of intent."""
    k = F.col("p_partkey")
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), k % 8 + 1), lambda i: F.when((k % 3 == 0) & (i == 2), "red").otherwise("blue")))
    q = table(s, d, "part").select(k.cast("int").alias("query_no"), F.concat(words, F.when(k % 5 == 0, "").otherwise(" 采购")).alias("query"))
    return validate.query_composition(q, s.createDataFrame([("blue", "A"), ("red", "B")], "word string, grp string"))


def failed_queries(s, d):
    e = table(s, d, "events").select("event_id", F.when(F.col("event_type") == "signup", "timeout").when(F.col("event_type") == "purchase", "").alias("error"))
    return dedup.successes(e).select("event_id")


def contribution(s, d):
    h = hits(s, d)
    return dedup.contribution(dedup.query_stats(h, dedup.dedup_hits(h), h.select("query_no")))


def light_index(s, d):
    p = candidates(s, d).select(
        "ord", "url", "title", "site_name", F.lit("1998-01-01").alias("publish_time"), F.lit(1).alias("auth_info_level"), F.lit("").alias("auth_info_des"), F.lit(0.5).alias("rank_score"),
        "found_by_query", F.when(F.col("ord") % 2 == 0, F.col("title")).otherwise("").alias("summary"), F.col("url").alias("content"),
    )
    return dedup.light_index(p).select("ord", "candidate_id", "title_fingerprint", "teaser", "content_path")


def content_identity(s, d):
    p = candidates(s, d).select("ord", "candidate_id", "url")
    there = p.where("ord % 4 <> 1").select("candidate_id", F.lit("t").alias("title"), F.when(F.col("ord") % 4 == 2, F.lit("http://else.example/")).otherwise(F.concat("url", F.lit("#top"))).alias("source_url"), F.lit("s").alias("summary"), F.lit("c").alias("content"))
    return files.with_content(p, there).select("candidate_id", "summary", "content_error")


def first_row(s, d):
    return files.find(candidates(s, d), "P000007").select("candidate_id", "title")


def stale_notices(s, d):
    o = table(s, d, "orders").select("o_orderkey", F.concat(F.lit("ZB"), F.date_format("o_orderdate", "yyyyMM")).alias("number"), F.when(F.col("o_orderkey") % 3 == 0, "null").otherwise("1997-01-01").alias("publish_date"), F.when(F.col("o_orderkey") % 2 == 0, "null").alias("deadline"))
    return o.select("o_orderkey", D.stale(F.col("number"), F.col("publish_date"), F.col("deadline"), F.to_timestamp(F.lit(AS_OF))).alias("stale"))


def _notices(s, d):
    kind = F.when(F.col("o_orderstatus") == "F", "中标公告").when(F.col("o_orderstatus") == "P", "单一来源公示").otherwise("招标公告")
    return table(s, d, "orders").select("o_orderkey", kind.alias("notice_type"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("deadline"))


def notice_status(s, d):
    return _notices(s, d).select("o_orderkey", contract.status_of(F.col("notice_type"), F.col("deadline"), F.to_timestamp(F.lit(AS_OF))).alias("status"))


def change_type(s, d):
    title = _kinds(F.col("o_orderkey"), ["成交公告", "废标公告", "更正公告", "更正公告"])
    c = contract.change_of(title, F.col("deadline"), F.when(F.col("o_orderkey") % 8 == 2, F.col("deadline")).otherwise("2000-01-01"))
    return _notices(s, d).select("o_orderkey", c["change_type"].alias("change_type"), c["status"].alias("status"))


def category_choice(s, d):
    found = F.array_compact(F.array(F.when(F.col("p_size") % 2 == 0, "酶标仪"), F.when(F.col("p_size") % 3 == 0, "总IgE试剂")))
    c = contract.best_category(found, F.when(F.col("p_size") % 5 == 0, "试剂一批").otherwise("试剂"))
    return table(s, d, "part").select("p_partkey", c["matched_category"].alias("matched"), c["category"].alias("category"), c["match_level"].alias("level"), F.array_join(c["others"], ",").alias("others"))


def masked_defaults(s, d):
    k = F.col("c_custkey")
    c = table(s, d, "customer").select("c_custkey", F.when(k % 2 == 0, F.col("c_name")).alias("purchaser"), F.when(k % 3 == 0, F.col("c_mktsegment")).alias("title"), F.when(k % 5 == 0, F.col("c_acctbal")).alias("budget"), F.lit(None).cast("string").alias("region"), F.lit(None).cast("boolean").alias("requires_manual"))
    return contract.masked_defaults(c)


def iso_times(s, d):
    ts, n = F.col("ts"), F.col("event_id")
    local = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(n % 6 == 0, F.concat(local, F.lit("Z"))).when(n % 6 == 1, F.concat(local, F.lit("+08:00"))).when(n % 6 == 2, F.concat(F.date_format(ts, "yyyyMMdd'T'HHmmss"), F.lit("-0530")))
    text = text.when(n % 6 == 3, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm"), F.lit("+08"))).when(n % 6 == 4, local).otherwise("null")
    return table(s, d, "events").select("event_id", F.unix_timestamp(D.zoned(text)).alias("at"))


def days_left(s, d):
    return table(s, d, "orders").select("o_orderkey", D.days_left(D.deadline(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")), F.to_timestamp(F.lit(AS_OF))).alias("days"))


def record_ids(s, d):
    made = T.record_id(F.to_date(F.lit(DAY)), F.col("url"))
    given = F.when(F.col("page_id") % 3 == 0, F.replace(made, F.lit("-"), F.lit("-0"))).otherwise(made)
    return table(s, d, "pages").select("page_id", made.alias("record_id"), T.is_record_id(given).alias("good"))


def missing_targets(s, d):
    o = table(s, d, "orders").select(F.col("o_orderkey").alias("record_id"), "o_custkey")
    return state.missing_targets(o, table(s, d, "lineitem").select(F.col("l_orderkey").alias("record_id")).where("record_id % 3 = 0"))


def push_permission(s, d):
    """Receipts of both flows in a mode that sends updates only."""
    p = table(s, d, "pages").select(F.when(F.col("page_id") % 2 == 0, "create").otherwise("update").alias("flow"), F.col("page_id").cast("string").alias("candidate_id"))
    p = p.select("flow", "candidate_id", F.concat(F.lit("payloads/"), "flow", F.lit("/"), "candidate_id", F.lit(".json")).alias("path"), F.lit("s").alias("sha256"))
    r = p.select("flow", "candidate_id", F.col("path").alias("payload_path"), F.col("sha256").alias("payload_sha256"), F.lit(200).alias("http_status"), F.lit(0).alias("remote_code"))
    return state.check_receipts(r, p, "update-only").select("candidate_id", F.array_join("errors", "; ").alias("errors"))


def ledger_append(s, d):
    e = table(s, d, "events").select(F.col("event_type").alias("flow"), F.col("user_id").cast("string").alias("candidate_id"))
    old = e.where("flow = 'purchase'").distinct().withColumn("run_id", F.lit("old"))
    return state.append_ledger(old, e.withColumn("run_id", F.lit("new"))).groupBy("flow", "run_id").agg(F.count("*").alias("n"))


def typed_attachments(s, d):
    """Links of two types, which those that end in the or de are taken for."""
    html = F.replace(F.replace(F.col("html"), F.lit('/the"'), F.lit('/the.PDF"')), F.lit('/de"'), F.lit('/de.docx"'))
    return contract.attachments(table(s, d, "pages").withColumn("html", html), ("pdf", "docx"), ("the",)).select("page_id", "ord", "url")


def sized_attachments(s, d):
    """Links of pages, where the largest of the pages that they lead to is the main one, unless one ends in html."""
    pages = table(s, d, "pages")
    return contract.attachments(pages, None, (".html",), pages.select("url", F.octet_length("html").alias("length")))


def _orders_as_records(s, d):
    o = table(s, d, "orders")
    given = {"record_id": F.col("o_orderkey").cast("string"), "project_code": F.col("o_custkey").cast("string"), "purchaser": F.date_format("o_orderdate", "yyyyMMdd"), "source_url": F.concat(F.lit("http://x.example/"), F.col("o_orderkey").cast("string")), "budget": F.col("o_totalprice"), "days_left": F.lit(0), "award_amount": F.lit(0.0), "requires_manual": F.lit(False)}
    return o.select(F.col("o_orderkey").alias("k"), F.col("o_orderkey").cast("string").alias("candidate_id"), *[given.get(f, F.lit("null")).alias(f) for f in rules.CREATE_FIELDS])


def record_push(s, d):
    """Orders to be created, of which every sixth is in history as it is, and every other of these with another budget; where two
    orders of a customer are of one day, both are refused."""
    r = _orders_as_records(s, d)
    key = state.dedup_key(F.col("project_code"), F.col("purchaser"), F.col("source_url"))
    seen = r.where("k % 6 = 0").withColumn("budget", F.when(F.col("k") % 12 == 0, F.col("budget") + 1).otherwise(F.col("budget"))).withColumn("dedup_key", key).withColumn("pushed", F.lit(True))
    return state.create_actions(r, seen.drop("k", "candidate_id"))


def update_fold(s, d):
    """Line items as updates of their orders, the last by date and line counting, with the lines as queries."""
    u = table(s, d, "lineitem").select(F.col("l_orderkey").alias("record_id"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("confirmed_at"), F.format_string("%02d-%08d", "l_linenumber", "l_partkey").alias("candidate_id"), F.col("l_linestatus").alias("status"), F.array("l_linenumber").alias("found_by_query"))
    return state.fold_updates(u)


def history_log(s, d):
    """Orders as history: those with an even number its base, every other of the rest created since; each line of an order is an update
    in the log, in the order of the lines, of which each gives another field."""
    r = _order_records(s, d).withColumn("n", F.lit(0)).withColumn("c", F.lit(""))
    line, ship = F.col("l_linenumber"), F.date_format("l_shipdate", "yyyy-MM-dd")
    updates = table(s, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("record_id"), line.alias("n"), F.concat_ws("/", F.format_string("%08d/%08d", "l_partkey", "l_suppkey"), ship).alias("c"), F.array(line).alias("found_by_query"),
        F.when(line % 2 == 0, F.col("l_linestatus")).alias("status"), F.when(line % 2 == 1, ship).alias("deadline"), F.when(line % 3 == 0, F.col("l_extendedprice")).alias("budget"),
    )
    log = history_table.entries(r.where("_key % 4 = 1"), updates, "1998-02-02", F.format_string("c%02d/%s", "n", "c"))
    base = r.where("_key % 2 = 0").withColumn("seen_ord", F.format_string("%020d", "_key")).select(*[f.split(" ")[0] for f in history_table.PLACED.split(", ")])
    return history_table.merged(base, log).select("record_id", "status", "deadline", "budget", "dedup_key", "first_seen", "last_seen", "pushed", "found_by_query")


def seen_title_equal(s, d):
    return match.by_title(candidates(s, d), history(s, d), 1.0)


def route_all_tiers(s, d):
    m = match.match_seen(cluster.cluster(candidates(s, d)), history(s, d), WORDS)
    return route.route(m, EXCLUSIONS, INTENT, WORDS).select("candidate_id", "seen_match_reason", "route")


def run_manifest(s, d):
    """The run of all pages in batches of five, the first twenty pages done."""
    pages = candidates(s, d)
    b = route.assign_batches(pages, 5)
    funnel = pages.agg(F.count("*").alias("indexed"))
    h = hits(s, d)
    m = report.manifest("r1", "daily-push", 5, funnel, route.batches(b, b.where("ord < 20").select("batch_id")), dedup.run_totals(h, h.select("query_no")))
    return m.select("run_id", "indexed", "batches", "batches_done", "next_batch", "state", "next_action", "raw", "candidates")


def authority_preview(s, d):
    """The first pages of each authority, as the report shows them."""
    return dedup.preview(candidates(s, d).where("site_name <> ''"), 7).select("site_name", "url")


QUERIES = {f.__name__: f for f in (
    required_evidence, fallback_check, query_subset, query_composition, failed_queries, contribution, light_index,
    content_identity, first_row, stale_notices, notice_status, change_type, category_choice, masked_defaults, iso_times, days_left, record_ids, missing_targets, push_permission, ledger_append,
    typed_attachments, sized_attachments, record_push, update_fold, history_log, seen_title_equal, route_all_tiers, run_manifest, authority_preview,
)}

_ABS = """CASE WHEN regexp_matches(href, '^(?i)[a-z][a-z0-9+.-]*:') THEN href WHEN starts_with(href, '/') THEN regexp_extract(page, '^(https?://[^/?#]*)', 1) || href
    ELSE regexp_replace(regexp_replace(page, '[?#].*$', ''), '([^/:])/[^/]*$', '\\1') || '/' || href END"""
_LETTERS = " || ".join(f"substr('ABCDEFGHJKLMNPQRSTUVWXYZ23456789', CAST(CAST('0x' || substr(sha256(url), {1 + 2 * k}, 2) AS INTEGER) % 32 + 1 AS INTEGER), 1)" for k in range(6))
_KEYS = "o AS (SELECT o_orderkey AS k, o_custkey || '|' || strftime(o_orderdate, '%Y%m%d') AS dk FROM orders)"

SQL = {
    "required_evidence": """WITH m AS (SELECT doc_id, [x FOR x IN ['en', 'src1', 'src2'] IF x <> lang AND x <> source] AS m FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL)
        SELECT doc_id, CASE WHEN len(m) > 0 THEN 'no evidence: ' || array_to_string(m, ',') ELSE '' END AS errors FROM m""",
    "fallback_check": """WITH p AS (SELECT *, printf('P%06d', page_id) AS id, page_id % 6 AS k FROM pages)
        SELECT id AS candidate_id, CASE k WHEN 1 THEN 'source_url is not the candidate''s' WHEN 2 THEN 'category is not of: 总IgE试剂' WHEN 3 THEN 'content_path is not the candidate''s'
            WHEN 4 THEN 'generated keys given: content_sha256' WHEN 5 THEN 'only for create with status=manual' ELSE '' END AS errors,
            CASE WHEN k = 0 THEN sha256(url) END AS content_sha256, CASE WHEN k = 0 THEN '总IgE试剂' END AS signals FROM p""",
    "query_subset": "SELECT CAST(o_orderkey AS INTEGER) AS query_no FROM orders WHERE o_orderkey BETWEEN 1 AND 40 OR o_orderkey = 100 OR o_orderkey BETWEEN 200 AND 300",
    "query_composition": """WITH q AS (SELECT CAST(p_partkey AS INTEGER) AS query_no, p_partkey % 8 + 1 AS n, p_partkey % 3 = 0 AND p_partkey % 8 >= 1 AS red, p_partkey % 5 = 0 AS none FROM part)
        SELECT query_no, 'too many category words' AS error FROM q WHERE n > 6 UNION ALL SELECT query_no, 'not one word of intent' FROM q WHERE none UNION ALL SELECT query_no, 'several groups' FROM q WHERE red""",
    "failed_queries": "SELECT event_id FROM events WHERE event_type <> 'signup'",
    "contribution": f"""WITH {_DEDUP}, u AS (SELECT found_by_query[1] AS query_no, count(*) AS u FROM dd WHERE len(found_by_query) = 1 GROUP BY 1)
        SELECT DISTINCT query_no, coalesce(u, 0) > 0 AS contributes FROM h LEFT JOIN u USING (query_no)""",
    "light_index": f"""SELECT page_id AS ord, 'C' || upper(substr(sha256(url), 1, 12)) AS candidate_id, {_FP.format(_TITLE)} AS title_fingerprint,
        CASE WHEN length(x) <= 240 THEN x ELSE substr(x, 1, 239) || '…' END AS teaser, 'content/C' || upper(substr(sha256(url), 1, 12)) || '.json' AS content_path
        FROM (SELECT *, trim(replace(CASE WHEN page_id % 2 = 0 AND {_TITLE} <> '' THEN {_TITLE} ELSE url END, chr(10), ' ')) AS x FROM pages)""",
    "content_identity": """SELECT printf('P%06d', page_id) AS candidate_id, CASE WHEN page_id % 4 <> 1 THEN 's' END AS summary,
        CASE page_id % 4 WHEN 1 THEN 'no content' WHEN 2 THEN 'content of another URL' END AS content_error FROM pages""",
    "first_row": f"WITH {_CAND} SELECT candidate_id, title FROM c WHERE candidate_id = 'P000007'",
    "stale_notices": "SELECT o_orderkey, year(o_orderdate) <= 1996 AND o_orderkey % 3 = 0 AS stale FROM orders",
    "notice_status": "SELECT o_orderkey, CASE WHEN o_orderstatus IN ('F', 'P') OR CAST(o_orderdate AS DATE) < DATE '1998-01-01' THEN 'intel' ELSE 'active' END AS status FROM orders",
    "change_type": """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN 'status_change' WHEN o_orderkey % 8 = 2 OR CAST(o_orderdate AS DATE) = DATE '2000-01-01' THEN 'correction' ELSE 'deadline_change' END AS change_type,
        CASE o_orderkey % 4 WHEN 0 THEN 'closed' WHEN 1 THEN 'canceled' END AS status FROM orders""",
    "category_choice": """SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '总IgE试剂' WHEN p_size % 2 = 0 THEN '酶标仪' ELSE '其他' END AS matched, CASE WHEN p_size % 3 = 0 THEN '试剂' WHEN p_size % 2 = 0 THEN '仪器' ELSE '其他' END AS category,
        CASE WHEN p_size % 2 <> 0 AND p_size % 3 <> 0 THEN 'unknown' WHEN p_size % 5 = 0 THEN 'partial' ELSE 'full' END AS level, CASE WHEN p_size % 6 = 0 THEN '酶标仪' ELSE '' END AS others FROM part""",
    "masked_defaults": f"""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE '{rules.MASKED_PURCHASER}' END AS purchaser, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'null' END AS title,
        CASE WHEN c_custkey % 5 = 0 THEN c_acctbal ELSE 0.0 END AS budget, '{rules.NO_REGION}' AS region, false AS requires_manual FROM customer""",
    "iso_times": """SELECT event_id, CASE event_id % 6 WHEN 0 THEN s WHEN 1 THEN s - 28800 WHEN 2 THEN s + 19800 WHEN 3 THEN s - s % 60 - 28800 END AS "at"
        FROM (SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)""",
    "days_left": "SELECT o_orderkey, CAST(greatest(date_diff('day', DATE '1998-01-01', CAST(o_orderdate AS DATE)), 0) AS INTEGER) AS days FROM orders",
    "record_ids": f"SELECT page_id, 'T19980101-' || {_LETTERS} AS record_id, page_id % 3 <> 0 AS good FROM pages",
    "missing_targets": "SELECT o_orderkey AS record_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_orderkey % 3 = 0)",
    "push_permission": "SELECT CAST(page_id AS VARCHAR) AS candidate_id, CASE WHEN page_id % 2 = 0 THEN 'flow not allowed in this mode' ELSE '' END AS errors FROM pages",
    "ledger_append": "SELECT event_type AS flow, CASE WHEN event_type = 'purchase' THEN 'old' ELSE 'new' END AS run_id, count(DISTINCT user_id) AS n FROM events GROUP BY event_type",
    "typed_attachments": f"""WITH p AS (SELECT page_id, url AS page, regexp_extract_all(replace(replace(html, '/the"', '/the.PDF"'), '/de"', '/de.docx"'), '(?i)href="([^"]*\\.(?:pdf|docx))"', 1) AS x FROM pages),
        l AS (SELECT page_id, page, unnest(x) AS href, generate_subscripts(x, 1) - 1 AS ord FROM p)
        SELECT page_id, CAST(ord AS INTEGER) AS ord, {_ABS} AS url FROM l""",
    "sized_attachments": f"""WITH l AS (SELECT page_id, url AS page, unnest(regexp_extract_all(html, '(?i)href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '(?i)href="([^"]*)"', 1), 1) - 1 AS ord FROM pages),
        a AS (SELECT page_id, CAST(ord AS INTEGER) AS ord, {_ABS} AS url FROM l), z AS (SELECT url, max(CAST(strlen(html) AS INTEGER)) AS length FROM pages GROUP BY url)
        SELECT page_id, ord, url, length, row_number() OVER (PARTITION BY page_id ORDER BY contains(url, '.html') DESC, CASE WHEN NOT contains(url, '.html') THEN length END DESC NULLS LAST, ord) = 1 AS main FROM a LEFT JOIN z USING (url)""",
    "record_push": f"""WITH {_KEYS}, t AS (SELECT dk FROM o GROUP BY dk HAVING count(*) > 1)
        SELECT CAST(k AS VARCHAR) AS candidate_id, CASE WHEN dk IN (SELECT dk FROM t) OR k % 12 = 0 THEN 'conflict' WHEN k % 6 = 0 THEN 'recovered' ELSE 'append' END AS action FROM o""",
    "update_fold": """SELECT l_orderkey AS record_id, strftime(max(l_shipdate), '%Y-%m-%d') AS confirmed_at, arg_max(c, strftime(l_shipdate, '%Y-%m-%d') || c) AS candidate_id, arg_max(l_linestatus, strftime(l_shipdate, '%Y-%m-%d') || c) AS status, list_sort(list_distinct(list(l_linenumber))) AS found_by_query
        FROM (SELECT *, printf('%02d-%08d', l_linenumber, l_partkey) AS c FROM lineitem) GROUP BY l_orderkey""",
    "history_log": f"""WITH {_ORD}, l AS (SELECT *, printf('%02d/%08d/%08d/', l_linenumber, l_partkey, l_suppkey) || strftime(l_shipdate, '%Y-%m-%d') AS p FROM lineitem),
        u AS (SELECT l_orderkey AS k, arg_max(l_linestatus, p) FILTER (l_linenumber % 2 = 0) AS status, arg_max(strftime(l_shipdate, '%Y-%m-%d'), p) FILTER (l_linenumber % 2 = 1) AS deadline,
            arg_max(l_extendedprice, p) FILTER (l_linenumber % 3 = 0) AS budget, list(l_linenumber) AS q FROM l GROUP BY 1)
        SELECT record_id, coalesce(u.status, o.status) AS status, coalesce(u.deadline, o.deadline) AS deadline, coalesce(u.budget, o.budget) AS budget, dedup_key,
            CASE WHEN k % 2 = 0 THEN '1998-01-01' ELSE '1998-02-02' END AS first_seen, CASE WHEN k % 2 = 0 AND q IS NULL THEN '1998-01-01' ELSE '1998-02-02' END AS last_seen, true AS pushed,
            list_sort(list_distinct(list_concat([CAST(k % 5 AS INTEGER)], coalesce(q, [])))) AS found_by_query FROM o LEFT JOIN u USING (k) WHERE k % 2 = 0 OR k % 4 = 1""",
    "seen_title_equal": f"WITH {_CAND}, {_SEEN} SELECT c.candidate_id, seen_ord, record_id FROM c JOIN (SELECT *, {_FP.format('title')} AS fp2 FROM seen) s ON c.fp = s.fp2 WHERE length(c.fp) >= 10",
    "run_manifest": f"""WITH {_BATCH}, {_DEDUP}, g AS (SELECT batch_id, min(page_id) < 20 AS done FROM b GROUP BY 1)
        SELECT 'r1' AS run_id, (SELECT count(*) FROM pages) AS indexed, count(*) AS batches, count(*) FILTER (done) AS batches_done, min(batch_id) FILTER (NOT done) AS next_batch, 'VERIFYING' AS state, 'SUBMIT_BATCHES' AS next_action,
        (SELECT count(*) FROM h) AS raw, (SELECT count(*) FROM dd) AS candidates FROM g""",
    "authority_preview": f"WITH {_CAND} SELECT regexp_extract(url, '^https?://([^/?#]*)', 1) AS site_name, url FROM c WHERE regexp_extract(url, '^https?://([^/?#]*)', 1) <> '' ORDER BY ord LIMIT 7",
}
