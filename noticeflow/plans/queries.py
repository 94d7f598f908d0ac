"""One query for each operator over the fixture tables, and SQL that gives the same rows.

The fixture tables hold invented Latin prose, so that rules are given as fixture vocabulary; domain rules are held by tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T
from ..functions import url as U
from ..functions import variant as V
from ..functions.similarity import similarity
from ..operators import cluster, contract, dedup, export, match, route, state, validate
from ..sinks import versioned

EXCLUSIONS = (rules.Rule("license", "license"), rules.Rule("marks", "%%%|###"), rules.Rule("shout", "!!"))
INTENT = ("the", "le", "der", "el")
UPDATES = ("of", "que")
SIGNALS = (rules.Rule("mail", "@"), rules.Rule("phone", r"[0-9]{3}[- ][0-9]{3,4}"), rules.Rule("licence", "licensed under"), rules.Rule("table", r" \| ", (" | ",)))
AS_OF = "1998-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as candidates; found_by_query is the page's number modulo 7."""
    title = T.html_title(F.col("html"))
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("ord"), F.format_string("P%06d", "page_id").alias("candidate_id"), title.alias("title"), T.title_fingerprint(title).alias("title_fingerprint"),
        F.regexp_extract("url", "^https?://([^/?#]*)", 1).alias("site_name"), "url", F.array((F.col("page_id") % 7).cast("int")).alias("found_by_query"),
        title.alias("teaser"), F.format_string("content/P%06d.json", "page_id").alias("content_path"),
    )


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).where("ord % 3 = 0").select(
        F.col("ord").alias("seen_ord"), F.col("candidate_id").alias("record_id"), F.col("url").alias("source_url"), "title", F.substring("title", 1, 12).alias("project_code")
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as hits: the source's number is the query, the text's hash the URL."""
    return table(spark, sf_dir, "documents").select(
        F.regexp_extract("source", "([0-9]+)", 1).cast("int").alias("query_no"), F.col("doc_id").alias("pos"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("url"),
        F.col("lang").alias("site_name"), F.col("doc_id").cast("string").alias("title"), F.lit("").alias("error"),
    )


def url_normalize(s, d):
    return table(s, d, "pages").select("page_id", U.normalize_url(F.col("url")).alias("url_norm"))


def title_fingerprint(s, d):
    title = T.html_title(F.col("html"))
    return table(s, d, "pages").select("page_id", T.title_fingerprint(title).alias("fingerprint"), T.title_base(title, UPDATES).alias("base"))


def candidate_id(s, d):
    return table(s, d, "pages").select("page_id", T.candidate_id(F.col("url")).alias("candidate_id"))


def teaser(s, d):
    return table(s, d, "documents").select("doc_id", T.teaser(F.lit(""), F.col("text"), 240).alias("teaser"))


def hit_dedup(s, d):
    return dedup.dedup_hits(hits(s, d)).select("url", "title", "site_name", "found_by_query")


def query_attribution(s, d):
    h = hits(s, d)
    return dedup.redundancy(dedup.query_stats(h, dedup.dedup_hits(h), h.select("query_no")))


def run_totals(s, d):
    h = hits(s, d)
    return dedup.run_totals(h, h.select("query_no"))


def title_cluster(s, d):
    c = cluster.cluster(candidates(s, d))
    return c.select("candidate_id", "title", "found_by_query", "cluster_members", F.size("alternate_sources").alias("n_alternates"))


def seen_url_match(s, d):
    m = match.match_seen(candidates(s, d), history(s, d), ("no such word",), fuzzy=False)
    return m.select("candidate_id", "matched_seen_record_ids", "seen_match_reason")


def seen_code_match(s, d):
    return match.by_code(candidates(s, d), history(s, d))


def seen_fuzzy_match(s, d):
    return match.by_title(candidates(s, d), history(s, d), 0.86)


def title_ratio(s, d):
    """How alike the titles of pages are to those of the next page."""
    c = candidates(s, d)
    after = c.select((F.col("ord") - 1).alias("ord"), F.col("title_fingerprint").alias("b"))
    return c.select("ord", "candidate_id", F.col("title_fingerprint").alias("a")).join(after, "ord").select("candidate_id", similarity(F.col("a"), F.col("b")).alias("ratio"))


def _routed(s, d):
    c = cluster.cluster(candidates(s, d))
    return route.route(match.match_seen(c, history(s, d), UPDATES, fuzzy=False), EXCLUSIONS, INTENT, UPDATES)


def route_cases(s, d):
    return _routed(s, d).select("candidate_id", "seen_match_reason", "route", "skip_reason", "flow_hint")


def route_outputs(s, d):
    """What goes to each of the four outputs of a run."""
    parts = [rows.select("candidate_id", F.lit(name).alias("output")) for name, rows in versioned.routes(_routed(s, d)).items()]
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


def route_funnel(s, d):
    pages = candidates(s, d).agg(F.count("*").alias("n"))
    return route.funnel(_routed(s, d).crossJoin(F.broadcast(pages)), F.col("n"))  # one row


def clear_exclude(s, d):
    return table(s, d, "documents").select("doc_id", T.first_match(F.col("text"), EXCLUSIONS).alias("excluded"))


def intent_filter(s, d):
    return table(s, d, "documents").where(T.has_any(F.col("text"), ("trash", "pathetic", "licensed"))).select("doc_id")


def category_signals(s, d):
    return table(s, d, "documents").select("doc_id", T.all_matches(F.col("text"), SIGNALS).alias("signals"))


def search_evidence(s, d):
    contents = table(s, d, "pages").select(F.format_string("P%06d", "page_id").alias("candidate_id"), F.lit("").alias("summary"), F.col("html").alias("content"))
    r = route.with_evidence(_routed(s, d), contents, SIGNALS)
    return r.where("route = 'create'").select("candidate_id", F.col("search_evidence.target_category_signals").alias("signals"), F.col("search_evidence.content_path").alias("content_path"))


def overdue_sweep(s, d):
    seen = _order_records(s, d).where("status = 'active'")
    return contract.close_overdue(seen, F.to_timestamp(F.lit(AS_OF))).select("record_id", "status", "change_type", "deadline", "budget")


def _order_records(s, d):
    """Orders as history: open ones active, the order's date as deadline."""
    o = table(s, d, "orders")
    status = F.when(F.col("o_orderstatus") == "O", "active").otherwise("closed")
    text = lambda f: F.lit("null").alias(f)
    given = {
        "record_id": F.col("o_orderkey").cast("string"), "status": status, "deadline": F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm"), "budget": F.col("o_totalprice"),
        "notice_type": F.col("o_orderpriority"), "days_left": F.lit(0), "requires_manual": F.lit(False), "award_amount": F.lit(0.0), "project_code": F.col("o_custkey").cast("string"),
        "purchaser": F.col("o_custkey").cast("string"), "source_url": F.concat(F.lit("http://x.example/"), F.col("o_orderkey").cast("string")),
    }
    cols = [given[f].alias(f) if f in given else text(f) for f in rules.CREATE_FIELDS]
    meta = [state.dedup_key(given["project_code"], given["purchaser"], given["source_url"]).alias("dedup_key"), F.lit("1998-01-01").alias("first_seen"), F.lit("1998-01-01").alias("last_seen"), F.lit(True).alias("pushed"), F.array((F.col("o_orderkey") % 5).cast("int")).alias("found_by_query")]
    return o.select(*cols, *meta, F.col("o_orderkey").alias("_key"))


def seen_upsert(s, d):
    r = _order_records(s, d)
    seen = r.where("_key % 2 = 0").drop("_key")
    creates = r.where("_key % 4 = 1").drop("dedup_key", "first_seen", "last_seen", "pushed", "_key")
    updates = r.where("_key % 6 = 0").select("record_id", *[F.lit("canceled").alias(f) if f == "status" else F.col(f) for f in rules.UPDATE_FIELDS if f not in ("record_id", "change_type")], F.array(F.lit(9)).alias("found_by_query"))
    out = state.upsert_seen(seen, creates, updates, "1998-02-02")
    return out.select("record_id", "status", "dedup_key", "first_seen", "last_seen", "pushed", "found_by_query")


def update_backfill(s, d):
    r = _order_records(s, d)
    changes = r.where("_key % 10 = 0").select("record_id", F.lit("status_change").alias("change_type"), F.lit("closed").alias("status"), F.when(F.col("_key") % 20 == 0, F.lit("2000-01-01")).alias("publish_date"))
    return state.backfill(changes, r).select("record_id", "change_type", "status", "publish_date", "notice_type", "deadline", "budget")


def region_lookup(s, d):
    n = table(s, d, "nation").where("n_nationkey % 5 <> 4").join(table(s, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("province"), F.col("r_name").alias("region"))
    return contract.with_region(table(s, d, "customer").select("c_custkey", "c_nationkey"), "c_nationkey", n, "none").select("c_custkey", "region")


def attachment_extract(s, d):
    return contract.attachments(table(s, d, "pages"), None, (".html", "/the"))


def batch_assign(s, d):
    return route.assign_batches(candidates(s, d), 5).select("candidate_id", "batch_id")


def batch_files(s, d):
    """Batch files: the candidates of each in their order, under the policy."""
    b = versioned.batch_files(route.assign_batches(candidates(s, d), 5))
    pages = F.transform("candidates", lambda x: F.get_json_object(x, "$.ord").cast("long"))
    return b.select("batch_id", F.size("candidates").cast("long").alias("n"), pages.alias("pages"), F.get_json_object("policy", "$.untrusted").isNotNull().alias("has_policy"))


def batch_status(s, d):
    b = route.assign_batches(candidates(s, d), 5)
    return route.batches(b, b.where("ord < 60").select("batch_id"))


def next_batch(s, d):
    return route.next_batch(batch_status(s, d))


def decision_counts(s, d):
    return export.counts(table(s, d, "orders").withColumn("decision", F.col("o_orderstatus")), "decision", ("F", "O", "P", "X"))


def result_summary(s, d):
    o = table(s, d, "orders").select(
        F.when(F.col("o_orderstatus") == "O", "create").when(F.col("o_orderstatus") == "F", "update").otherwise("exclude").alias("decision"),
        F.when(F.col("o_orderkey") % 3 == 0, "active").when(F.col("o_orderkey") % 3 == 1, "intel").otherwise("manual").alias("status"),
    )
    return export.summary(o)


def authority_histogram(s, d):
    j = table(s, d, "documents").select("doc_id").join(table(s, d, "labels").select("doc_id", F.col("quality").cast("string").alias("q")), "doc_id", "left")
    return dedup.histogram(j, F.col("q"), rules.NO_AUTHORITY)


def _daily(s, d):
    """Statistics by user and day, days without an event counting as 0: each user's days are made from their own rows."""
    e = table(s, d, "events").select("user_id", F.to_date("ts").alias("day"), (F.col("event_type") == "purchase").cast("long").alias("p"), (F.col("event_type") == "signup").cast("long").alias("g"))
    each = e.groupBy("user_id", "day").agg(F.sum("p").alias("unique"), F.sum("g").alias("pushed"))
    days = F.broadcast(e.agg(F.min("day").alias("a"), F.max("day").alias("b")))  # one row
    grid = e.select("user_id").distinct().crossJoin(days).select("user_id", F.explode(F.sequence("a", "b")).alias("day"))
    full = grid.join(each, ["user_id", "day"], "left")
    return full.select(F.col("user_id").alias("query_no"), F.date_format("day", "yyyy-MM-dd").alias("day"), F.coalesce("unique", F.lit(0)).alias("unique"), F.coalesce("pushed", F.lit(0)).alias("pushed"))


def retirement_window(s, d):
    return dedup.retirement(_daily(s, d), 7)


def ledger_idempotent(s, d):
    e = table(s, d, "events").select(F.col("event_type").alias("flow"), F.concat_ws("-", F.col("user_id").cast("string"), (F.col("event_id") % 3).cast("string")).alias("candidate_id"), F.sha2(F.col("user_id").cast("string"), 256).alias("payload_sha256"), F.col("event_id").alias("confirmed_at"))
    ledger = e.where("confirmed_at % 4 = 0").select("flow", "candidate_id", F.when(F.col("confirmed_at") % 8 == 0, F.lit("other")).otherwise(F.col("payload_sha256")).alias("payload_sha256"))
    one = ledger.groupBy("flow", "candidate_id").agg(F.min("payload_sha256").alias("payload_sha256"))
    return state.replay(e, one).groupBy("flow", "action").agg(F.count("*").alias("n"))


def stats_recompute(s, d):
    c = dedup.dedup_hits(hits(s, d)).select(F.lit("create").alias("flow"), F.col("url").alias("candidate_id"), "found_by_query", F.lit("today").alias("run_id"))
    days = hits(s, d).select("query_no").distinct()
    stats = days.select(F.lit("today").alias("day"), "query_no", F.lit(99).cast("long").alias("pushed")).union(days.select(F.lit("before"), "query_no", F.lit(5).cast("long")))
    return state.pushed_stats(stats, c, "today").select("day", "query_no", "pushed")


def push_counts(s, d):
    p = table(s, d, "orders").select(F.when(F.col("o_orderstatus") == "O", "create").otherwise("update").alias("flow"), F.col("o_orderkey").alias("candidate_id"))
    return state.push_counts(p.where("candidate_id % 3 = 0"), p)


def index_validate(s, d):
    c = table(s, d, "conversations")
    index = c.select(
        F.col("conv_id").cast("string").alias("candidate_id"), F.when(F.col("turn") == 0, F.concat(F.lit("http://x.example/"), F.col("conv_id").cast("string"))).otherwise(F.concat(F.lit("ftp://x.example/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string"))).alias("url"),
        F.concat(F.lit("content/"), F.col("conv_id").cast("string"), F.lit(".json")).alias("content_path"), F.array(F.col("turn").cast("int")).alias("found_by_query"),
    )
    return validate.candidate_index(index).groupBy("error").agg(F.count("*").alias("n"))


def record_validate(s, d):
    """Event properties as records that must have k (a string) and z, and nothing else."""
    e = validate.flat_record(F.col("props"), ("k", "z"))
    return table(s, d, "events").select("event_id", F.array_join(e, "; ").alias("errors"), V.number(V.parsed(F.col("props")), "k").alias("k"))


def batch_result_parity(s, d):
    results = table(s, d, "labels").select(F.col("doc_id").cast("string").alias("candidate_id"), F.lit("manual").alias("decision"), F.lit("seen by hand").alias("reason"), F.lit(None).cast("string").alias("record"), F.lit(None).cast("string").alias("evidence"))
    return validate.batch_results(results, table(s, d, "documents").select(F.col("doc_id").cast("string").alias("candidate_id")), "daily-push")


def result_candidates(s, d):
    """Labels as results, documents as the candidates that they speak of."""
    batch = table(s, d, "documents").select(F.col("doc_id").cast("string").alias("candidate_id"), F.col("source").alias("title"))
    return validate.with_candidate(table(s, d, "labels").select(F.col("doc_id").cast("string").alias("candidate_id")), batch)


def unknown_queries(s, d):
    return validate.unknown_queries(s, table(s, d, "part").select(F.col("p_partkey").cast("int").alias("query_no")), "100-1000, 149990-150010")


def dup_or_join(s, d):
    r = table(s, d, "orders").select(F.col("o_orderkey").cast("string").alias("candidate_id"), F.col("o_orderkey"), F.col("o_custkey").cast("string").alias("project_code"), F.date_format("o_orderdate", "yyyyMMdd").alias("purchaser"))
    r = r.select("candidate_id", F.col("candidate_id").alias("record_id"), "project_code", "purchaser", F.concat(F.lit("http://x.example/"), (F.col("o_orderkey") % 5000).cast("string")).alias("source_url"), "o_orderkey")
    seen = r.where("o_orderkey % 7 = 0").select("record_id", F.concat_ws("|", "project_code", "purchaser").alias("dedup_key"), "source_url")
    return state.duplicates(r.drop("o_orderkey"), seen)


def state_machine(s, d):
    b = table(s, d, "conversations").groupBy("conv_id").agg(F.count("*").alias("total"), F.count_if(F.col("turn") > 3).alias("pending"), F.count_if(F.col("role") == "user").alias("expected"), F.count_if(F.col("role") == "assistant").alias("confirmed"))
    st = state.run_state(F.col("pending"), F.col("total"), F.col("expected"), F.col("confirmed"))
    return b.select("conv_id", st.alias("state"), state.next_action(st, F.col("confirmed"), F.lit("daily-push")).alias("next_action"))


def receipt_check(s, d):
    p = table(s, d, "pages").select(F.lit("create").alias("flow"), F.col("page_id").cast("string").alias("candidate_id"), F.concat(F.lit("payloads/create/"), F.col("page_id").cast("string"), F.lit(".json")).alias("path"), F.sha2("url", 256).alias("sha256"))
    n = F.col("candidate_id").cast("int")
    r = p.select("flow", "candidate_id", F.col("path").alias("payload_path"), F.when(n % 5 == 0, F.lit("x")).otherwise(F.col("sha256")).alias("payload_sha256"), F.when(n % 7 == 0, 500).otherwise(200).alias("http_status"), F.lit(0).alias("remote_code"))
    return state.check_receipts(r, p, "daily-push").select("candidate_id", F.array_join("errors", "; ").alias("errors"))


def payload_export(s, d):
    p = table(s, d, "pages").select(F.lit("update").alias("decision"), F.col("page_id").cast("string").alias("candidate_id"), F.col("page_id").cast("string").alias("record_id"), F.lit("correction").alias("change_type"), F.col("url").alias("source_url"))
    out = export.payloads(p)
    v = F.from_json("json", "record_id string, change_type string, source_url string, notes string, budget double")
    return out.select("flow", "candidate_id", "path", (F.sha2("json", 256) == F.col("sha256")).alias("bound"), v["source_url"].alias("source_url"), v["notes"].alias("notes"), v["budget"].alias("budget"), F.size(F.json_object_keys("json")).alias("n_fields"))


def query_gaps(s, d):
    q = table(s, d, "orders").select(F.col("o_orderkey").cast("int").alias("query_no"), F.concat(F.lit("q "), F.when(F.col("o_orderkey") % 11 == 0, "x").otherwise("采购")).alias("query")).where("query_no % 13 <> 5")
    return validate.query_list(q)


def preview_top(s, d):
    return dedup.preview(candidates(s, d), 20).select("candidate_id", "title")


def page_contacts(s, d):
    """Pages' owners as contacts, which stand after the sign of a copyright, and their words of four letters as numbers."""
    c = T.contacts(F.col("html"), r"&copy; ([a-z.]+)", r"\b([a-z]{4})\b")
    return table(s, d, "pages").select("page_id", c["name"].alias("name"), c["phone"].alias("phone"))


def cluster_members(s, d):
    return cluster.members(candidates(s, d)).select("cluster_key", "number", "candidate_id")


def cluster_first(s, d):
    """Clusters with the first two of their members."""
    return cluster.cluster(candidates(s, d), most=2).select("candidate_id", "cluster_members", "n_members")


def batch_assign_skewed(s, d):
    """Orders in batches of seven by a number of which most lie close together; as a double, which no key's cube is too large for, and
    in the order of the keys up to 2**53."""
    k = F.col("o_orderkey").cast("double")
    o = table(s, d, "orders").select("o_orderkey", (k * k * k).alias("ord"))
    return route.assign_batches(o, 7, parts=16).select("o_orderkey", "batch_id")


def word_tags(s, d):
    t = contract.tags(F.col("text"), ("Apache",), ("MIT", "CC BY"), ("token",), ("licensed",))
    return table(s, d, "documents").select("doc_id", t["own_brands"].alias("own"), t["other_brands"].alias("others"), t["methods"].alias("methods"), t["doubtful"].alias("doubtful"))


QUERIES = {f.__name__: f for f in (
    url_normalize, title_fingerprint, candidate_id, teaser, hit_dedup, query_attribution, run_totals, title_cluster, seen_url_match, seen_code_match, seen_fuzzy_match, title_ratio,
    route_cases, route_funnel, clear_exclude, intent_filter, category_signals, search_evidence, overdue_sweep, seen_upsert, update_backfill, region_lookup, attachment_extract,
    batch_assign, batch_status, next_batch, decision_counts, result_summary, authority_histogram, retirement_window, ledger_idempotent, stats_recompute, push_counts,
    index_validate, record_validate, batch_result_parity, dup_or_join, state_machine, receipt_check, payload_export, query_gaps, preview_top, page_contacts, word_tags, cluster_members, cluster_first, batch_assign_skewed, route_outputs, batch_files, result_candidates, unknown_queries,
)}
