import random
from difflib import SequenceMatcher

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from noticeflow import rules, schemas
from noticeflow.operators import cluster, contract, dedup, export, match, route, state
from noticeflow.plans import queries, run
from noticeflow.sources import files


def hit(query, pos, url, title, **more):
    row = dict(run_id="d", query_no=query, query="q", pos=pos, url=url, title=title, site_name="s", publish_time="2026-08-18", auth_info_level=1, auth_info_des="", rank_score=0.5, summary="", content="正文", error="")
    return row | more


def frame(spark, rows, schema):
    names = [x.strip().split(" ")[0] for x in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


HITS = [
    hit(2, 0, "http://a.cn/1", "某院过敏原检测试剂采购公告"), hit(1, 1, " http://a.cn/1 ", "某院过敏原检测试剂采购公告 一"), hit(1, 0, "http://b.cn/2?utm_source=x", "某院过敏原检测试剂采购公告"),
    hit(1, 2, "", "blank"), hit(3, 0, "http://c.cn/3", "食堂食材采购公告"), hit(3, 1, "http://d.cn/4", "已见公告采购"), hit(4, 0, "http://e.cn/5", "short", content="过敏原"), hit(5, -1, None, None, error="HTTP 500"),
]


def test_search_step(spark):
    queries = spark.range(1, 7).select(F.col("id").cast("int").alias("query_no"))
    index, contents, stats = run.search_step(frame(spark, HITS, schemas.SEARCH_HIT), queries)
    rows = {r.url: r for r in index.collect()}
    assert rows["http://a.cn/1"].found_by_query == [1, 2] and rows["http://a.cn/1"].title.endswith("一") and len(rows) == 5
    assert {r.query_no: (r.raw, r.unique, r.pushed) for r in stats.collect()} == {1: (3, 1, 0), 2: (1, 0, 0), 3: (2, 2, 0), 4: (1, 1, 0), 5: (0, 0, 0), 6: (0, 0, 0)}
    assert contents.count() == 5
    normal = dedup.dedup_hits(frame(spark, [hit(1, 0, "http://x.cn/?t=1", "a"), hit(2, 0, "http://x.cn", "b")], schemas.SEARCH_HIT), normalized=True)
    assert [r.found_by_query for r in normal.collect()] == [[1, 2]]


def index_rows(spark, rows):
    made = [
        dict(ord=k, candidate_id=f"C{k}", title=t, title_fingerprint=t, site_name="s", url=u, publish_time="", auth_info_level=0, auth_info_des="", rank_score=0.0, found_by_query=q, teaser=more, content_path=f"content/C{k}.json")
        for k, (t, u, q, more) in enumerate(rows)
    ]
    return frame(spark, made, schemas.CANDIDATE_INDEX)


def contents_of(spark, rows):
    return spark.createDataFrame([(f"C{k}", t, u, "", "总 IgE 试剂") for k, (t, u, _, _) in enumerate(rows)], schemas.CANDIDATE_CONTENT)


def test_prepare_funnel(spark):
    rows = [
        ("医院采购过敏原检测试剂公告", "http://a.cn/1", [39], ""), ("医院采购过敏原检测试剂公告", "http://b.cn/2", [1], ""), ("职工食堂食材配送采购项目", "http://c.cn/3", [2], ""),
        ("已经见过的采购公告一则", "http://d.cn/4?utm_medium=z", [3], ""),
    ]
    seen = spark.createDataFrame([(0, "R1", "HTTP://D.cn/4/", "t")], "seen_ord int, record_id string, source_url string, title string")
    got = run.prepare(index_rows(spark, rows), contents_of(spark, rows), seen)
    assert got.funnel.first().asDict() == {"indexed": 4, "clusters": 3, "queued": 1, "possible_updates": 0, "already_seen": 1, "screened_out": 1}
    first = got.queue.first()
    assert first.cluster_members == ["C0", "C1"] and first.found_by_query == [1, 39] and first.alternate_sources[0].url == "http://b.cn/2" and first.batch_id == "batch-0001"
    assert first.search_evidence.target_category_signals == ["总IgE试剂"]
    assert {r.route: r.skip_reason for r in got.routed.collect()} == {"create": None, "already_seen": "seen", "screened_out": "excluded: 食堂.*食材|食材.*食堂"}


def test_match_tiers(spark):
    rows = [
        ("过敏原检测试剂采购项目中标公告", "http://a.cn/1", [1], "编号 zb-2026-01"), ("过敏原检测试剂盒采购项目中标公告", "http://a.cn/2", [1], ""), ("过敏原检测试剂盒采购项目公告", "http://a.cn/3", [1], ""),
        ("完全不同的另一个项目成交公告了", "http://z.cn/9", [1], ""),
    ]
    seen = spark.createDataFrame([(0, "R0", "http://x.cn/0", "过敏原检测试剂采购项目公告", "ZB-2026-01"), (1, "R1", "http://x.cn/1", "无关", "null"), (2, "R2", "http://z.cn/9", "无关", "")], "seen_ord int, record_id string, source_url string, title string, project_code string")
    got = {r.candidate_id: (r.seen_match_reason, r.matched_seen_record_ids) for r in match.match_seen(index_rows(spark, rows), seen).collect()}
    assert got == {"C0": ("project_code", ["R0"]), "C1": ("title_similarity", ["R0"]), "C2": (None, []), "C3": ("source_url", ["R2"])}


def test_title_matches_are_those_of_all_pairs(spark):
    r = random.Random(7)
    base = ["".join(r.choice("甲乙丙丁戊己庚辛abcdef") for _ in range(r.randint(10, 30))) for _ in range(25)]

    def near(t):
        t = list(t)
        for _ in range(r.randint(0, 4)):
            t[r.randrange(len(t))] = r.choice("甲乙丙丁xyz")
        return "".join(t)

    left, right = [near(r.choice(base)) for _ in range(60)], [near(r.choice(base)) for _ in range(60)]
    c = spark.createDataFrame([(str(k), t) for k, t in enumerate(left)], "candidate_id string, title string")
    s = spark.createDataFrame([(k, str(k), t) for k, t in enumerate(right)], "seen_ord int, record_id string, title string")
    got = {(x.candidate_id, x.record_id) for x in match.by_title(c, s).collect()}
    want = {(str(i), str(j)) for i, a in enumerate(left) for j, b in enumerate(right) if SequenceMatcher(None, a.lower(), b.lower()).ratio() >= 0.86}
    assert got == want and len(want) > 50


def test_code_matches_are_those_of_all_pairs(spark):
    r = random.Random(8)
    codes = ["".join(r.choice("AB1-") for _ in range(r.randint(1, 7))) for _ in range(40)] + ["", "null", None]
    titles = ["".join(r.choice("ab1- ") for _ in range(r.randint(0, 20))) for _ in range(50)] + [None]
    c = spark.createDataFrame([(str(k), t, "tEa") for k, t in enumerate(titles)], "candidate_id string, title string, teaser string")
    s = spark.createDataFrame([(k, str(k), x) for k, x in enumerate(codes)], "seen_ord int, record_id string, project_code string")
    want = {(str(i), str(j)) for i, t in enumerate(titles) for j, x in enumerate(codes) if x and x != "null" and x.lower() in f"{t or ''} tea".lower()}
    assert {(x.candidate_id, x.record_id) for x in match.by_code(c, s).collect()} == want


def test_pairs_of_a_code_are_not_told_apart_after_they_meet(spark):
    """Rows of one id, records that come twice or with two codes: each pair once, by a distinct over these records alone."""
    c = spark.createDataFrame([("1", "notice AB-1234 and CD-9876", ""), ("1", "notice AB-1234 again", ""), ("2", "CD-9876", "ab-1234"), ("3", "AB-1234", None)], "candidate_id string, title string, teaser string")
    s = spark.createDataFrame([(0, "x", "AB-1234"), (0, "x", "CD-9876"), (1, "y", "AB-1234"), (1, "y", "ab-1234"), (2, "z", "none here"), (None, None, "AB-1234")], "seen_ord long, record_id string, project_code string")
    got = match.by_code(c, s)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(i, *r) for i in "123" for r in ((0, "x"), (1, "y"), (None, None))], key=str)
    top = got._jdf.queryExecution().optimizedPlan()
    assert top.nodeName() == "Union" and top.children().head().nodeName() == "Project"


def test_cluster_order_and_short_titles(spark):
    rows = [("b" * 9, "u0", [3], ""), ("abc", "u1", [1], ""), ("abc", "u2", [1], ""), ("b" * 9, "u3", [1, 3], "")]
    got = {r.candidate_id: (r.cluster_members, r.found_by_query, [a.candidate_id for a in r.alternate_sources]) for r in cluster.cluster(index_rows(spark, rows)).collect()}
    assert got == {"C0": (["C0", "C3"], [1, 3], ["C3"]), "C1": (["C1"], [1], []), "C2": (["C2"], [1], [])}


def test_batches(spark):
    queue = spark.range(0, 47).select((F.col("id") * F.col("id")).alias("ord"), F.col("id").alias("k"))
    assert {r.k: r.batch_id for r in route.assign_batches(queue, 5).collect()} == {k: f"batch-{k // 5 + 1:04d}" for k in range(47)}


def test_retirement_needs_full_windows(spark):
    rows = [(1, f"d{k:02d}", 0, 0) for k in range(14)] + [(2, f"d{k:02d}", 1, 0) for k in range(14)] + [(3, f"d{k:02d}", 0, 0) for k in range(13)] + [(4, f"d{k:02d}", 1, int(k == 3)) for k in range(14)]
    got = dedup.retirement(spark.createDataFrame(rows, "query_no int, day string, unique long, pushed long")).collect()
    assert {(r.query_no, r.verdict) for r in got} == {(1, "retire"), (2, "review")}


def record(**more):
    base = {f: 0.0 if f in rules.NUMBER_FIELDS else False if f in rules.BOOL_FIELDS else "null" for f in rules.CREATE_FIELDS}
    return base | {"record_id": "T20260811-K7X2P9", "title": "公告", "purchaser": "医院", "source_url": "http://a.cn/1", "project_code": "null", "days_left": 0} | more


def seen_frame(spark, rows):
    return frame(spark, rows, schemas.SEEN)


def test_record_and_replay(spark):
    seen = seen_frame(spark, [record(record_id="R0", source_url="http://z.cn/0", status="active", dedup_key="k", first_seen="d0", last_seen="d0", pushed=True, found_by_query=[2])])
    shape = "decision string, candidate_id string, flow string, found_by_query array<int>, " + schemas.record_type(rules.CREATE_FIELDS)
    rec = [record(decision="create", flow="create", candidate_id="C1", found_by_query=[39, 1]), record(record_id="R0", decision="update", flow="update", candidate_id="C2", status="closed", winner="某公司", found_by_query=[7])]
    records = frame(spark, rec, shape)
    payloads = export.payloads(records)
    sha = {r.candidate_id: r.sha256 for r in payloads.collect()}
    receipts = spark.createDataFrame([(1, f, c, f"payloads/{f}/{c}.json", sha[c], 200, 0, "t") for f, c in (("create", "C1"), ("update", "C2"))], schemas.RECEIPT)
    ledger = spark.createDataFrame([], schemas.LEDGER)
    history, ledger = run.record(receipts, payloads, ledger, seen, records, "daily-push", "d1")
    rows = {r.record_id: r for r in history.collect()}
    assert rows["R0"].status == "closed" and rows["R0"].winner == "某公司" and rows["R0"].found_by_query == [2, 7] and rows["R0"].last_seen == "d1" and rows["R0"].first_seen == "d0"
    assert rows["T20260811-K7X2P9"].found_by_query == [1, 39] and rows["T20260811-K7X2P9"].dedup_key == "http://a.cn/1" and ledger.count() == 2
    again_history, again = run.record(receipts, payloads, ledger, history, records, "daily-push", "d2")
    assert again.count() == 2 and sorted(map(str, again_history.collect())) == sorted(map(str, history.collect()))
    wrong = receipts.withColumn("payload_sha256", F.lit("0"))
    assert {e for r in state.check_receipts(wrong, payloads, "daily-push").collect() for e in r.errors} == {"hash differs"}
    assert {e for r in state.check_receipts(receipts, payloads, "report-only").collect() for e in r.errors} == {"flow not allowed in this mode"}
    stats = spark.createDataFrame([("d1", q, 0, 0, 9) for q in (1, 2, 7, 39)] + [("d0", 1, 0, 0, 5)], schemas.QUERY_STATS)
    assert {(r.day, r.query_no): r.pushed for r in state.pushed_stats(stats, ledger, "d1").collect()} == {("d1", 1): 1, ("d1", 2): 0, ("d1", 7): 1, ("d1", 39): 1, ("d0", 1): 5}


def test_creates_that_history_has_are_refused(spark):
    shape = "decision string, candidate_id string, flow string, found_by_query array<int>, " + schemas.record_type(rules.CREATE_FIELDS)
    new = lambda **more: frame(spark, [record(decision="create", flow="create", candidate_id="C1", found_by_query=[1], **more)], shape)
    known = dict(dedup_key="http://a.cn/1", first_seen="d0", last_seen="d0", pushed=True, found_by_query=[2])
    receipts = lambda p: spark.createDataFrame([(1, r.flow, r.candidate_id, r.path, r.sha256, 200, 0, "t") for r in p.collect()], schemas.RECEIPT)
    empty = spark.createDataFrame([], schemas.LEDGER)

    def push(seen, records):
        p = export.payloads(records)
        return run.record(receipts(p), p, empty, seen, records, "daily-push", "d1")

    for other in (dict(), dict(record_id="T20260811-K7X2P8"), dict(source_url="http://A.cn/1/?utm_x=1", record_id="T20260811-K7X2P8", project_code="P", dedup_key="P|x")):
        with pytest.raises(run.Rejected):  # the same record_id, dedup_key or URL, but not the same record
            push(seen_frame(spark, [record(**{**known, "title": "另一个", **other})]), new())
    with pytest.raises(run.Rejected):  # the same record, never pushed
        push(seen_frame(spark, [record(**{**known, "pushed": False})]), new())
    with pytest.raises(run.Rejected):  # two of one push are like each other
        push(seen_frame(spark, []), new().union(new().withColumn("candidate_id", F.lit("C2")).withColumn("record_id", F.lit("T20260811-K7X2P9"))))
    history, ledger = push(seen_frame(spark, [record(**known)]), new())  # what a run that broke off left
    assert history.count() == 1 and ledger.count() == 1 and history.first().last_seen == "d0"


def test_updates_of_one_record_are_taken_in_order(spark):
    seen = seen_frame(spark, [record(record_id="R0", source_url="http://z.cn/0", status="active", dedup_key="k", first_seen="d0", last_seen="d0", pushed=True, found_by_query=[2])])
    shape = "decision string, candidate_id string, flow string, found_by_query array<int>, " + schemas.record_type(rules.CREATE_FIELDS)
    records = frame(spark, [record(record_id="R0", decision="update", flow="update", candidate_id=c, status=x, found_by_query=[q]) for c, x, q in (("C1", "canceled", 7), ("C2", "closed", 1))], shape)
    p = export.payloads(records)
    for order, last in (({"C1": "t1", "C2": "t2"}, "closed"), ({"C1": "t2", "C2": "t1"}, "canceled")):
        receipts = spark.createDataFrame([(1, r.flow, r.candidate_id, r.path, r.sha256, 200, 0, order[r.candidate_id]) for r in p.collect()], schemas.RECEIPT)
        history, ledger = run.record(receipts, p, spark.createDataFrame([], schemas.LEDGER), seen, records, "daily-push", "d1")
        assert [(r.record_id, r.status, r.found_by_query) for r in history.collect()] == [("R0", last, [1, 2, 7])] and ledger.count() == 2


def test_contract_operators(spark):
    one = spark.createDataFrame([("河南", "更正公告", "2026-01-01T09:00"), ("火星", "中标公告", "null"), (None, "招标公告", "2099-01-01")], "p string, n string, d string")
    now = F.to_timestamp(F.lit("2026-08-19 08:00:00"))
    got = contract.with_region(one, "p", contract.region_table(spark)).select("region", contract.status_of(F.col("n"), F.col("d"), now).alias("s")).collect()
    assert {(r.region, r.s) for r in got} == {("华北二区", "intel"), (rules.NO_REGION, "intel"), (rules.NO_REGION, "active")}
    late = contract.close_overdue(seen_frame(spark, [record(record_id="A", status="active", deadline="2026-07-15T09:30", budget=480000.0), record(record_id="B", status="active", deadline="2026-08-19T09:00")]), now).collect()
    assert [(r.record_id, r.status, r.change_type, r.budget) for r in late] == [("A", "closed", "status_change", 480000.0)]
    changed = spark.createDataFrame([("某院中标公告", "null"), ("废标公告", "null"), ("更正公告", "2026-09-01"), ("更正公告", "null")], "t string, d string")
    assert [tuple(r[0]) for r in changed.select(contract.change_of(F.col("t"), F.col("d"), F.lit("2026-08-01"))).collect()] == [("status_change", "closed"), ("status_change", "canceled"), ("deadline_change", None), ("correction", None)]
    pages = spark.createDataFrame([(1, "http://h.cn/a/b", '<a href="/x/公告.pdf"><a href="https://o.cn/采购文件.docx">')], "page_id int, url string, html string")
    assert [(r.ord, r.url, r.main) for r in contract.attachments(pages).orderBy("ord").collect()] == [(0, "http://h.cn/x/公告.pdf", False), (1, "https://o.cn/采购文件.docx", True)]
    best = spark.createDataFrame([(["酶标仪", "总IgE试剂"],), ([],)], "m array<string>").select(contract.best_category(F.col("m"), F.lit("试剂")).alias("b")).collect()
    assert [tuple(r.b) for r in best] == [("总IgE试剂", "试剂", "full", ["酶标仪"]), ("其他", "其他", "unknown", [])]
    masked = contract.masked_defaults(spark.createDataFrame([(None, None, None, "n")], "purchaser string, region string, budget double, notes string")).first()
    assert tuple(masked) == (rules.MASKED_PURCHASER, rules.NO_REGION, 0.0, "n")
    tags = spark.createDataFrame([("甲牌与乙牌 流式荧光 送检",)], "t string").select(contract.tags(F.col("t"), ["甲牌"], ["乙牌", "丙牌"]).alias("t")).first().t
    assert (tags.own_brands, tags.other_brands, tags.methods, tags.doubtful) == (["甲牌"], ["乙牌"], ["流式荧光"], True)


def test_states(spark):
    rows = [(0, 0, 0, 0), (1, 2, 0, 0), (0, 2, 3, 1), (0, 2, 3, 3)]
    df = spark.createDataFrame(rows, "p int, t int, e int, c int")
    st = state.run_state(F.col("p"), F.col("t"), F.col("e"), F.col("c"))
    assert [tuple(r) for r in df.select(st, state.next_action(st, F.col("c"), F.lit("daily-push"))).collect()] == [("COMPLETE_NO_CANDIDATES", "NONE"), ("VERIFYING", "SUBMIT_BATCHES"), ("VALIDATED", "PUSH_REMAINING"), ("PUSHED", "NONE")]


def test_duplicates_by_any_key(spark):
    recs = spark.createDataFrame([("C1", "R1", "P", "甲", "http://a.cn/1"), ("C2", "R9", "null", "乙", "http://b.cn/"), ("C3", "R8", "Q", "丙", "http://c.cn")], "candidate_id string, record_id string, project_code string, purchaser string, source_url string")
    seen = spark.createDataFrame([("R1", "x", "http://z.cn"), ("S2", "P|甲", "http://y.cn"), ("S3", "w", "http://B.cn?t=5")], "record_id string, dedup_key string, source_url string")
    assert {tuple(r) for r in state.duplicates(recs, seen).collect()} == {("C1", "R1"), ("C1", "S2"), ("C2", "S3")}


def test_ranges_are_of_like_size_however_the_order_is_spread(spark):
    rows = spark.range(4000).select((F.pow(F.lit(1.006), F.col("id")) * 1000).cast("long").alias("ord")).distinct().union(spark.range(3000).select((F.col("id") + 10**15).alias("ord")))
    n = rows.count()
    sizes = [r["count"] for r in route.in_ranges(rows, 16).groupBy("_part").count().collect()]
    assert len(sizes) == 16 and max(sizes) <= 2 * n / 16
    got = route.assign_batches(rows, 20, parts=16).orderBy("ord").collect()
    assert [r.batch_id for r in got] == [f"batch-{k // 20 + 1:04d}" for k in range(n)]
    assert route.assign_batches(rows.limit(0), 5).count() == 0 and [r.batch_id for r in route.assign_batches(rows.limit(1), 5, parts=1).collect()] == ["batch-0001"]


def test_a_cluster_of_any_size_is_a_relation(spark):
    rows = spark.range(3000).select(F.col("id").alias("ord"), F.format_string("C%05d", "id").alias("candidate_id"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("rare title "), F.col("id") % 100)).otherwise("one very frequent title").alias("title_fingerprint"), F.lit("s").alias("site_name"), F.lit("u").alias("url"), F.array((F.col("id") % 3).cast("int")).alias("found_by_query"))
    got = cluster.members(rows, parts=8)
    each = {}
    for r in got.orderBy("ord").collect():
        each.setdefault(r.cluster_key, []).append((r.number, r.candidate_id))
    assert all([n for n, _ in m] == list(range(len(m))) for m in each.values()) and sum(map(len, each.values())) == 3000
    ranged = route.in_ranges(rows.select(cluster.cluster_key().alias("k"), "ord"), 8)
    assert max(r["count"] for r in ranged.groupBy("k", "_part").count().collect()) < 2 * 3000 / 8  # no task has the whole cluster
    short, whole = cluster.cluster(rows, most=3), {r.candidate_id: r for r in cluster.cluster(rows).collect()}
    for r in short.collect():
        full = whole[r.candidate_id]
        assert r.cluster_members == full.cluster_members[:3] and r.n_members == len(full.cluster_members) and r.found_by_query == full.found_by_query and len(r.alternate_sources) == min(2, r.n_members - 1)


def test_the_largest_attachment_is_the_main_one(spark, tmp_path):
    for name, n in (("a.pdf", 5), ("b.pdf", 500), ("采购文件.pdf", 1)):
        (tmp_path / name).write_bytes(b"x" * n)
    sizes = files.file_sizes(spark, str(tmp_path)).select(F.concat(F.lit("http://h.cn/"), "name").alias("url"), "length")
    link = lambda *names: "".join(f'<a href="/{x}">' for x in names)
    pages = spark.createDataFrame([(1, "http://h.cn/p", link("a.pdf", "b.pdf", "c.pdf")), (2, "http://h.cn/p", link("b.pdf", "采购文件.pdf")), (3, "http://h.cn/p", link("c.pdf", "d.pdf"))], "page_id int, url string, html string")
    got = contract.attachments(pages, sizes=sizes).where("main").orderBy("page_id").collect()
    assert [(r.url.rsplit("/", 1)[1], r.length) for r in got] == [("b.pdf", 500), ("采购文件.pdf", 1), ("c.pdf", None)]


def test_totals_in_one_pass(spark):
    queries = spark.range(1, 7).select(F.col("id").cast("int").alias("query_no"))
    hits = frame(spark, HITS, schemas.SEARCH_HIT)
    totals = dedup.run_totals(hits, queries)
    assert totals.first().asDict() == {"query_ok": 5, "query_failed": 1, "raw": 7, "candidates": 5, "single": 4}
    plan = totals._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1  # the hits, once
    assert dedup.run_totals(hits.limit(0), queries).first().asDict() == {"query_ok": 6, "query_failed": 0, "raw": 0, "candidates": 0, "single": 0}


def test_batches_by_cubes_of_large_keys(spark, tmp_path):
    keys = [3 * 10**9 + k for k in range(20)] + list(range(20))
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").write.parquet(str(tmp_path / "orders.parquet"))
    got = {r.o_orderkey: r.batch_id for r in queries.batch_assign_skewed(spark, str(tmp_path)).collect()}
    assert got == {k: f"batch-{n // 7 + 1:04d}" for n, k in enumerate(sorted(keys))}


def test_duplicates_are_those_of_all_pairs_and_leave_the_join_once(spark):
    r = random.Random(3)
    text = lambda n: r.choice([None, "null", *map(str, range(n))])
    new = [(f"C{r.randrange(50)}" if k % 5 == 0 else f"C{100 + k}", text(20), text(4), text(3), f"http://x.example/{r.randrange(12)}") for k in range(60)]
    old = [(text(20) if k % 4 == 0 else f"R{k}", r.choice([None, "1|1", "2|0", "null|2"]), r.choice([None, f"http://x.example/{r.randrange(12)}/"])) for k in range(40)]
    records = spark.createDataFrame(new, "candidate_id string, record_id string, project_code string, purchaser string, source_url string")
    seen = spark.createDataFrame(old, "record_id string, dedup_key string, source_url string")
    key = lambda code, who, url: url if code in (None, "null") else "|".join(x for x in (code, who) if x is not None)
    eq = lambda a, b: a is not None and a == b
    want = {(c, i) for c, rid, code, who, u in new for i, dk, v in old if eq(rid, i) or eq(key(code, who, u), dk) or eq(u, v and v.rstrip("/"))}
    got = state.duplicates(records, seen)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert got._jdf.queryExecution().optimizedPlan().nodeName() == "Union"  # pairs of rows with ids of their own aren't gathered again


def test_create_actions_by_keys_alone(spark):
    fields = {f: "null" for f in rules.CREATE_FIELDS}
    row = lambda cid, **more: (cid, *(fields | more).values())
    new = [row("A", record_id="1", source_url="http://a/1"), row("B", record_id="2", source_url="http://a/2"), row("C", record_id="3", source_url="http://a/3"), row("D", record_id="4", source_url="http://a/4"), row("E", record_id="5", source_url="http://a/5"), row("F", record_id="6", source_url="http://a/5"), row("G", record_id="7", source_url="http://a/7")]
    old = [row("", record_id="2", source_url="http://a/2"), row("", record_id="3", source_url="http://a/3", title="other"), row("", record_id="4", source_url="http://b/4"), row("", record_id="9", source_url="http://a/4"), row("", record_id=None, source_url="http://a/7")]
    shape = ", ".join(f"{f} string" for f in ("candidate_id", *rules.CREATE_FIELDS))
    seen = spark.createDataFrame(old, shape).drop("candidate_id").withColumn("dedup_key", F.col("source_url")).withColumn("pushed", F.lit(True))
    got = state.create_actions(spark.createDataFrame(new, shape), seen)
    assert {tuple(r) for r in got.collect()} == {("A", "append"), ("B", "recovered"), ("C", "conflict"), ("D", "conflict"), ("E", "conflict"), ("F", "conflict"), ("G", "conflict")}
    assert "LeftOuter, (seen_id" not in got._jdf.queryExecution().optimizedPlan().toString()  # records that history doesn't know don't meet in one task


def test_similar_bases_keep_no_row_of_pairs_that_differ(spark):
    r = random.Random(5)
    texts = ["".join(r.choice("aaab甲") for _ in range(r.randint(3, 24))) for _ in range(40)]
    left, right = (spark.createDataFrame([(t,) for t in part], f"{n} string") for n, part in (("a", texts[:20]), ("b", texts[15:])))
    got = match.similar_bases(left, right, 0.86)
    want = {(a, b) for a in texts[:20] for b in texts[15:] if SequenceMatcher(None, a, b, autojunk=False).ratio() >= 0.86}
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert "max(half" not in got._jdf.queryExecution().optimizedPlan().toString()  # pairs were grouped before they were compared


def test_pairs_in_another_order_never_reach_the_ratio():
    """Anagrams have all characters in common; the longest common subsequence, at least what blocks in order hold, tells them apart."""
    r = random.Random(7)
    a = ["".join(r.choices("abcdé😀 ", k=r.choice([0, 1, 9, 30, 64, 90]))) for _ in range(300)]
    b = ["".join(r.sample(x, len(x))) if k % 3 else x[3:] + "zz" for k, x in enumerate(a)]
    a, b = zip(*[(x, y) for x, y in zip(a, b) if min(len(x), len(y)) <= match.WORD])

    def longest(x, y):
        row = [0] * (len(y) + 1)
        for c in x:
            row = [0, *row]
            row = [0] + [0] * len(y) if not y else _next(row[1:], c, y)
        return row[-1]

    def _next(row, c, y):
        out = [0]
        for k, d in enumerate(y):
            out.append(row[k] + 1 if c == d else max(out[k], row[k + 1]))
        return out

    want = [longest(x, y) for x, y in zip(a, b)]
    assert match.common_subsequence(list(a), list(b)).tolist() == want
    assert all(2 * w >= SequenceMatcher(None, x, y, False).ratio() * (len(x) + len(y)) - 1e-6 for w, x, y in zip(want, a, b) if x or y)
    base = "".join(chr(97 + k % 26) for k in range(0, 60 * 7, 7))
    batch = pa.record_batch({"a": [base, base, base], "b": [base[::-1], base[:30] + "x" + base[30:], base[1:] + "q" * 90]})
    assert next(match._ordered_in_common(0.86)(iter([batch])))["b"].to_pylist() == [batch["b"][1].as_py()]


def test_similar_bases_against_all_pairs_of_edited_titles(spark):
    r = random.Random(8)
    texts = ["".join(r.choices("etaoin shrdlu", k=r.choice([1, 2, 10, 25, 60, 80, 230]))) for _ in range(60)]

    def edited(t):
        for _ in range(r.randint(0, max(1, len(t) // 7))):
            k = r.randrange(len(t) + 1)
            t = r.choice([t[:k] + r.choice("xyz") + t[k:], t[:k] + t[k + 1 :], t[: k // 2] + t[k:] + t[k // 2 : k]])
        return t

    other = sorted({edited(t) for t in texts for _ in range(3)})
    left, right = (spark.createDataFrame([(t,) for t in x], f"{n} string") for x, n in ((texts, "a"), (other, "b")))
    got = {tuple(x) for x in match.similar_bases(left, right, 0.86).collect()}
    want = {(x, y) for x in texts for y in other if SequenceMatcher(None, x, y).ratio() >= 0.86}
    assert got == want and len(want) > 60
