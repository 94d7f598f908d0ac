import hashlib
import http.server
import json
import threading

import pytest
from pyspark.sql import functions as F

from noticeflow import schemas
from noticeflow.sinks import outbox, versioned
from noticeflow.sources import config, files, search
from noticeflow.sinks.store import Store
from noticeflow.streaming import receipts


def test_files(spark, tmp_path):
    (tmp_path / "q.md").write_text("# x\n\n共 **3 条**\n\n## 5. list\n\n1. 甲 采购公告 \n text\n2.  乙 招标\n\n## 6. next\n\n3. no\n", encoding="utf-8")
    assert [tuple(r) for r in files.read_query_list(spark, str(tmp_path / "q.md"), "## 5. list").collect()] == [(1, "甲 采购公告"), (2, "乙 招标")]
    assert files.declared_total(spark, str(tmp_path / "q.md")).first().declared == 3
    (tmp_path / "a.jsonl").write_text('{"candidate_id":"a"}\n\n[1]\n{"b\n', encoding="utf-8")
    assert {(r.line, r.text) for r in files.bad_lines(spark, str(tmp_path / "a.jsonl")).collect()} == {(3, "[1]"), (4, '{"b')}
    with pytest.raises(ValueError, match=r"a\.jsonl:3"):
        files.checked_jsonl(spark, str(tmp_path / "a.jsonl"), "candidate_id string")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "a.jsonl"), "candidate_id string").collect()
    (tmp_path / "seen.json").write_text(json.dumps({"records": [{"record_id": "R1", "budget": 5, "pushed": True, "source_url": "u", "found_by_query": [2]}, {"record_id": "R2"}]}), encoding="utf-8")
    got = files.read_seen(spark, str(tmp_path / "seen.json")).collect()
    assert [(r.seen_ord, r.record_id, r.budget, r.found_by_query) for r in got] == [(0, "R1", 5.0, [2]), (1, "R2", None, None)]
    (tmp_path / "bad.json").write_text('{"records": 5}')
    with pytest.raises(Exception):
        files.read_seen(spark, str(tmp_path / "bad.json")).collect()
    c = spark.createDataFrame([("C1", "http://a.cn/?t=1"), ("C2", "http://b.cn"), ("C3", "http://c.cn")], "candidate_id string, url string")
    t = spark.createDataFrame([("C1", "t", "http://a.cn", "s", "c"), ("C2", "t", "http://z.cn", "s", "c")], schemas.CANDIDATE_CONTENT)
    assert {r.candidate_id: r.content_error for r in files.with_content(c, t).collect()} == {"C1": None, "C2": "content of another URL", "C3": "no content"}


def test_lines_of_large_files_are_counted_by_block(spark, tmp_path):
    good = '{"candidate_id": "' + "x" * 40 + '"}'
    lines = [good if k % 7 else "" for k in range(4000)]
    for k in (5, 1234, 3999):
        lines[k] = "[1]"
    (tmp_path / "big.jsonl").write_text("\r\n".join(lines))
    was = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert files._blocks(spark, str(tmp_path)).count() > 5
        assert sorted(r.line for r in files.bad_lines(spark, str(tmp_path)).collect()) == [6, 1235, 4000]
        with pytest.raises(ValueError, match=r"big\.jsonl:6"):
            files.checked_jsonl(spark, str(tmp_path), "candidate_id string")
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_options(tmp_path, monkeypatch):
    o = config.SearchOptions.resolve({"count": 5, "sites": None}, {"count": 9, "sites": ["a.cn", "b.cn"], "need_content": True})
    assert (o.count, o.sites, o.need_content) == (5, "a.cn,b.cn", True)
    assert o.payload("q", "7d") == {"Query": "q", "SearchType": "web", "Count": 5, "Filter": {"NeedUrl": True, "NeedContent": True, "Sites": "a.cn|b.cn"}, "ContentFormats": "markdown", "TimeRange": "7d"}
    with pytest.raises(ValueError):
        config.SearchOptions.resolve({"block_hosts": "a,b,c,d,e,f"}).payload("q", None)
    with pytest.raises(ValueError):
        config.SearchOptions.resolve({"count": 51})
    monkeypatch.delenv("SOME_KEY", raising=False)
    assert config.api_key("SOME_KEY", {"api_key": "k"}) == "k"
    with pytest.raises(ValueError):
        config.api_key("SOME_KEY", {"api_key": "YOUR_KEY"})
    assert config.within(str(tmp_path / "a"), str(tmp_path)) and not config.within(str(tmp_path / ".." / "b"), str(tmp_path))
    assert config.within("hdfs://h/run/x/../receipts/a", "hdfs://h/run/receipts") and not config.within("hdfs://h/run/receipts/../a", "hdfs://h/run/receipts") and not config.within("hdfs://g/run/a", "hdfs://h/run")
    assert config.run_folder("s3://b/runs/d/pipeline/") == config.run_folder("s3://b/runs/d") == "s3://b/runs/d"


def test_search_source(spark):
    spark.dataSource.register(search.NoticeSearch)
    answers = {"甲 采购": {"WebResults": [{"Url": "u1", "Title": "t", "Snippet": "s", "RankScore": 1}, {"Url": "u2", "Summary": "x", "Snippet": "y"}]}, "乙": {}}
    df = spark.read.format("notice_search").option("queries", json.dumps([[1, "甲 采购"], [2, "乙"], [3, "丙"]])).option("fixture", json.dumps(answers)).option("run_id", "r").option("qps", "1000").load()
    rows = sorted(df.collect(), key=lambda r: (r.query_no, r.pos))
    assert [(r.query_no, r.pos, r.url, r.summary, r.error) for r in rows] == [(1, 0, "u1", "s", None), (1, 1, "u2", "x", None), (3, -1, None, None, "no answer")]


def test_filters_go_into_the_requests(spark, tmp_path):
    bodies = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_POST(self):
            bodies.append(json.loads(self.rfile.read(int(self.headers["Content-Length"]))))
            self.send_response(200)
            self.end_headers()
            hits = [{"Url": f"https://a.cn/{k}", "PublishTime": f"2026-08-{k:02d}", "AuthInfoLevel": k % 2} for k in (1, 12, 20)] + [{"Url": "https://b.cn/1", "PublishTime": "2026-08-12", "AuthInfoLevel": 1}]
            self.wfile.write(json.dumps({"Result": {"WebResults": hits}}).encode())

        def log_message(self, *args):
            pass

    served = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=served.serve_forever, daemon=True).start()
    (tmp_path / "config.json").write_text('{"api_key": "k"}')
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        spark.dataSource.register(search.NoticeSearch)
        payload = config.SearchOptions().payload("", "2026-08-01..2026-08-31")
        df = spark.read.format("notice_search").option("queries", json.dumps([[k, f"q{k}"] for k in range(1, 50)])).option("payload", json.dumps(payload)).option("endpoint", f"http://127.0.0.1:{served.server_port}/").option("keyvariable", "NO_SUCH_KEY").option("config", str(tmp_path / "config.json")).option("pushdown", "true").option("qps", "1000").load()
        some = df.where("query_no in (3, 4, 9) and query_no < 9 and publish_time >= '2026-08-10' and publish_time < '2026-08-15'")
        assert sorted((r.query_no, r.url) for r in some.select("query_no", "url").collect()) == [(3, "https://a.cn/12"), (3, "https://b.cn/1"), (4, "https://a.cn/12"), (4, "https://b.cn/1")]
        assert sorted(b["Query"] for b in bodies) == ["q3", "q4"] and {b["TimeRange"] for b in bodies} == {"2026-08-10..2026-08-15"}
        bodies.clear()
        one = df.where((F.col("query_no") == 7) & F.col("url").startswith("https://b.cn/") & (F.col("auth_info_level") == 1))
        assert [r.url for r in one.select("url").collect()] == ["https://b.cn/1"]
        assert [(b["Query"], b["Filter"]["Sites"], b["Filter"]["AuthInfoLevel"]) for b in bodies] == [("q7", "b.cn", 1)]
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "Filter" in plan and "query_no#" not in plan.split("Filter", 1)[1].split("BatchScan", 1)[0]  # Spark doesn't test the number again
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "false")
        served.shutdown()


def test_retries_and_pace():
    calls, waits = [], []

    def flaky(body):
        calls.append(body)
        return (None, "x", 10500) if len(calls) < 3 else ({}, "", None)

    assert search.run_query(flaky, {}, sleep=waits.append) == ({}, "", False) and waits == [1.5, 3.0]
    assert search.run_query(lambda b: (None, "no key", 10403), {}, sleep=waits.append) == (None, "no key", True)
    waits.clear()
    assert search.run_query(lambda b: (None, "bad", 10400), {}, sleep=waits.append) == (None, "bad", False) and not waits
    now = [0.0]
    pace = search.Pace(4, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    for _ in range(5):
        pace.take()
    assert now[0] == pytest.approx(1.0)


def test_a_fatal_answer_stops_all_lanes():
    asked, lock = [], threading.Lock()

    def call(body):
        with lock:
            asked.append(body["Query"])
        return (None, "no key", 10403) if body["Query"] == "q3" else ({"WebResults": []}, "", None)

    pace = search.Pace(200)
    got = list(search.run_all(call, {}, [(k, f"q{k}") for k in range(60)], pace, lanes=4, wait=0.0))
    assert [n for n, *_ in got] == list(range(60)) and got[3][3] == "stopped: no key"
    assert len(asked) <= 8 and all(e == "stopped: no key" for n, _, r, e in got if r is None) and sum(r is None for *_, r, _ in got) >= 52
    slots = []
    flaky = lambda body: (None, "x", 10500)
    counted = search.Pace(1000, sleep=slots.append)
    counted.take = lambda take=counted.take: (slots.append("slot"), take())
    assert list(search.run_all(flaky, {}, [(1, "q")], counted, wait=0.0, sleep=lambda s: None)) == [(1, "q", None, "x")] and slots.count("slot") == 3


def test_days_are_replaced(spark, tmp_path):
    days = lambda d, n: spark.range(n).select(F.lit(d).alias("day"), "id")
    for d, n in (("a", 3), ("b", 2), ("a", 1)):
        versioned.replace_day(days(d, n), str(tmp_path / "days"))
    assert {(r.day, r["count"]) for r in spark.read.parquet(str(tmp_path / "days")).groupBy("day").count().collect()} == {("a", 1), ("b", 2)}


def test_outbox():
    data = b'{"a":1}'
    p = outbox.Payload("create", "C1", "payloads/create/C1.json", data, hashlib.sha256(data).hexdigest())
    sent = []

    def post(body):
        sent.append(body)
        return 200, b'{"code": 0}'

    assert outbox.send(p, "daily-push", post, "t", live=True)["payload_sha256"] == p.sha256 and sent == [data]
    for mode, payload, live, answer in (("update-only", p, True, post), ("daily-push", outbox.Payload("create", "C1", "x", b"{}", p.sha256), True, post), ("daily-push", p, False, post), ("daily-push", p, True, lambda b: (200, b'{"code": 1}')), ("daily-push", p, True, lambda b: (500, b'{"code": 0}')), ("daily-push", p, True, lambda b: (200, b"ok"))):
        with pytest.raises(outbox.NotSent):
            outbox.send(payload, mode, answer, "t", live=live)


def test_receipt_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    row = {"schema_version": 1, "flow": "create", "candidate_id": "C1", "payload_path": "payloads/create/C1.json", "payload_sha256": "s", "http_status": 200, "remote_code": 0, "confirmed_at": "t"}
    store = Store(spark, str(tmp_path / "run"))
    paid = lambda c: {"flow": "create", "candidate_id": c, "path": f"payloads/create/{c}.json", "sha256": "s"}
    with store.begin() as commit:
        commit.replace("payloads", spark.createDataFrame([paid(c) for c in ("C1", "C2", "C3")]))
    for name, rows in (("1.json", [row, row, row | {"candidate_id": "C2", "http_status": 500}]), ("2.json", [row, row | {"candidate_id": "C3", "payload_path": "payloads/create/C3.json"}, row | {"payload_sha256": "other"}])):
        (tmp_path / "in" / name).write_text("\n".join(map(json.dumps, rows)))
        receipts.to_ledger(receipts.receipt_stream(spark, str(tmp_path / "in")), store, "daily-push", str(tmp_path / "ck")).awaitTermination()
    assert sorted(r.candidate_id for r in store.read("ledger").collect()) == ["C1", "C3"]
    assert sorted((r.candidate_id, r.errors[-1]) for r in store.read("refused").collect()) == [("C1", "hash differs"), ("C2", "not confirmed")]
    entry = store.latest().tables["ledger"]
    assert entry.rows == (1, 1) and store.latest().notes == {str(tmp_path / "ck"): "1"}
