import http.server
import json
import threading

from noticeflow import schemas
from noticeflow.__main__ import main
from noticeflow.sinks.history import History
from noticeflow.sinks.store import Store
from tests_support import PROOF, create


def said(capsys):
    return json.loads(capsys.readouterr().out.strip().split("\n")[-1])


class server:
    """A local address that gives these answers in turn and keeps what it was sent."""

    def __init__(self, *answers):
        got = self.got = []
        waiting = list(answers)

        class Handler(http.server.BaseHTTPRequestHandler):
            def do_POST(self):
                got.append(self.rfile.read(int(self.headers["Content-Length"])))
                status, body = waiting.pop(0)
                self.send_response(status)
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *args):
                pass

        self.server = http.server.HTTPServer(("127.0.0.1", 0), Handler)
        self.address = f"http://127.0.0.1:{self.server.server_port}/"
        threading.Thread(target=self.server.serve_forever, daemon=True).start()

    def stop(self):
        self.server.shutdown()


def test_a_run_from_search_to_history(spark, tmp_path, capsys, monkeypatch):
    go = lambda *args: main(list(map(str, args)), spark)
    (tmp_path / "list.md").write_text("共 **2 条**\n\n## 5. list\n\n1. 过敏原 采购\n2. 自身抗体 招标\n", encoding="utf-8")
    hits = lambda *urls: {"WebResults": [{"Url": u, "Title": t, "SiteName": "站", "Content": "过敏原 检测", "AuthInfoDes": "高"} for u, t in urls]}
    answers = {"过敏原 采购": hits(("http://a.cn/1", "医院采购过敏原检测试剂公告"), ("http://c.cn/3", "职工食堂食材采购公告")), "自身抗体 招标": hits(("http://a.cn/1", "医院采购过敏原检测试剂公告"))}
    (tmp_path / "answers.json").write_text(json.dumps(answers), encoding="utf-8")
    base = ["search", "--query-list", tmp_path / "list.md", "--heading", "## 5. list", "--fixture", tmp_path / "answers.json", "--out", tmp_path / "runs", "--today", "2026-08-18"]
    assert go(*base, "--dry-run") == 0 and said(capsys)["TimeRange"] == "2026-07-04..2026-08-18"
    assert go(*base, "--queries", "7") == 2 and go(*base) == 0
    assert "queries ok 2, failed 0; hits 3; candidates 2, of one query only 1" in capsys.readouterr().out
    day = tmp_path / "runs" / "2026-08-18"
    past, pipeline = History(Store(spark, str(tmp_path / "history"))), Store(spark, str(day / "pipeline"))
    past.begin_with(spark.createDataFrame([], schemas.SEEN))
    prepare = ["prepare", day, "--seen", tmp_path / "history", "--mode", "daily-push"]
    assert go(*prepare) == 0
    row = said(capsys)
    assert (row["state"], row["queued"], row["screened_out"], row["next_batch"]) == ("VERIFYING", 1, 1, "batch-0001")
    assert go(*prepare) == 2 and [n for n in sorted(pipeline.latest().tables) if n.startswith("routes")] == ["routes_already_seen", "routes_possible_updates", "routes_queue", "routes_screened_out"]
    assert go("next-batch", day) == 0
    candidate = said(capsys)["candidates"][0]
    assert candidate["found_by_query"] == [1, 2]
    submit = ["submit-batch", day, "--batch", "batch-0001", "--engine", "引擎", "--results", tmp_path / "results.json"]
    (tmp_path / "results.json").write_text(json.dumps([{"candidate_id": candidate["candidate_id"], "decision": "create", "record": create(title=None), "evidence": PROOF}]))
    assert go(*submit) == 2
    (tmp_path / "results.json").write_text(json.dumps([{"candidate_id": candidate["candidate_id"], "decision": "create", "record": create(), "evidence": PROOF}]))
    capsys.readouterr()
    assert go(*submit) == 0 and said(capsys)["state"] == "VALIDATED" and go(*submit) == 2
    payload = pipeline.read("payloads").first()
    (tmp_path / "payload.json").write_text(payload.json, encoding="utf-8")
    assert go("validate-payload", "--flow", "create", tmp_path / "payload.json") == 0 and go("validate-payload", "--flow", "update", tmp_path / "payload.json") == 2
    served = server((200, b'{"code": 1}'), (500, b"no"), (200, b'{"code": 0}'))
    monkeypatch.setenv("NOTICE_CREATE_URL", served.address)
    send = ["send", day, "--flow", "create", "--candidate", payload.candidate_id]
    capsys.readouterr()
    assert go(*send, "--dry-run") == 0 and said(capsys)["sha256"] == payload.sha256
    (tmp_path / "forged.json").write_text(payload.json.replace("医院", "医院二"), encoding="utf-8")
    assert go(*send) == 2 and go(*send, "--live", "--payload", tmp_path / "forged.json") == 2 and go("send", day, "--flow", "update", "--candidate", payload.candidate_id, "--live") == 2
    assert served.got == [] and go(*send, "--live") == 1 and go(*send, "--live") == 1 and not (day / "pipeline" / "receipts").exists()
    capsys.readouterr()
    assert go(*send, "--live") == 0
    left = json.loads((day / "pipeline" / "receipts" / f"create-{payload.candidate_id}.json").read_text(encoding="utf-8"))
    assert served.got == [payload.json.encode()] * 3 and left["payload_sha256"] == payload.sha256
    served.stop()
    assert json.loads((day / "pipeline" / "manifest.json").read_text(encoding="utf-8"))["raw"] == 3
    batch = pipeline.read("batches").first()
    assert batch.batch_id == "batch-0001" and "data" in batch.policy and len(batch.candidates) == 1
    assert pipeline.read("routes_queue").count() == 1
    receipt = {"schema_version": 1, "flow": "create", "candidate_id": payload.candidate_id, "payload_path": payload.path, "payload_sha256": payload.sha256, "http_status": 200, "remote_code": 0, "confirmed_at": "t"}
    push = ["record-push", day, "--seen", tmp_path / "history", "--receipt", day / "pipeline" / "receipts" / "own.json", "--stats", tmp_path / "runs" / "query_stats"]
    own = day / "pipeline" / "receipts" / "own.json"
    own.write_text(json.dumps(receipt | {"payload_sha256": "forged"}))
    assert go(*push) == 2 and past.rows().count() == 0
    own.write_text(json.dumps(receipt))
    (tmp_path / "receipt.json").write_text(json.dumps(receipt))
    elsewhere = [tmp_path / "receipt.json" if x == own else x for x in push]
    assert go(*elsewhere) == 2 and past.rows().count() == 0  # a receipt from elsewhere
    capsys.readouterr()
    for again in (False, True):
        assert go(*push) == 0 if again else go(*[day / "pipeline" if x == day else x for x in push]) == 0  # the run, or its pipeline
        row = said(capsys)
        assert (row["state"], row["confirmed"], row["idempotent"]) == ("PUSHED", 1, again)
    seen = past.rows().collect()
    assert len(seen) == 1 and seen[0].found_by_query == [1, 2] and seen[0].first_seen == "2026-08-18"
    stats = {r.query_no: (r.raw, r.unique, r.pushed) for r in spark.read.parquet(str(tmp_path / "runs" / "query_stats")).collect()}
    assert stats == {1: (2, 1, 1), 2: (1, 0, 1)}
