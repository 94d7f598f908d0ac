import hashlib
import json

import pytest
from pyspark.sql import functions as F

from noticeflow import rules
from noticeflow.functions import variant
from noticeflow.operators import validate
from noticeflow.plans import records, run
from tests_support import PROOF, create

def update(**more):
    base = {f: 0 if f in rules.NUMBER_FIELDS else "null" for f in rules.UPDATE_FIELDS}
    return base | dict(record_id="T20260811-K7X2P9", change_type="status_change", status="closed", source_url="https://a.cn/1") | more


def run_rule(spark, rule, cases):
    rows = [(k, json.dumps(a, ensure_ascii=False) if not isinstance(a, str) else a, json.dumps(b, ensure_ascii=False) if not isinstance(b, str) else b) for k, (a, b) in enumerate(cases)]
    return [r[0] for r in spark.createDataFrame(rows, "k int, r string, e string").orderBy("k").select(rule(F.col("r"), F.col("e"))).collect()]


def test_create_rules(spark):
    less = {k: v for k, v in create().items() if k != "notes"}
    cases = [
        (create(), PROOF), (less | {"x": "y"}, PROOF), (create(budget=True), PROOF), (create(title=None, notes="", contact=["a"]), PROOF), (create(requires_manual="no"), PROOF),
        (create(record_id="T20260811-K7X2P0", region="月球", category="x", match_level="none", matched_category="y", status="closed", source_url="ftp://a"), PROOF),
        (create(match_level="unknown", deadline="null", designated_supplier="甲"), PROOF), (create(status="manual"), PROOF), (create(budget=5.5), PROOF | {"field_evidence": {"title": "a", "purchaser": "b", "source_url": "c", "matched_category": "d", "deadline": "e"}}),
        ("[1]", PROOF), ('{"a":1,"a":2}', PROOF), (create(title="null", purchaser="null"), PROOF),
    ]
    got = run_rule(spark, validate.create_record, cases)
    assert got[0] == [] and got[1] == ["missing: notes", "extra: x"] and got[2] == ["budget: not a number"]
    assert set(got[3]) == {"title: null", "title: not a string", "notes: empty string", "contact: nested", "contact: not a string"} and got[4] == ["requires_manual: not a boolean"]
    assert set(got[5]) == {"record_id", "region", "category", "match_level", "matched_category", "status", "source_url"}
    assert got[6] == ["active needs a match", "active needs a deadline", "active has a designated supplier"]
    assert got[7] == ["manual needs requires_manual", "manual needs notes"] and got[8] == ["no evidence: budget"]
    assert got[9] == got[10] == ["not an object"] and got[11] == ["title is required", "purchaser is required"]


def test_evidence_rules(spark):
    without = lambda k: {x: v for x, v in PROOF.items() if x != k}
    cases = [
        PROOF, without("verification_level"), PROOF | {"verification_level": "rumour"}, PROOF | {"source_verified": False}, PROOF | {"verification_level": "search_content"},
        PROOF | {"checked_at": "2026-08-18T10:00:00"}, without("checked_at"), PROOF | {"field_evidence": {}}, PROOF | {"field_evidence": {"a": " ", "b": 1}}, "null", without("source_verified") | {"verification_level": None},
    ]
    got = run_rule(spark, lambda r, e: validate.evidence(e, F.lit(False)), [("", c) for c in cases])
    assert got == [
        [], [], ["verification_level is neither source nor search_content"], ["source_verified must be true"], ["search_content only for status=manual", "source_verified must be false"],
        ["checked_at is no time with a zone"], ["checked_at is missing"], ["field_evidence is empty"], ["field_evidence has a blank"], ["evidence is not an object"], ["verification_level is neither source nor search_content"],
    ]


def test_update_rules(spark):
    got = run_rule(spark, validate.update_record, [(update(), PROOF), (update(change_type="x", status="y"), PROOF), (update(winner="甲", award_amount=3), PROOF | {"field_evidence": {"source_url": "a", "notice_type": "b", "publish_date": "c"}}), (update(change_type="deadline_change"), PROOF | {"field_evidence": {"source_url": "a", "notice_type": "b", "publish_date": "c"}})])
    assert got == [[], ["status", "change_type"], ["no evidence: award_amount,status,winner"], ["no evidence: deadline"]]


def test_payload_files_and_structure(spark):
    got = run_rule(spark, lambda r, e: F.struct(validate.payload_file("create", r).alias("a"), validate.structure(r, rules.CREATE_FIELDS).alias("b")), [(create(contact="x"), ""), (create(status="closed"), ""), ({"Title": None}, "")])
    assert [tuple(x) for x in got[:2]] == [([], []), (["status"], [])] and got[2].b[:2] == ["missing", "extra"]


def test_search_fallback(spark):
    body = "过敏原 检测".encode()
    proof = {"verification_level": "search_content", "source_verified": False, "content_path": "content/C1.json", "checked_at": "2026-08-18T10:00:00Z", "field_evidence": {"title": "a"}}
    good = create(status="manual", requires_manual=True, notes="据某引擎，页面无法访问，建议人工核实", matched_category="过敏原sIgE试剂")
    cases = [
        ("create", good, proof, "采购公告"), ("create", good | {"status": "active"}, proof, "采购公告"), ("create", good | {"matched_category": "酶标仪"}, proof, "采购公告"), ("create", good | {"notes": "x", "source_url": "https://b.cn"}, proof | {"content_sha256": "1", "content_path": "z"}, "科普新闻"), ("exclude", {}, PROOF, "x"),
    ]
    rows = [(str(k), d, json.dumps(r, ensure_ascii=False), json.dumps(e, ensure_ascii=False), t, "https://a.cn/1/", "content/C1.json", "", "过敏原 检测", body) for k, (d, r, e, t) in enumerate(cases)]
    df = spark.createDataFrame(rows, "candidate_id string, decision string, record string, evidence string, title string, url string, content_path string, summary string, content string, content_bytes binary")
    got = {r.candidate_id: r for r in validate.search_fallback(df, "某引擎|someengine").collect()}
    assert got["0"].fallback_errors == [] and got["0"].content_sha256 == hashlib.sha256(body).hexdigest() and got["0"].category_signals == ["过敏原sIgE试剂"]
    assert got["1"].fallback_errors == ["only for create with status=manual"] and got["2"].fallback_errors == ["category is not of: 过敏原sIgE试剂"]
    assert len(got["3"].fallback_errors) == 8 and got["3"].content_sha256 is None and got["4"].fallback_errors == []


def test_index_and_queries(spark):
    rows = [("C1", "http://a.cn/1", "content/C1.json", [1]), ("C1", "http://b.cn/1", "content/C1.json", [1]), ("C2", "http://c.cn/?t=1", "x", [1]), ("C3", "http://c.cn", "content/C3.json", [None]), (None, "ftp://q", None, None)]
    got = validate.candidate_index(spark.createDataFrame(rows, "candidate_id string, url string, content_path string, found_by_query array<int>"))
    assert {tuple(r) for r in got.collect()} == {("C1", "repeated id"), ("C2", "content_path"), ("C2", "repeated url"), ("C3", "repeated url"), ("C3", "found_by_query"), (None, "no id"), (None, "url"), (None, "content_path"), (None, "found_by_query")}
    queries = spark.createDataFrame([(1, "试剂 采购公告"), (3, "试剂"), (4, "长" * 100 + "采购")], "query_no int, query string")
    assert {tuple(r) for r in validate.query_list(queries, 4).collect()} == {(3, "ending"), (4, "too long"), (2, "missing number"), (None, "other total than declared")}
    assert [tuple(r) for r in validate.query_list(queries.limit(0)).collect()] == [(None, "empty list")]
    assert {r.query_no for r in validate.select_queries(spark, queries, "3-4, 1").collect()} == {1, 3, 4} and validate.select_queries(spark, queries, "all").count() == 3
    for bad in ("2", "a-b", "4-1"):
        with pytest.raises(ValueError):
            validate.select_queries(spark, queries, bad)


def test_query_composition(spark):
    groups = spark.createDataFrame([("甲", "A"), ("乙", "B"), ("丁", "D")], "word string, grp string")
    queries = spark.createDataFrame([(1, "甲 丁 采购公告"), (2, "甲 乙 招标"), (3, "a b c d e f g 采购"), (4, "甲"), (5, "甲 采购 招标")], "query_no int, query string")
    got = {tuple(r) for r in validate.query_composition(queries, groups).collect()}
    assert got == {(2, "several groups"), (3, "too many category words"), (4, "not one word of intent"), (5, "not one word of intent")}


def test_batches_are_taken_whole(spark):
    batch = spark.createDataFrame([("C1",), ("C2",)], "candidate_id string")
    shape = "candidate_id string, decision string, reason string, record string, evidence string"
    good = [("C1", "create", "", json.dumps(create()), json.dumps(PROOF)), ("C2", "exclude", "不符", None, None)]
    assert run.submit(spark.createDataFrame(good, shape), batch, "daily-push").count() == 2
    for bad, mode in ((good[:1], "daily-push"), ([*good, good[0]], "daily-push"), (good, "update-only"), ([good[0], ("C2", "exclude", " ", None, None)], "daily-push"), ([good[0], ("C2", "manual", "x", "{}", None)], "daily-push"), ([good[0], ("C2", "maybe", "x", None, None)], "daily-push")):
        with pytest.raises(run.Rejected):
            run.submit(spark.createDataFrame(bad, shape), batch, mode)
    assert {f.first().create for f in [run.decision_counts(spark.createDataFrame(good, shape))]} == {1}


def test_kinds_of_flat_and_other_objects(spark):
    texts = ['{"a":1,"b":"x","c":"","d":null,"e":true,"f":1.5,"g":1e300}', '{"a":{"b":null},"c":""}', '{"a: STRING, b":1,"c":""}', '{"a`":"","<":"x","é":[1]}', "{}", "[1]", "null", '{"a":1,"a":2}', "x", None, '{"a":"STRING, b: VOID"}']
    rows = spark.createDataFrame(list(enumerate(texts)), "k int, j string").orderBy("k")
    got = [r[0] for r in rows.select(variant.kinds(variant.parsed(F.col("j")))).collect()]
    assert got == [
        {"a": "NUMBER", "b": "STRING", "c": "EMPTY", "d": "VOID", "e": "BOOLEAN", "f": "NUMBER", "g": "NUMBER"}, {"a": "NESTED", "c": "EMPTY"}, {"a: STRING, b": "NUMBER", "c": "EMPTY"},
        {"a`": "EMPTY", "<": "STRING", "é": "NESTED"}, {}, None, None, None, None, None, {"a": "STRING"},
    ]


def test_record_checks_use_all_tasks(spark, tmp_path):
    """A table of one file is not checked by one task."""
    spark.sql("select id as o_orderkey, id as o_custkey, 'O' as o_orderstatus, 1e4 as o_totalprice, timestamp '1997-01-01' as o_orderdate, '5-LOW' as o_orderpriority from range(40)").coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    spark.sql("select id as c_custkey, 'n' as c_name, 1 as c_nationkey, 1e3 as c_acctbal, 'BUILDING' as c_mktsegment from range(40)").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    out = records._orders(spark, str(tmp_path))
    assert out.select(F.spark_partition_id()).distinct().count() == 4 and records.payload_check(spark, str(tmp_path)).count() == 40


def test_right_records_are_told_by_their_schema_alone(spark):
    """The pattern fits what Spark says of a right record, and of no other; a payload's constant evidence isn't read at all."""
    good = create(budget=1.5, days_left=10**30, title='a ""quoted"" word')
    bad = [good | {"title": None}, good | {"budget": "1"}, good | {"requires_manual": 0}, good | {"more": "x"}, {k: v for k, v in good.items() if k != "title"}, good | {"notes": ["x"]}]
    rows = spark.createDataFrame([(json.dumps(x, ensure_ascii=False),) for x in (good, *bad)], "j string")
    fits = F.schema_of_variant(variant.parsed(F.col("j"))).rlike(validate._right(rules.CREATE_FIELDS))
    assert [r.fits for r in rows.select(fits.alias("fits")).collect()] == [True] + [False] * 6
    found = rows.select(validate.flat_record(F.col("j"), rules.CREATE_FIELDS).alias("e"), validate.payload_file("create", F.col("j")).alias("p"))
    want = [[], ["title: null", "title: not a string"], ["budget: not a number"], ["requires_manual: not a boolean"], ["extra: more"], ["missing: title"], ["notes: nested", "notes: not a string"]]
    assert [r.e for r in found.collect()] == want and [r.p for r in found.collect()] == want
    blank = spark.createDataFrame([(json.dumps(good | {"agency": "", "budget": ""}),), ("[1]",), (None,)], "j string")
    got = [r.e for r in blank.select(validate.flat_record(F.col("j"), rules.CREATE_FIELDS).alias("e")).collect()]
    assert got == [["agency: empty string", "budget: not a number", "budget: empty string"], ["not an object"], ["not an object"]]
    plan = blank.select(validate.payload_file("create", F.col("j")))._jdf.queryExecution().optimizedPlan().toString()
    assert "checked_at" not in plan and "field_evidence" not in plan
