"""Queries of the record validators, and SQL that restates their rules over the same texts.

Records and evidence are written as JSON from columns of an order and its customer, by expressions that both engines read; what is
wrong with each follows from its values, and is worked out by each engine for itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..operators import validate

_DATE = "CAST(CAST(o_orderdate AS DATE) AS STRING)"
_MONEY = "CAST(CAST(floor({}) AS BIGINT) AS STRING)"
_REGIONS = [*rules.REGION_PROVINCES, rules.NO_REGION]


def _text(x: str) -> str:
    return f"""'"' || {x} || '"'"""


def _nth(number: str, values: list[str] | tuple[str, ...], other: str) -> str:
    return f"CASE {number} {' '.join(f'''WHEN {k} THEN '{v}' ''' for k, v in enumerate(values))} ELSE {other} END"


#: The value of each field that isn't the string null, as JSON; a null expression leaves the field out.
_SHARED = {
    "record_id": _text(f"'T' || replace({_DATE}, '-', '') || '-' || replace(substr(upper(md5(c_name)), 1, 6), '0', 'G')"),
    "deadline": _text(f"CASE o_orderstatus WHEN 'F' THEN 'null' ELSE {_DATE} || 'T09:00' END"),
    "publish_date": _text(_DATE), "notice_type": _text("c_mktsegment"),
    "source_url": _text("CASE WHEN c_acctbal > 8500 THEN 'ftp' WHEN c_acctbal > 4000 THEN 'https' ELSE 'http' END || '://a.example/' || c_custkey"),
    "winner": f"CASE WHEN o_totalprice > 480000 THEN 'null' ELSE {_text('''CASE o_orderstatus WHEN 'F' THEN c_name ELSE 'null' END''')} END",
    "award_amount": f"CASE o_orderstatus WHEN 'F' THEN {_MONEY.format('o_totalprice')} ELSE '0' END",
    "notes": f"CASE WHEN o_totalprice < 3000 THEN '[\"' || c_name || '\"]' ELSE {_text('''CASE WHEN o_orderpriority LIKE '%LOW' THEN 'null' ELSE o_orderpriority END''')} END",
}
CREATE = _SHARED | {
    "title": _text("CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'null' ELSE o_orderpriority END"),
    "region": _text(_nth("c_nationkey", [r for r in _REGIONS for _ in (0, 1)][:22], "c_mktsegment")),
    "project_code": _text("CAST(o_custkey AS STRING)"), "purchaser": _text("CASE WHEN c_acctbal < 0 THEN 'null' ELSE c_name END"),
    "agency": _text("CASE WHEN c_acctbal < -900 THEN '' ELSE 'null' END"),
    "category": _text(f"CASE c_mktsegment WHEN 'BUILDING' THEN '{rules.CATEGORIES[0]}' WHEN 'AUTOMOBILE' THEN '{rules.CATEGORIES[1]}' WHEN 'MACHINERY' THEN c_mktsegment ELSE '{rules.CATEGORIES[2]}' END"),
    "budget": f"CASE WHEN o_totalprice > 450000 AND o_orderpriority = '5-LOW' THEN {_text(_MONEY.format('o_totalprice'))} WHEN o_orderstatus = 'P' THEN '0' ELSE {_MONEY.format('o_totalprice')} END",
    "tech_key_points": f"CASE WHEN o_totalprice >= 5000 THEN {_text(_MONEY.format('o_totalprice'))} END",
    "days_left": "CAST(c_nationkey AS STRING)", "contact": _text("CASE WHEN c_acctbal > 6000 THEN c_name ELSE 'null' END"),
    "match_level": _text("CASE o_orderpriority WHEN '1-URGENT' THEN 'full' WHEN '2-HIGH' THEN 'partial' WHEN '3-MEDIUM' THEN 'unknown' WHEN '5-LOW' THEN 'full' ELSE o_orderpriority END"),
    "matched_category": _text(_nth("c_nationkey", [c for c in rules.MATCHED_CATEGORIES for _ in (0, 1)][:24], "c_name")),
    "status": _text("CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'intel' ELSE 'manual' END"),
    "requires_manual": "CASE WHEN c_acctbal > 1000 THEN 'true' ELSE 'false' END",
    "designated_supplier": _text("CASE WHEN c_acctbal > 9000 THEN c_name ELSE 'null' END"),
    "extra": f"CASE WHEN o_totalprice BETWEEN 5000 AND 9000 THEN {_text('c_name')} END",
}
UPDATE = _SHARED | {
    "change_type": _text("CASE o_orderpriority WHEN '1-URGENT' THEN 'status_change' WHEN '2-HIGH' THEN 'deadline_change' WHEN '3-MEDIUM' THEN 'correction' WHEN '5-LOW' THEN 'status_change' ELSE o_orderpriority END"),
    "status": _text("CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'closed' ELSE c_mktsegment END"),
    "budget": f"CASE WHEN o_totalprice > 470000 THEN {_text('c_name')} ELSE {_MONEY.format('o_totalprice')} END",
    "Contact": f"CASE WHEN o_totalprice BETWEEN 5000 AND 9000 THEN {_text('c_name')} END",
}


def _json(fields: tuple[str, ...], given: dict[str, str]) -> str:
    """A record with these fields and what else is given."""
    fixed = {f: "'0'" if f in rules.NUMBER_FIELDS else "'false'" if f in rules.BOOL_FIELDS else "'\"null\"'" for f in fields}
    return "'{' || concat_ws(',', " + ", ".join(f"""'"{f}":' || {x}""" for f, x in (fixed | given).items()) + ") || '}'"


def _proof(fields: tuple[str, ...]) -> str:
    """Evidence of fields, some of which have none, a blank or another kind, and of which the rest varies as well."""
    given = {f: _text("c_name") for f in fields} | {
        "budget": f"CASE WHEN o_totalprice > 60000 THEN {_text('c_name')} END", "winner": f"CASE WHEN c_nationkey > 4 THEN {_text('c_name')} END", "status": f"CASE WHEN c_nationkey > 2 THEN {_text('c_name')} END",
        "title": f"CASE c_nationkey WHEN 0 THEN {_text(''' ' ' ''')} ELSE {_text('c_name')} END", "notice_type": f"CASE c_nationkey WHEN 1 THEN '7' ELSE {_text('c_name')} END",
    }
    inner = "'{' || concat_ws(',', " + ", ".join(f"""'"{f}":' || {x}""" for f, x in given.items() if f in fields) + ") || '}'"
    parts = {
        "source_verified": "CASE WHEN c_nationkey = 5 THEN '\"yes\"' WHEN o_orderstatus = 'P' AND c_acctbal < 3000 OR c_nationkey = 6 THEN 'false' ELSE 'true' END",
        "verification_level": f"CASE WHEN c_nationkey = 7 THEN NULL WHEN c_nationkey = 8 THEN 'null' ELSE {_text('''CASE WHEN c_nationkey = 9 THEN c_mktsegment WHEN o_orderstatus = 'P' AND c_acctbal < 3000 THEN 'search_content' ELSE 'source' END''')} END",
        "checked_at": f"CASE WHEN c_nationkey = 10 THEN NULL ELSE {_text(f'''{_DATE} || CASE WHEN c_nationkey = 11 THEN '' WHEN c_nationkey = 12 THEN 'T10:00:00' WHEN c_acctbal > 2000 THEN 'T10:00:00+08:00' ELSE 'T10:00:00Z' END''')} END",
        "field_evidence": f"CASE WHEN c_nationkey = 13 THEN '{{}}' ELSE {inner} END",
    }
    return "CASE WHEN c_nationkey = 14 THEN '[' || c_nationkey || ']' ELSE '{' || concat_ws(',', " + ", ".join(f"""'"{k}":' || {x}""" for k, x in parts.items()) + ") || '}' END"


def _orders(s: SparkSession, d: str) -> DataFrame:
    """Orders with their customers, over as many tasks as there can be: few bytes, much work, and a small table is read by one task."""
    read = lambda t: s.read.parquet(f"{d}/{t}.parquet")
    tasks = int(s.conf.get("spark.sql.shuffle.partitions"))
    return read("orders").join(read("customer"), F.col("o_custkey") == F.col("c_custkey")).repartition(tasks, "o_orderkey")


def _errors(s: SparkSession, d: str, record: str, proof: str, check) -> DataFrame:
    rows = _orders(s, d).select("o_orderkey", F.expr(record).alias("j"), F.expr(proof).alias("e"))
    return rows.select("o_orderkey", F.array_join(check(F.col("j"), F.col("e")), "; ").alias("errors"))


def create_check(s, d):
    return _errors(s, d, _json(rules.CREATE_FIELDS, CREATE), _proof(rules.CREATE_FIELDS), validate.create_record)


def update_check(s, d):
    return _errors(s, d, _json(rules.UPDATE_FIELDS, UPDATE), _proof(rules.UPDATE_FIELDS), validate.update_record)


def evidence_check(s, d):
    def both(j: Column, e: Column) -> Column:
        return validate.evidence(e, F.get_json_object(j, "$.status") == "manual")

    return _errors(s, d, _json(rules.CREATE_FIELDS, CREATE), _proof(rules.CREATE_FIELDS), both)


def payload_check(s, d):
    """Payloads of both flows, by themselves."""
    rows = _orders(s, d).select("o_orderkey", F.expr(_json(rules.CREATE_FIELDS, CREATE)).alias("c"), F.expr(_json(rules.UPDATE_FIELDS, UPDATE)).alias("u"))
    said = {"create_errors": ("create", "c"), "update_errors": ("update", "u")}
    return rows.select("o_orderkey", *[F.array_join(validate.payload_file(flow, F.col(c)), "; ").alias(n) for n, (flow, c) in said.items()])


def structure_check(s, d):
    return _errors(s, d, _json(rules.UPDATE_FIELDS, UPDATE), "''", lambda j, _: validate.structure(j, rules.UPDATE_FIELDS))


QUERIES = {f.__name__: f for f in (create_check, update_check, evidence_check, payload_check, structure_check)}


def _list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _said(tests: list[tuple[str, str]]) -> str:
    """SQL for the messages of the conditions that hold."""
    return "[x FOR x IN [" + ", ".join(f"CASE WHEN {c} THEN {m} END" for c, m in tests) + "] IF x IS NOT NULL]"


def _t(f: str, j: str = "j") -> str:
    return f"json_extract_string({j}, '$.{f}')"


def _k(f: str, j: str = "j") -> str:
    return f"json_type({j}, '$.{f}')"


def _flat_sql(fields: tuple[str, ...]) -> str:
    tests = [
        (f"len(list_filter({_list(fields)}, lambda f: NOT list_contains(json_keys(j), f))) > 0", f"'missing: ' || array_to_string(list_sort(list_filter({_list(fields)}, lambda f: NOT list_contains(json_keys(j), f))), ',')"),
        (f"len(list_filter(json_keys(j), lambda f: NOT list_contains({_list(fields)}, f))) > 0", f"'extra: ' || array_to_string(list_sort(list_filter(json_keys(j), lambda f: NOT list_contains({_list(fields)}, f))), ',')"),
    ]
    for f in fields:
        kinds, name = (("UBIGINT", "BIGINT", "DOUBLE"), "number") if f in rules.NUMBER_FIELDS else (("BOOLEAN",), "boolean") if f in rules.BOOL_FIELDS else (("VARCHAR",), "string")
        tests += [(f"{_k(f)} = 'NULL'", f"'{f}: null'"), (f"{_k(f)} IN ('OBJECT', 'ARRAY')", f"'{f}: nested'"), (f"{_k(f)} NOT IN {kinds if len(kinds) > 1 else str(kinds).replace(',', '')}", f"'{f}: not a {name}'"), (f"{_k(f)} = 'VARCHAR' AND {_t(f)} = ''", f"'{f}: empty string'")]
    return _said(tests)


def _proof_sql(allowed: str) -> str:
    level = f"CASE WHEN coalesce({_k('verification_level', 'e')}, 'NULL') = 'NULL' THEN CASE WHEN {_t('source_verified', 'e')} = 'true' AND {_k('source_verified', 'e')} = 'BOOLEAN' THEN 'source' END ELSE {_t('verification_level', 'e')} END"
    verified = f"CASE WHEN {_k('source_verified', 'e')} = 'BOOLEAN' THEN {_t('source_verified', 'e')} = 'true' END"
    at, keys = _t("checked_at", "e"), "json_keys(e, '$.field_evidence')"
    tests = [
        (f"coalesce({level}, '') NOT IN ('source', 'search_content')", "'verification_level is neither source nor search_content'"),
        (f"{level} = 'source' AND NOT coalesce({verified}, false)", "'source_verified must be true'"), (f"{level} = 'search_content' AND NOT {allowed}", "'search_content only for status=manual'"),
        (f"{level} = 'search_content' AND coalesce({verified}, true)", "'source_verified must be false'"), (f"coalesce({at}, '') = ''", "'checked_at is missing'"),
        (f"{at} <> '' AND NOT regexp_matches({at}, '^[0-9-]{{10}}T[0-9:]{{8}}(Z|[+-][0-9]{{2}}:[0-9]{{2}})$')", "'checked_at is no time with a zone'"), (f"coalesce(len({keys}), 0) = 0", "'field_evidence is empty'"),
        (f"len(list_filter({keys}, lambda f: json_type(e, '$.field_evidence.' || f) <> 'VARCHAR' OR trim(json_extract_string(e, '$.field_evidence.' || f)) = '')) > 0", "'field_evidence has a blank'"),
    ]
    return f"CASE WHEN json_type(e) = 'OBJECT' THEN {_said(tests)} ELSE ['evidence is not an object'] END"


def _required_sql(always: tuple[str, ...], sometimes: list[tuple[str, str]]) -> str:
    needed = f"list_concat({_list(always)}, {_said([(c, f"'{f}'") for c, f in sometimes])})"
    lacking = f"list_sort(list_filter({needed}, lambda f: coalesce(json_extract_string(e, '$.field_evidence.' || f), '') = ''))"
    return f"CASE WHEN len({lacking}) > 0 THEN ['no evidence: ' || array_to_string({lacking}, ',')] ELSE [] END"


def _in(f: str, xs) -> str:
    return f"{_t(f)} NOT IN ({', '.join(f"'{x}'" for x in xs)})"


def _common_sql(statuses, regions=()) -> list[tuple[str, str]]:
    return [
        (f"NOT regexp_matches({_t('record_id')}, '^T[0-9]{{8}}-[A-HJ-NP-Z2-9]{{6}}$')", "'record_id'"), (_in("status", statuses), "'status'"), (f"NOT regexp_matches({_t('source_url')}, '^https?://')", "'source_url'"),
        *([(_in("region", regions), "'region'")] if regions else []),
    ]


def _create_sql(proven: bool = False) -> str:
    active, manual, vague = f"{_t('status')} = 'active'", f"{_t('status')} = 'manual'", _in("match_level", ("full", "partial"))
    tests = [
        *_common_sql(rules.CREATE_STATUSES, _REGIONS), *[(_in(f, xs), f"'{f}'") for f, xs in (("category", rules.CATEGORIES), ("match_level", rules.MATCH_LEVELS), ("matched_category", rules.MATCHED_CATEGORIES))],
        *[(f"{_t(f)} = 'null'", f"'{f} is required'") for f in ("title", "purchaser")], (f"{active} AND {vague}", "'active needs a match'"), (f"{active} AND {_t('deadline')} = 'null'", "'active needs a deadline'"),
        (f"{active} AND {_t('designated_supplier')} <> 'null'", "'active has a designated supplier'"), (f"{manual} AND {_t('requires_manual')} = 'false'", "'manual needs requires_manual'"),
        (f"{manual} AND {vague}", "'manual needs a match'"), (f"{manual} AND {_t('notes')} = 'null'", "'manual needs notes'"),
    ]
    needed = _required_sql(("title", "purchaser", "source_url", "matched_category"), [(active, "deadline"), (f"TRY_CAST({_t('budget')} AS DOUBLE) > 0", "budget"), *[(f"{_t(f)} <> 'null'", f) for f in ("contact", "attachment")]])
    return _whole(rules.CREATE_FIELDS, tests, manual, needed, proven)


def _update_sql(proven: bool = False) -> str:
    turned = f"{_t('change_type')} = 'status_change'"
    tests = [*_common_sql(rules.UPDATE_STATUSES), (_in("change_type", rules.CHANGE_TYPES), "'change_type'")]
    needed = _required_sql(("source_url", "notice_type", "publish_date"), [(turned, "status"), (f"{turned} AND {_t('winner')} <> 'null'", "winner"), (f"{turned} AND TRY_CAST({_t('award_amount')} AS DOUBLE) > 0", "award_amount"), (f"{_t('change_type')} = 'deadline_change'", "deadline")])
    return _whole(rules.UPDATE_FIELDS, tests, "false", needed, proven)


def _whole(fields, tests, allowed: str, needed: str, proven: bool) -> str:
    """All errors of a record; with wrong fields only those and the evidence's. A record that is taken as proven has no evidence."""
    good = _said(tests) if proven else f"list_concat({_said(tests)}, {_proof_sql(allowed)}, {needed})"
    wrong = "flat" if proven else f"list_concat(flat, {_proof_sql('false')})"
    return f"array_to_string(CASE WHEN len(flat) > 0 THEN {wrong} ELSE {good} END, '; ')"


def _sql(record: str, proof: str, fields, select: str) -> str:
    return f"WITH r AS (SELECT o_orderkey, {record} AS j, {proof} AS e FROM orders JOIN customer ON o_custkey = c_custkey), f AS (SELECT *, {_flat_sql(fields)} AS flat FROM r) SELECT o_orderkey, {select} FROM f"


def _structure_sql(fields) -> str:
    tests = [(f"len(list_filter({_list(fields)}, lambda f: NOT list_contains(json_keys(j), f))) > 0", "'missing'"), (f"len(list_filter(json_keys(j), lambda f: NOT list_contains({_list(fields)}, f))) > 0", "'extra'")]
    return f"array_to_string({_said(tests + [(f"{_k(f)} IN ('NULL', 'OBJECT', 'ARRAY')", f"'{f}: null or nested'") for f in fields])}, '; ') AS errors"


_C, _U = _json(rules.CREATE_FIELDS, CREATE), _json(rules.UPDATE_FIELDS, UPDATE)
SQL = {
    "create_check": _sql(_C, _proof(rules.CREATE_FIELDS), rules.CREATE_FIELDS, f"{_create_sql()} AS errors"),
    "update_check": _sql(_U, _proof(rules.UPDATE_FIELDS), rules.UPDATE_FIELDS, f"{_update_sql()} AS errors"),
    "evidence_check": _sql(_C, _proof(rules.CREATE_FIELDS), rules.CREATE_FIELDS, f"array_to_string({_proof_sql(_t('status') + " = 'manual'")}, '; ') AS errors"),
    "payload_check": f"SELECT o_orderkey, c.errors AS create_errors, u.errors AS update_errors FROM ({_sql(_C, "''", rules.CREATE_FIELDS, f"{_create_sql(True)} AS errors")}) c JOIN ({_sql(_U, "''", rules.UPDATE_FIELDS, f"{_update_sql(True)} AS errors")}) u USING (o_orderkey)",
    "structure_check": _sql(_U, "''", rules.UPDATE_FIELDS, _structure_sql(rules.UPDATE_FIELDS)),
}
