"""Validation: every rule is a row of (condition, message), all that fail are listed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as T
from ..functions import time as D
from ..functions import variant as V
from ..functions.url import is_http, normalize_url

Tests = Sequence[tuple[Column, str | Column]]


def errors(tests: Tests) -> Column:
    """The messages of the conditions that hold; a null condition doesn't."""
    return F.array_compact(F.array(*[F.when(c, F.lit(m) if isinstance(m, str) else m) for c, m in tests]))


def _set(names: Sequence[str]) -> Column:
    return F.array(*[F.lit(x) for x in names]).cast("array<string>")


def flat_record(json: Column, fields: Sequence[str], duplicates_ok: bool = False) -> Column:
    """Errors of a JSON record that must have exactly these fields, flat, without nulls or empty strings, each of its kind.

    A text that doesn't parse (also one with a key twice) is one error.
    """
    return V.bound(V.parsed(json), lambda v: _flat(v, json, fields))


def _flat(v: Column, json: Column, fields: Sequence[str]) -> Column:
    def found(kinds: Column) -> Column:
        keys = F.map_keys(kinds)
        missing, extra = F.array_sort(F.array_except(_set(fields), keys)), F.array_sort(F.array_except(keys, _set(fields)))
        tests: list = [
            (F.size(missing) > 0, F.concat(F.lit("missing: "), F.array_join(missing, ","))),
            (F.size(extra) > 0, F.concat(F.lit("extra: "), F.array_join(extra, ","))),
        ]

        def wrong(f: str) -> Column:
            want = "NUMBER" if f in rules.NUMBER_FIELDS else "BOOLEAN" if f in rules.BOOL_FIELDS else "STRING"
            other, empty = f"{f}: not a {want.lower()}", f"{f}: empty string"
            said = lambda *x: F.array(*[F.lit(m) for m in x])
            return V.bound(F.try_element_at(kinds, F.lit(f)), lambda k: (
                F.when(k.isNull() | (k == want), None).when(k == "VOID", said(f"{f}: null", other)).when(k == "NESTED", said(f"{f}: nested", other))
                .when(k == "EMPTY", said(empty) if want == "STRING" else said(other, empty)).otherwise(said(other))
            ))

        each = F.flatten(F.array_compact(F.array(*[wrong(f) for f in fields])))
        return F.when(kinds.isNull(), F.array(F.lit("not an object"))).otherwise(F.concat(errors(tests), each))

    # Most records are as they should be: their schema, one text, tells it at once, and no empty string is written in them.
    right = F.coalesce(F.schema_of_variant(v).rlike(_right(fields)) & ~F.contains(json, F.lit('""')), F.lit(False))
    return F.when(right, F.array().cast("array<string>")).otherwise(V.bound(V.kinds(v), found))


def _right(fields: Sequence[str]) -> str:
    """A pattern of the schema of an object with exactly these fields, each of its kind."""
    number = r"(?:BIGINT|DOUBLE|FLOAT|DECIMAL\([0-9]+,[0-9]+\))"
    kinds = (f"{f}: {number if f in rules.NUMBER_FIELDS else 'BOOLEAN' if f in rules.BOOL_FIELDS else 'STRING'}" for f in sorted(fields))
    return f"^OBJECT<{', '.join(kinds)}>$"


def evidence(json: Column, allow_search_content: Column) -> Column:
    """Errors of an evidence object: level, verified flag, time with zone, and texts for fields."""
    return V.bound(V.parsed(json), lambda v: _evidence(v, allow_search_content))


def _evidence(v: Column, allow_search_content: Column) -> Column:
    fields = V.bound(F.try_variant_get(v, "$.field_evidence", "variant"), lambda f: F.struct(V.kinds(f).alias("kinds"), V.texts(f).alias("texts")))
    at = F.when(V.kind(v, "checked_at") == "STRING", V.text(v, "checked_at"))
    verified = F.when(V.kind(v, "source_verified") == "BOOLEAN", F.try_variant_get(v, "$.source_verified", "boolean"))
    read = F.struct(fields.alias("fields"), verified.alias("verified"), V.kind(v, "verification_level").alias("said"), V.text(v, "verification_level").alias("level"), at.alias("at"))
    return F.when(V.is_object(v), V.bound(read, lambda b: _proven(b, allow_search_content))).otherwise(F.array(F.lit("evidence is not an object")))


def _proven(b: Column, allow_search_content: Column) -> Column:
    """Errors of what `_evidence` has read."""
    verified, said, at, fields = b["verified"], b["said"], b["at"], b["fields"]
    level = F.when((said.isNull() | (said == "VOID")) & verified, F.lit("source")).when(said == "STRING", b["level"])
    known = F.coalesce(level.isin("source", "search_content"), F.lit(False))
    blank = F.exists(F.map_values(fields["kinds"]), lambda k: ~k.isin("STRING", "EMPTY")) | F.exists(F.map_values(fields["texts"]), lambda x: F.trim(F.coalesce(x, F.lit(""))) == "")
    tests = [
        (~known, "verification_level is neither source nor search_content"),
        (known & (level == "source") & ~F.coalesce(verified, F.lit(False)), "source_verified must be true"),
        (known & (level == "search_content") & ~allow_search_content, "search_content only for status=manual"),
        (known & (level == "search_content") & F.coalesce(verified, F.lit(True)), "source_verified must be false"),
        (F.coalesce(at, F.lit("")) == "", "checked_at is missing"),
        ((F.coalesce(at, F.lit("")) != "") & D.zoned(at).isNull(), "checked_at is no time with a zone"),
        (F.coalesce(F.size(fields["kinds"]), F.lit(0)) < 1, "field_evidence is empty"), (blank, "field_evidence has a blank"),
    ]
    return errors(tests)


def evidenced(json: Column, required: Column) -> Column:
    """An error naming the required fields that the evidence lacks."""
    return V.bound(V.parsed(json), lambda v: _evidenced(v, required))


def _evidenced(v: Column, required: Column) -> Column:
    fields = F.coalesce(F.try_variant_get(v, "$.field_evidence", "map<string,string>"), F.create_map().cast("map<string,string>"))
    there = F.map_keys(F.map_filter(fields, lambda _, x: F.coalesce(x, F.lit("")) != ""))
    none = F.array().cast("array<string>")
    return V.bound(F.array_sort(F.array_except(required, there)), lambda missing: F.when(F.size(missing) > 0, F.array(F.concat(F.lit("no evidence: "), F.array_join(missing, ",")))).otherwise(none))


def _read(json: Column, proof: Column, fields: Sequence[str], use) -> Column:
    """use(record, evidence, errors of the record's fields), each worked out once."""
    return V.bound(F.struct(V.parsed(json).alias("v"), V.parsed(proof).alias("e")), lambda b: V.bound(_flat(b["v"], json, fields), lambda flat: use(b["v"], b["e"], flat)))


def _common(t: Callable[[str], Column], regions: Sequence[str] | None, status: Sequence[str]) -> list:
    tests = [(~T.is_record_id(t("record_id")), "record_id"), (~t("status").isin(*status), "status"), (~is_http(t("source_url")), "source_url")]
    return tests + ([(~t("region").isin(*regions), "region")] if regions else [])


def create_record(json: Column, proof: Column) -> Column:
    """Errors of a record to be created, with its evidence; if its fields are wrong, only those and the evidence's errors."""
    return _read(json, proof, rules.CREATE_FIELDS, _create)


def _wrong(proof: Column, flat: Column, good: Column) -> Column:
    """A record's errors: with wrong fields these and the evidence's, else what the rules say."""
    return F.when(F.size(flat) > 0, F.concat(flat, _evidence(proof, F.lit(False)))).otherwise(good)


def _create(v: Column, proof: Column, flat: Column) -> Column:
    return _wrong(proof, flat, V.bound(V.texts(v), lambda said: _create_rules(v, said, proof)))


def _create_tests(v: Column, said: Column) -> list:
    t = lambda f: F.try_element_at(said, F.lit(f))
    active, manual = t("status") == "active", t("status") == "manual"
    vague = ~t("match_level").isin("full", "partial")
    return [
        *_common(t, [*rules.REGION_PROVINCES, rules.NO_REGION], rules.CREATE_STATUSES),
        (~t("category").isin(*rules.CATEGORIES), "category"), (~t("match_level").isin(*rules.MATCH_LEVELS), "match_level"),
        (~t("matched_category").isin(*rules.MATCHED_CATEGORIES), "matched_category"),
        (t("title") == "null", "title is required"), (t("purchaser") == "null", "purchaser is required"),
        (active & vague, "active needs a match"), (active & (t("deadline") == "null"), "active needs a deadline"),
        (active & (t("designated_supplier") != "null"), "active has a designated supplier"),
        (manual & ~F.try_variant_get(v, "$.requires_manual", "boolean"), "manual needs requires_manual"),
        (manual & vague, "manual needs a match"), (manual & (t("notes") == "null"), "manual needs notes"),
    ]


def _create_rules(v: Column, said: Column, proof: Column) -> Column:
    t = lambda f: F.try_element_at(said, F.lit(f))
    active, manual = t("status") == "active", t("status") == "manual"
    required = F.array_compact(F.array(
        *[F.lit(x) for x in ("title", "purchaser", "source_url", "matched_category")], F.when(active, F.lit("deadline")),
        F.when(V.number(v, "budget") > 0, F.lit("budget")), *[F.when(t(f) != "null", F.lit(f)) for f in ("contact", "attachment")],
    ))
    return F.concat(errors(_create_tests(v, said)), _evidence(proof, F.coalesce(manual, F.lit(False))), _evidenced(proof, required))


def update_record(json: Column, proof: Column) -> Column:
    """Errors of an update record, with its evidence."""
    return _read(json, proof, rules.UPDATE_FIELDS, _update)


def _update(v: Column, proof: Column, flat: Column) -> Column:
    return _wrong(proof, flat, V.bound(V.texts(v), lambda said: _update_rules(v, said, proof)))


def _update_tests(v: Column, said: Column) -> list:
    t = lambda f: F.try_element_at(said, F.lit(f))
    return [*_common(t, None, rules.UPDATE_STATUSES), (~t("change_type").isin(*rules.CHANGE_TYPES), "change_type")]


def _update_rules(v: Column, said: Column, proof: Column) -> Column:
    t = lambda f: F.try_element_at(said, F.lit(f))
    change = t("change_type")
    turned = change == "status_change"
    required = F.array_compact(F.array(
        *[F.lit(x) for x in ("source_url", "notice_type", "publish_date")], F.when(turned, F.lit("status")), F.when(turned & (t("winner") != "null"), F.lit("winner")),
        F.when(turned & (V.number(v, "award_amount") > 0), F.lit("award_amount")), F.when(change == "deadline_change", F.lit("deadline")),
    ))
    return F.concat(errors(_update_tests(v, said)), _evidence(proof, F.lit(False)), _evidenced(proof, required))


def payload_file(flow: str, json: Column) -> Column:
    """Errors of a payload by itself, all its fields taken as proven: those of its fields, or if these are right those of the rules."""
    fields, tests = (rules.CREATE_FIELDS, _create_tests) if flow == "create" else (rules.UPDATE_FIELDS, _update_tests)
    said = lambda v: V.bound(V.texts(v), lambda t: errors(tests(v, t)))
    return V.bound(V.parsed(json), lambda v: V.bound(_flat(v, json, fields), lambda flat: F.when(F.size(flat) > 0, flat).otherwise(said(v))))


def structure(json: Column, fields: Sequence[str]) -> Column:
    """The sender's check: an object, no nulls or nesting, exactly these fields (case counts)."""

    def found(kinds: Column) -> Column:
        keys = F.map_keys(kinds)
        tests: list = [(F.size(F.array_except(_set(fields), keys)) > 0, "missing"), (F.size(F.array_except(keys, _set(fields))) > 0, "extra")]
        tests += [(F.try_element_at(kinds, F.lit(f)).isin("VOID", "NESTED"), f"{f}: null or nested") for f in fields]
        return F.when(kinds.isNull(), F.array(F.lit("not an object"))).otherwise(errors(tests))

    return V.bound(V.parsed(json), lambda v: V.bound(V.kinds(v), found))


def search_fallback(
    rows: DataFrame, engine: str, exclusions: Sequence[rules.Rule] = rules.EXCLUSIONS, intent: Sequence[str] = rules.INTENT_WORDS, signals: Sequence[rules.Rule] = rules.SIGNALS
) -> DataFrame:
    """Adds fallback_errors, content_sha256 and category_signals to result rows that rest on search content only.

    Rows have decision, record and evidence (JSON), and of their candidate: title, url, content_path, summary, content and the
    content file's bytes. `engine` is the pattern of the search engine's names, of which the notes must name one. Other rows
    get no errors. Nothing in the evidence given may be what is computed here.
    """
    r, e = V.parsed(F.col("record")), V.parsed(F.col("evidence"))
    rests = F.coalesce(V.text(e, "verification_level") == "search_content", F.lit(False))
    fits = F.coalesce((F.col("decision") == "create") & (V.text(r, "status") == "manual"), F.lit(False))
    notes = F.coalesce(V.text(r, "notes"), F.lit(""))
    found = T.all_matches(F.concat_ws("\n", F.coalesce("summary", F.lit("")), F.coalesce("content", F.lit(""))), signals)
    table = F.create_map(*[x for k, vs in rules.SIGNAL_CATEGORIES.items() for x in (F.lit(k), _set(vs))])
    allowed = F.array_sort(F.array_distinct(F.flatten(F.transform(found, lambda s: F.coalesce(table[s], F.array(s))))))
    own = F.array_intersect(F.array_sort(V.keys(F.col("evidence"))), _set(("category_signals", "content_sha256")))
    excluded = T.first_match(F.col("title"), exclusions)
    tests = [
        (normalize_url(V.text(r, "source_url")) != normalize_url(F.col("url")), "source_url is not the candidate's"),
        (~F.coalesce(V.text(e, "content_path").eqNullSafe(F.col("content_path")), F.lit(False)), "content_path is not the candidate's"),
        (F.size(own) > 0, F.concat(F.lit("generated keys given: "), F.array_join(own, ","))),
        (~notes.rlike(rules.java(engine)), "notes don't name the search engine"),
        (~T.has_any(notes, rules.UNVERIFIED_WORDS), "notes don't say why the page is unverified"),
        (~F.contains(notes, F.lit(rules.BY_HAND)), "notes don't ask for a check by hand"),
        (excluded.isNotNull(), F.concat(F.lit("title is excluded: "), excluded)), (~T.has_any(F.col("title"), intent), "title has no intent"),
        (F.size(found) == 0, "content has no signal"),
        ((F.size(found) > 0) & ~F.coalesce(F.array_contains(allowed, V.text(r, "matched_category")), F.lit(False)), F.concat(F.lit("category is not of: "), F.array_join(allowed, ","))),
    ]
    none = F.array().cast("array<string>")
    out = rows.withColumn("fallback_errors", F.when(~rests, none).when(~fits, F.array(F.lit("only for create with status=manual"))).otherwise(errors(tests)))
    good = rests & (F.size("fallback_errors") == 0)
    return out.withColumn("content_sha256", F.when(good, F.sha2(F.col("content_bytes"), 256))).withColumn("category_signals", F.when(good, found))


def candidate_index(index: DataFrame, contents: DataFrame | None = None) -> DataFrame:
    """(candidate_id, error) of an index: missing or repeated ids, URLs that are no http(s) or the same once normalized, full
    texts in it, a content_path that isn't the id's, missing content, queries that are no whole numbers."""
    u = normalize_url(F.col("url"))
    rows = index.select("candidate_id", errors([
        (F.coalesce("candidate_id", F.lit("")) == "", "no id"), (~is_http(F.col("url")), "url"),
        *[(F.lit(True), f"full text: {c}") for c in ("summary", "content") if c in index.columns],
        (~F.coalesce(F.col("content_path") == F.concat(F.lit("content/"), F.col("candidate_id"), F.lit(".json")), F.lit(False)), "content_path"),
        (F.col("found_by_query").isNull() | F.exists(F.coalesce("found_by_query", F.array().cast("array<int>")), lambda x: x.isNull()), "found_by_query"),
    ]).alias("e")).select("candidate_id", F.explode("e").alias("error"))
    ids = index.where("candidate_id <> ''").groupBy("candidate_id").count().where("count > 1").select("candidate_id", F.lit("repeated id").alias("error"))
    urls = index.groupBy(u.alias("u")).agg(F.collect_set("candidate_id").alias("c"), F.count("*").alias("n")).where("n > 1").select(F.explode("c").alias("candidate_id"), F.lit("repeated url").alias("error"))
    out = rows.union(ids).union(urls)
    if contents is not None:
        lost = index.select("candidate_id").join(contents.select("candidate_id"), "candidate_id", "left_anti")
        out = out.union(lost.select("candidate_id", F.lit("no content")))
    return out


def query_list(queries: DataFrame, declared: int | None = None, endings: Sequence[str] = rules.QUERY_ENDINGS, most: int = rules.QUERY_CHARS) -> DataFrame:
    """(query_no, error): wrong endings, too long, gaps in 1..max, and another total than declared. An empty list is an error."""
    rows = queries.select("query_no", F.explode(errors([
        (~F.coalesce(F.col("query").rlike("(" + "|".join(endings) + ")$"), F.lit(False)), "ending"), (F.length("query") > most, "too long"),
    ])).alias("error"))
    gaps = queries.agg(F.max("query_no").alias("m")).where("m >= 1").select(F.explode(F.sequence(F.lit(1), F.col("m"))).alias("query_no"))
    gaps = gaps.join(queries.select("query_no"), "query_no", "left_anti").select("query_no", F.lit("missing number").alias("error"))
    n = queries.agg(F.count("*").alias("n"))
    none = n.where("n = 0").select(F.lit(None).cast("int").alias("query_no"), F.lit("empty list").alias("error"))
    out = rows.union(gaps).union(none)
    return out if declared is None else out.union(n.where(F.col("n") != declared).select(F.lit(None).cast("int"), F.lit("other total than declared")))


def query_composition(queries: DataFrame, groups: DataFrame, most: int = 6, endings: Sequence[str] = rules.QUERY_ENDINGS, free: Sequence[str] = ("D",)) -> DataFrame:
    """(query_no, error) of queries that mix what the prose keeps apart: more than `most` category words, another number of words
    of intent than one, or category words of several groups. `groups` has word and grp; groups in `free` go with any."""
    words = queries.select("query_no", F.filter(F.split(F.trim("query"), r"\s+"), lambda w: w != "").alias("w"))
    intent = F.filter("w", lambda w: w.isin(*endings))
    rows = words.select("query_no", errors([
        (F.size("w") - F.size(intent) > most, "too many category words"), (F.size(intent) != 1, "not one word of intent"),
    ]).alias("e")).select("query_no", F.explode("e").alias("error"))
    known = words.select("query_no", F.explode("w").alias("word")).join(groups, "word").where(~F.col("grp").isin(*free))
    mixed = known.groupBy("query_no").agg(F.countDistinct("grp").alias("n")).where("n > 1")
    return rows.union(mixed.select("query_no", F.lit("several groups")))


def unknown_queries(spark: SparkSession, queries: DataFrame, spec: str) -> DataFrame:
    """(query_no) of a selection's numbers that no query has. Bad ranges fail."""
    return _selected(spark, spec).join(queries, "query_no", "left_anti")


def _selected(spark: SparkSession, spec: str) -> DataFrame:
    wanted: list[tuple[int, int]] = []
    for part in spec.split(","):
        a, _, b = part.strip().partition("-")
        if not a.isdigit() or (b and not b.isdigit()) or (b and int(b) < int(a)):
            raise ValueError(f"{part} selects no queries")
        wanted.append((int(a), int(b or a)))
    return spark.createDataFrame(wanted, "a int, b int").select(F.explode(F.sequence("a", "b")).alias("query_no")).distinct()


def select_queries(spark: SparkSession, queries: DataFrame, spec: str) -> DataFrame:
    """The queries of a selection like 1-4,39; all for an empty one or `all`. Unknown numbers and bad ranges fail."""
    if spec.strip() in ("", "all"):
        return queries
    if unknown := [r[0] for r in unknown_queries(spark, queries, spec).orderBy("query_no").limit(20).collect()]:
        raise ValueError(f"unknown queries: {unknown}")
    return queries.join(_selected(spark, spec), "query_no", "left_semi")


def with_candidate(results: DataFrame, batch: DataFrame) -> DataFrame:
    """Results with their candidate's columns and an error where the batch has none; of repeated candidates one counts."""
    own = batch.dropDuplicates(["candidate_id"]).withColumn("_there", F.lit(True))
    joined = results.join(own, "candidate_id", "left")
    return joined.withColumn("error", F.when(F.col("_there").isNull(), "not in batch")).drop("_there")


def batch_results(results: DataFrame, batch: DataFrame, mode: str) -> DataFrame:
    """(candidate_id, error): ids on one side only or twice, unknown decisions, creates where only updates go, and
    exclusions without a reason or with a record. Any row means that the whole batch is rejected."""
    both = results.select("candidate_id", F.lit(True).alias("_r")).distinct().join(batch.select("candidate_id", F.lit(True).alias("_b")).distinct(), "candidate_id", "full")
    ids = both.where("_r is null or _b is null").select("candidate_id", F.when(F.col("_r").isNull(), "no result").otherwise("not in batch").alias("error"))
    twice = results.groupBy("candidate_id").count().where("count > 1").select("candidate_id", F.lit("repeated").alias("error"))
    out = F.col("decision").isin("exclude", "manual")
    rows = results.select("candidate_id", F.explode(errors([
        (~F.coalesce(F.col("decision").isin(*rules.DECISIONS), F.lit(False)), "decision"),
        ((F.col("decision") == "create") & F.lit(mode == "update-only"), "create in update-only"),
        (out & (F.coalesce(F.trim("reason"), F.lit("")) == ""), "no reason"), (out & F.col("record").isNotNull(), "record given"),
    ])).alias("error"))
    checks = results.where("decision in ('create', 'update')").select("candidate_id", F.explode(
        F.when(F.col("decision") == "create", create_record(F.col("record"), F.col("evidence"))).otherwise(update_record(F.col("record"), F.col("evidence")))
    ).alias("error"))
    return ids.union(twice).union(rows).union(checks)
