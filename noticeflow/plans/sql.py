"""DuckDB SQL with the rows of plans.queries."""

from __future__ import annotations

#: Pages as candidates, history and hits, as the queries have them.
_TITLE = r"regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"
_FP = r"regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', '', 'g')"
_CAND = f"""c AS (SELECT page_id AS ord, printf('P%06d', page_id) AS candidate_id, {_TITLE} AS title, {_FP.format(_TITLE)} AS fp, url, CAST(page_id % 7 AS INTEGER) AS q, html FROM pages)"""
_NORM_OF = r"""regexp_replace(regexp_replace(
    regexp_replace(regexp_replace(regexp_replace({0}, '#.*$', ''), '([?&])utm_[^&]*', '\1', 'g'), '[?&]+$', ''),
    '^([^?]*?)/+($|\?)', '\1\2'), '^(https?://[^/?]+)($|\?)', '\1/\2')"""
_CLUSTER = f"""{_CAND}, k AS (SELECT *, CASE WHEN length(fp) < 8 THEN '#' || candidate_id ELSE fp END AS key FROM c),
  cl AS (SELECT arg_min(candidate_id, ord) AS candidate_id, arg_min(title, ord) AS title, arg_min(url, ord) AS url, list_sort(list_distinct(list(q))) AS found_by_query,
         list(candidate_id ORDER BY ord) AS cluster_members, min(ord) AS ord, arg_min(html, ord) AS html FROM k GROUP BY key)"""
_SEEN = "seen AS (SELECT ord AS seen_ord, candidate_id AS record_id, url AS source_url, title, substr(title, 1, 12) AS code FROM c WHERE ord % 3 = 0)"
_HIT = "h AS (SELECT CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) AS query_no, doc_id AS pos, sha256(coalesce(text, '')) AS url, lang AS site_name, CAST(doc_id AS VARCHAR) AS title FROM documents)"
_DEDUP = f"{_HIT}, dd AS (SELECT url, arg_min(title, query_no * 4294967296 + pos) AS title, arg_min(site_name, query_no * 4294967296 + pos) AS site_name, list_sort(list_distinct(list(query_no))) AS found_by_query FROM h GROUP BY url)"
_LOW = "lower(title || ' ' || title)"
#: From pr (a, b): ratios (a, b, ratio), their similarity, and alike (a, b), those with 0.86 or more; strings under 200 characters. Runs of equal characters on
#: a diagonal are found once; each range of a pair then takes its longest run, the earliest in a and b of several, and is split by it.
_ALIKE = """p AS (SELECT row_number() OVER () AS p, a, b FROM pr),
  pa AS (SELECT a, unnest(string_split(a, '')) AS x, generate_subscripts(string_split(a, ''), 1) - 1 AS i FROM (SELECT DISTINCT a FROM p)),
  pb AS (SELECT b, unnest(string_split(b, '')) AS x, generate_subscripts(string_split(b, ''), 1) - 1 AS j FROM (SELECT DISTINCT b FROM p)),
  runs AS (SELECT p, min(i) AS i, min(j) AS j, count(*) AS n FROM (
      SELECT p, i, j, i - row_number() OVER (PARTITION BY p, i - j ORDER BY i) AS g FROM p JOIN pa USING (a) JOIN pb ON pb.b = p.b AND pb.x = pa.x) GROUP BY p, i - j, g),
  span AS (SELECT p, 0 AS al, length(a) AS ah, 0 AS bl, length(b) AS bh FROM p
      UNION ALL
      SELECT p, y.al, y.ah, y.bl, y.bh FROM (
          SELECT p, unnest([{'al': al, 'ah': t.i, 'bl': bl, 'bh': t.j}, {'al': t.i - t.n, 'ah': ah, 'bl': t.j - t.n, 'bh': bh}]) AS y FROM (
              SELECT p, al, ah, bl, bh, min({'n': greatest(0, al - i, bl - j) - least(n, ah - i, bh - j), 'i': i + greatest(0, al - i, bl - j), 'j': j + greatest(0, al - i, bl - j)}) AS t
              FROM span JOIN runs USING (p) WHERE least(n, ah - i, bh - j) > greatest(0, al - i, bl - j) GROUP BY ALL)) WHERE y.al < y.ah AND y.bl < y.bh),
  ratios AS (SELECT a, b, CASE WHEN length(a) + length(b) = 0 THEN 1.0 ELSE 2.0 * coalesce(m, 0) / (length(a) + length(b)) END AS ratio FROM p LEFT JOIN (
      SELECT p, sum(n) AS m FROM (SELECT p, max(least(n, ah - i, bh - j) - greatest(0, al - i, bl - j)) AS n FROM span JOIN runs USING (p) WHERE least(n, ah - i, bh - j) > greatest(0, al - i, bl - j) GROUP BY p, al, ah, bl, bh) GROUP BY p
  ) USING (p)),
  alike AS (SELECT a, b FROM ratios WHERE ratio >= 0.86)"""
_BOUND = "2 * least(length(a), length(b)) >= 0.86 * (length(a) + length(b))"
_SEEN_BASES = f"sb AS (SELECT seen_ord, record_id, {_FP.format('title')} AS b FROM seen), sl AS (SELECT * FROM sb WHERE length(b) >= 10)"


def _routed(third: bool = False) -> str:
    """Clusters as they are routed; with the third tier, by titles, if asked for."""
    by_title = f""", {_SEEN_BASES}, rest AS (SELECT cl.candidate_id, {_FP.format('cl.title')} AS a FROM cl WHERE regexp_matches(title, '(?i)of|que') AND candidate_id NOT IN (SELECT candidate_id FROM m1) AND candidate_id NOT IN (SELECT candidate_id FROM m2)),
  pr AS (SELECT DISTINCT a, b FROM rest, sl WHERE length(a) >= 10 AND {_BOUND}), {_ALIKE}, m3 AS (SELECT DISTINCT candidate_id FROM rest JOIN alike USING (a))""" if third else ", m3 AS (SELECT NULL AS candidate_id WHERE false)"
    return f"""{_CLUSTER}, {_SEEN},
  m1 AS (SELECT cl.candidate_id FROM cl JOIN seen ON {_NORM_OF.format('cl.url')} = {_NORM_OF.format('seen.source_url')} GROUP BY 1),
  m2 AS (SELECT DISTINCT cl.candidate_id FROM cl JOIN seen ON contains(lower(cl.title || ' ' || cl.title), lower(code)) WHERE code <> '' AND code <> 'null' AND regexp_matches(cl.title, '(?i)of|que')){by_title},
  r0 AS (SELECT cl.*, CASE WHEN m1.candidate_id IS NOT NULL THEN 'source_url' WHEN m2.candidate_id IS NOT NULL THEN 'project_code' WHEN m3.candidate_id IS NOT NULL THEN 'title_similarity' END AS reason,
         CASE WHEN regexp_matches(title, '(?i)license') THEN 'license' WHEN regexp_matches(title, '%%%|###') THEN 'marks' WHEN contains(title, '!!') THEN 'shout' END AS ex
         FROM cl LEFT JOIN m1 USING (candidate_id) LEFT JOIN m2 USING (candidate_id) LEFT JOIN m3 USING (candidate_id)),
  r AS (SELECT *, CASE WHEN reason IS NOT NULL AND regexp_matches(title, '(?i)of|que') THEN 'update' WHEN reason IS NOT NULL THEN 'already_seen' WHEN ex IS NOT NULL THEN 'screened_out'
        WHEN NOT regexp_matches(title, '(?i)the|le|der|el') THEN 'screened_out' ELSE 'create' END AS route FROM r0)"""


_ROUTED = _routed()
_SIGNALS = """[x FOR x IN [CASE WHEN contains({0}, '@') THEN 'mail' END, CASE WHEN regexp_matches({0}, '[0-9]{{3}}[- ][0-9]{{3,4}}') THEN 'phone' END,
  CASE WHEN regexp_matches({0}, '(?i)licensed under') THEN 'licence' END, CASE WHEN contains({0}, ' | ') THEN 'table' END] IF x IS NOT NULL]"""
_ORD = """o AS (SELECT CAST(o_orderkey AS VARCHAR) AS record_id, CASE WHEN o_orderstatus = 'O' THEN 'active' ELSE 'closed' END AS status, strftime(o_orderdate, '%Y-%m-%dT%H:%M') AS deadline,
  o_totalprice AS budget, o_orderpriority AS notice_type, CAST(o_custkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) AS dedup_key, o_orderkey AS k, o_orderdate FROM orders)"""
_BATCH = "b AS (SELECT page_id, printf('batch-%04d', CAST(floor((row_number() OVER (ORDER BY page_id) - 1) / 5) + 1 AS BIGINT)) AS batch_id FROM pages)"

SQL = {
    "url_normalize": f"SELECT page_id, {_NORM_OF.format('url')} AS url_norm FROM pages",
    "title_fingerprint": f"SELECT page_id, {_FP.format(_TITLE)} AS fingerprint, {_FP.format(f'''regexp_replace({_TITLE}, 'of|que', '', 'g')''')} AS base FROM pages",
    "candidate_id": "SELECT page_id, 'C' || upper(substr(sha256(url), 1, 12)) AS candidate_id FROM pages",
    "teaser": r"""WITH t AS (SELECT doc_id, regexp_replace(replace(coalesce(text, ''), chr(10), ' '), '^\s+|\s+$', '', 'g') AS x FROM documents)
        SELECT doc_id, CASE WHEN length(x) <= 240 THEN x ELSE substr(x, 1, 239) || '…' END AS teaser FROM t""",
    "hit_dedup": f"WITH {_DEDUP} SELECT * FROM dd",
    "query_attribution": f"""WITH {_DEDUP}, u AS (SELECT found_by_query[1] AS query_no, count(*) AS u FROM dd WHERE len(found_by_query) = 1 GROUP BY 1)
        SELECT query_no, count(*) AS raw, coalesce(max(u), 0) AS "unique", CAST(0 AS BIGINT) AS pushed, 1 - coalesce(max(u), 0) / count(*) AS redundancy FROM h LEFT JOIN u USING (query_no) GROUP BY query_no""",
    "run_totals": f"WITH {_DEDUP} SELECT (SELECT count(DISTINCT query_no) FROM h) AS query_ok, CAST(0 AS BIGINT) AS query_failed, (SELECT count(*) FROM h) AS raw, count(*) AS candidates, count(*) FILTER (len(found_by_query) = 1) AS single FROM dd",
    "title_cluster": f"WITH {_CLUSTER} SELECT candidate_id, title, found_by_query, cluster_members, CAST(len(cluster_members) - 1 AS INTEGER) AS n_alternates FROM cl",
    "cluster_members": f"WITH {_CAND}, k AS (SELECT *, CASE WHEN length(fp) < 8 THEN '#' || candidate_id ELSE fp END AS key FROM c) SELECT key AS cluster_key, row_number() OVER (PARTITION BY key ORDER BY ord) - 1 AS number, candidate_id FROM k",
    "cluster_first": f"WITH {_CLUSTER} SELECT candidate_id, cluster_members[:2] AS cluster_members, len(cluster_members) AS n_members FROM cl",
    "batch_assign_skewed": "SELECT o_orderkey, printf('batch-%04d', CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 7) + 1 AS BIGINT)) AS batch_id FROM orders",
    "page_contacts": r"""WITH l AS (SELECT page_id, string_split(regexp_replace(regexp_replace(html, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'),
            '(?is)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|main|nav|aside|body|form|dl|hr|pre|blockquote)\b[^>]*>', chr(1), 'g'), chr(1)) AS l FROM pages),
        e AS (SELECT page_id, unnest(l) AS x, generate_subscripts(l, 1) AS k FROM l),
        t AS (SELECT page_id, k, regexp_replace(regexp_replace(x, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g') AS x FROM e),
        f AS (SELECT page_id, k, regexp_extract(x, '&copy; ([a-z.]+)', 1) AS name, regexp_extract_all(x, '\b([a-z]{4})\b', 1) AS w FROM t),
        n AS (SELECT page_id, max(k) AS kn, arg_max(name, k) AS name FROM f WHERE name <> '' GROUP BY page_id),
        p AS (SELECT page_id, arg_min(w[1], k) FILTER (WHERE k >= kn) AS after, arg_max(w[-1], k) AS last FROM f LEFT JOIN n USING (page_id) WHERE len(w) > 0 GROUP BY page_id)
        SELECT page_id, coalesce(name, 'null') AS name, coalesce(after, last, 'null') AS phone FROM pages LEFT JOIN n USING (page_id) LEFT JOIN p USING (page_id)""",
    "seen_url_match": f"""WITH {_CAND}, {_SEEN}, m AS (SELECT c.candidate_id, list(DISTINCT record_id) AS ids FROM c JOIN seen ON {_NORM_OF.format('c.url')} = {_NORM_OF.format('seen.source_url')} GROUP BY 1)
        SELECT c.candidate_id, coalesce(list_sort(ids), []) AS matched_seen_record_ids, CASE WHEN ids IS NOT NULL THEN 'source_url' END AS seen_match_reason FROM c LEFT JOIN m USING (candidate_id)""",
    "seen_code_match": f"WITH {_CAND}, {_SEEN} SELECT DISTINCT candidate_id, seen_ord, record_id FROM c JOIN seen ON contains(lower(c.title || ' ' || c.title), lower(code)) WHERE code <> '' AND code <> 'null'",
    "seen_fuzzy_match": f"""WITH RECURSIVE {_CAND}, {_SEEN}, {_SEEN_BASES}, cb AS (SELECT candidate_id, fp AS a FROM c WHERE length(fp) >= 10), pr AS (SELECT DISTINCT a, b FROM cb, sl WHERE {_BOUND}), {_ALIKE}
        SELECT candidate_id, seen_ord, record_id FROM cb JOIN alike USING (a) JOIN sl USING (b)""",
    "title_ratio": f"""WITH RECURSIVE {_CAND}, n AS (SELECT x.candidate_id, x.fp AS a, y.fp AS b FROM c x JOIN c y ON y.ord = x.ord + 1), pr AS (SELECT DISTINCT a, b FROM n), {_ALIKE}
        SELECT candidate_id, CAST(ratio AS DOUBLE) AS ratio FROM n JOIN ratios USING (a, b)""",
    "route_outputs": f"""WITH {_ROUTED} SELECT candidate_id, 'queue' AS output FROM r WHERE route IN ('create', 'update') UNION ALL SELECT candidate_id, 'possible_updates' FROM r WHERE route = 'update'
        UNION ALL SELECT candidate_id, route FROM r WHERE route IN ('already_seen', 'screened_out')""",
    "batch_files": f"WITH {_BATCH} SELECT batch_id, count(*) AS n, list(page_id ORDER BY page_id) AS pages, true AS has_policy FROM b GROUP BY batch_id",
    "result_candidates": "SELECT CAST(l.doc_id AS VARCHAR) AS candidate_id, CASE WHEN d.doc_id IS NULL THEN 'not in batch' END AS error, d.source AS title FROM labels l LEFT JOIN documents d USING (doc_id)",
    "unknown_queries": "SELECT CAST(x AS INTEGER) AS query_no FROM (SELECT unnest(range(100, 1001)) AS x UNION ALL SELECT unnest(range(149990, 150011))) WHERE x NOT IN (SELECT p_partkey FROM part)",
    "route_all_tiers": f"WITH RECURSIVE {_routed(True)} SELECT candidate_id, reason AS seen_match_reason, route FROM r",
    "route_cases": f"""WITH {_ROUTED} SELECT candidate_id, reason AS seen_match_reason, route, CASE WHEN route = 'already_seen' THEN 'seen' WHEN route = 'screened_out' AND ex IS NOT NULL THEN 'excluded: ' || ex
        WHEN route = 'screened_out' THEN 'no intent' END AS skip_reason, CASE WHEN route IN ('update', 'create') THEN route END AS flow_hint FROM r""",
    "route_funnel": f"""WITH {_ROUTED} SELECT (SELECT count(*) FROM pages) AS indexed, count(*) AS clusters, count(*) FILTER (route IN ('create', 'update')) AS queued, count(*) FILTER (route = 'update') AS possible_updates,
        count(*) FILTER (route = 'already_seen') AS already_seen, count(*) FILTER (route = 'screened_out') AS screened_out FROM r""",
    "clear_exclude": "SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)license') THEN 'license' WHEN regexp_matches(text, '%%%|###') THEN 'marks' WHEN contains(text, '!!') THEN 'shout' END AS excluded FROM documents",
    "intent_filter": "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)trash|pathetic|licensed')",
    "category_signals": f"SELECT doc_id, {_SIGNALS.format('text')} AS signals FROM documents",
    "search_evidence": f"WITH {_ROUTED} SELECT candidate_id, {_SIGNALS.format('html')} AS signals, 'content/' || candidate_id || '.json' AS content_path FROM r WHERE route = 'create'",
    "overdue_sweep": f"WITH {_ORD} SELECT record_id, 'closed' AS status, 'status_change' AS change_type, deadline, budget FROM o WHERE status = 'active' AND date_trunc('minute', o_orderdate) < TIMESTAMP '1998-01-01'",
    "seen_upsert": f"""WITH {_ORD} SELECT record_id, CASE WHEN k % 6 = 0 THEN 'canceled' ELSE status END AS status, dedup_key, CASE WHEN k % 2 = 0 THEN '1998-01-01' ELSE '1998-02-02' END AS first_seen,
        CASE WHEN k % 6 = 0 OR k % 2 = 1 THEN '1998-02-02' ELSE '1998-01-01' END AS last_seen, true AS pushed,
        CASE WHEN k % 6 = 0 THEN [CAST(k % 5 AS INTEGER), 9] ELSE [CAST(k % 5 AS INTEGER)] END AS found_by_query FROM o WHERE k % 2 = 0 OR k % 4 = 1""",
    "update_backfill": f"WITH {_ORD} SELECT record_id, 'status_change' AS change_type, 'closed' AS status, CASE WHEN k % 20 = 0 THEN '2000-01-01' ELSE 'null' END AS publish_date, notice_type, deadline, budget FROM o WHERE k % 10 = 0",
    "region_lookup": "SELECT c_custkey, coalesce(r_name, 'none') AS region FROM customer LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 5 <> 4) ON c_nationkey = n_nationkey",
    "attachment_extract": """WITH l AS (SELECT page_id, url AS page, unnest(regexp_extract_all(html, '(?i)href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '(?i)href="([^"]*)"', 1), 1) - 1 AS ord FROM pages),
        a AS (SELECT page_id, CAST(ord AS INTEGER) AS ord, CASE WHEN regexp_matches(href, '^(?i)[a-z][a-z0-9+.-]*:') THEN href WHEN starts_with(href, '/') THEN regexp_extract(page, '^(https?://[^/?#]*)', 1) || href
            ELSE regexp_replace(regexp_replace(page, '[?#].*$', ''), '([^/:])/[^/]*$', '\\1') || '/' || href END AS url FROM l)
        SELECT page_id, ord, url, row_number() OVER (PARTITION BY page_id ORDER BY CASE WHEN contains(url, '.html') THEN 0 WHEN contains(url, '/the') THEN 1 ELSE 2 END, ord) = 1 AS main FROM a""",
    "batch_assign": f"WITH {_BATCH} SELECT printf('P%06d', page_id) AS candidate_id, batch_id FROM b",
    "batch_status": f"WITH {_BATCH} SELECT batch_id, count(*) AS count, CASE WHEN min(page_id) < 60 THEN 'completed' ELSE 'pending' END AS status FROM b GROUP BY batch_id",
    "next_batch": f"WITH {_BATCH} SELECT min(batch_id) FILTER (s) AS batch_id FROM (SELECT batch_id, min(page_id) >= 60 AS s FROM b GROUP BY 1)",
    "decision_counts": 'SELECT count(*) FILTER (o_orderstatus = \'F\') AS "F", count(*) FILTER (o_orderstatus = \'O\') AS "O", count(*) FILTER (o_orderstatus = \'P\') AS "P", CAST(0 AS BIGINT) AS "X" FROM orders',
    "result_summary": """SELECT p.part, count(*) FILTER (CASE p.part WHEN 'active' THEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 WHEN 'intel' THEN o_orderstatus = 'O' AND o_orderkey % 3 = 1
        WHEN 'pushed_manual' THEN o_orderstatus = 'O' AND o_orderkey % 3 = 2 WHEN 'local_manual' THEN false WHEN 'excluded' THEN o_orderstatus NOT IN ('O', 'F') ELSE o_orderstatus = 'F' END) AS n
        FROM orders, (SELECT unnest(['active', 'intel', 'pushed_manual', 'local_manual', 'excluded', 'update']) AS part) p GROUP BY p.part""",
    "authority_histogram": "SELECT coalesce(CAST(quality AS VARCHAR), '未知') AS key, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1",
    "retirement_window": """WITH e AS (SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events), g AS (SELECT user_id, CAST(d AS DATE) AS day FROM (SELECT DISTINCT user_id FROM e), (SELECT unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS d FROM e)),
        f AS (SELECT g.user_id AS query_no, strftime(g.day, '%Y-%m-%d') AS day, count(*) FILTER (event_type = 'purchase') AS u, count(*) FILTER (event_type = 'signup') AS p FROM g LEFT JOIN e ON g.user_id = e.user_id AND g.day = e.day GROUP BY 1, 2),
        w AS (SELECT query_no, day, max(u) OVER x AS u, max(p) OVER x AS p, count(*) OVER x AS n FROM f WINDOW x AS (PARTITION BY query_no ORDER BY day ROWS 6 PRECEDING))
        SELECT query_no, day, CASE WHEN u = 0 THEN 'retire' ELSE 'review' END AS verdict FROM w WHERE n = 7 AND (u = 0 OR p = 0)""",
    "ledger_idempotent": """WITH e AS (SELECT event_type AS flow, user_id || '-' || (event_id % 3) AS candidate_id, sha256(CAST(user_id AS VARCHAR)) AS sha, event_id FROM events),
        l AS (SELECT flow, candidate_id, min(CASE WHEN event_id % 8 = 0 THEN 'other' ELSE sha END) AS old FROM e WHERE event_id % 4 = 0 GROUP BY 1, 2), k AS (SELECT flow, candidate_id, arg_min(sha, event_id) AS sha FROM e GROUP BY 1, 2)
        SELECT flow, CASE WHEN old IS NULL THEN 'append' WHEN old = sha THEN 'idempotent' ELSE 'conflict' END AS action, count(*) AS n FROM k LEFT JOIN l USING (flow, candidate_id) GROUP BY 1, 2""",
    "stats_recompute": f"""WITH {_DEDUP}, n AS (SELECT q AS query_no, count(*) AS n FROM (SELECT unnest(found_by_query) AS q FROM dd) GROUP BY 1)
        SELECT 'today' AS day, query_no, coalesce(n, 0) AS pushed FROM (SELECT DISTINCT query_no FROM h) LEFT JOIN n USING (query_no) UNION ALL SELECT 'before', query_no, 5 FROM (SELECT DISTINCT query_no FROM h)""",
    "push_counts": "SELECT count(*) AS expected, count(*) FILTER (o_orderkey % 3 = 0) AS confirmed, count(*) FILTER (o_orderkey % 3 = 0 AND o_orderstatus = 'O') AS \"create\", count(*) FILTER (o_orderkey % 3 = 0 AND o_orderstatus <> 'O') AS \"update\" FROM orders",
    "index_validate": """SELECT 'url' AS error, count(*) AS n FROM conversations WHERE turn <> 0 HAVING count(*) > 0
        UNION ALL SELECT 'repeated id', count(*) FROM (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0
        UNION ALL SELECT 'repeated url', count(*) FROM (SELECT conv_id, turn FROM conversations GROUP BY 1, 2 HAVING count(*) > 1) HAVING count(*) > 0""",
    "record_validate": """SELECT event_id, concat_ws('; ', 'missing: z', CASE WHEN json_type(props, '$.k') <> 'VARCHAR' THEN 'k: not a string' END) AS errors, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events""",
    "batch_result_parity": "SELECT CAST(coalesce(d.doc_id, l.doc_id) AS VARCHAR) AS candidate_id, CASE WHEN l.doc_id IS NULL THEN 'no result' ELSE 'not in batch' END AS error FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL",
    "dup_or_join": """WITH r AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, o_custkey || '|' || strftime(o_orderdate, '%Y%m%d') AS key, o_orderkey % 5000 AS u FROM orders), s AS (SELECT * FROM r WHERE k % 7 = 0)
        SELECT r.id AS candidate_id, s.id AS seen_id FROM r JOIN s ON r.id = s.id UNION SELECT r.id, s.id FROM r JOIN s ON r.key = s.key UNION SELECT r.id, s.id FROM r JOIN s ON r.u = s.u""",
    "state_machine": """WITH b AS (SELECT conv_id, count(*) FILTER (turn > 3) AS p, count(*) FILTER (role = 'user') AS e, count(*) FILTER (role = 'assistant') AS c FROM conversations GROUP BY 1),
        s AS (SELECT *, CASE WHEN p > 0 THEN 'VERIFYING' WHEN e > 0 AND c >= e THEN 'PUSHED' ELSE 'VALIDATED' END AS state FROM b)
        SELECT conv_id, state, CASE WHEN state = 'VERIFYING' THEN 'SUBMIT_BATCHES' WHEN state = 'VALIDATED' AND c > 0 THEN 'PUSH_REMAINING' WHEN state = 'VALIDATED' THEN 'REVIEW_PAYLOADS' ELSE 'NONE' END AS next_action FROM s""",
    "receipt_check": "SELECT CAST(page_id AS VARCHAR) AS candidate_id, concat_ws('; ', CASE WHEN page_id % 5 = 0 THEN 'hash differs' END, CASE WHEN page_id % 7 = 0 THEN 'not confirmed' END) AS errors FROM pages",
    "payload_export": "SELECT 'update' AS flow, CAST(page_id AS VARCHAR) AS candidate_id, 'payloads/update/' || page_id || '.json' AS path, true AS bound, url AS source_url, 'null' AS notes, CAST(0 AS DOUBLE) AS budget, CAST(14 AS INTEGER) AS n_fields FROM pages",
    "query_gaps": """WITH q AS (SELECT CAST(o_orderkey AS INTEGER) AS query_no FROM orders WHERE o_orderkey % 13 <> 5) SELECT query_no, 'ending' AS error FROM q WHERE query_no % 11 = 0
        UNION ALL SELECT CAST(g AS INTEGER), 'missing number' FROM (SELECT unnest(range(1, max(query_no) + 1)) AS g FROM q) WHERE g NOT IN (SELECT query_no FROM q)""",
    "preview_top": f"WITH {_CAND} SELECT candidate_id, title FROM c ORDER BY ord LIMIT 20",
    "word_tags": """SELECT doc_id, [x FOR x IN [CASE WHEN contains(text, 'Apache') THEN 'Apache' END] IF x IS NOT NULL] AS own, [x FOR x IN [CASE WHEN contains(text, 'MIT') THEN 'MIT' END, CASE WHEN contains(text, 'CC BY') THEN 'CC BY' END] IF x IS NOT NULL] AS others,
        [x FOR x IN [CASE WHEN contains(text, 'token') THEN 'token' END] IF x IS NOT NULL] AS methods, regexp_matches(text, '(?i)licensed') AS doubtful FROM documents""",
}
