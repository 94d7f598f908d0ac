"""One query for each operator, with the parameters of production, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, flac, mixing, packing, passages, secrets, sharding, simhash, survivorship, tokenfiles, tokens, topk, toxicity


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, bits=2)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer(), limit=512)


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5, scale=256)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3).select("doc_id", "size", "source_size", "target", "taken")


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(_table(spark, sf_dir, "documents"), words=51, shingle=5, similarity=0.8)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer(), size=1024, end=2)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")), threshold=0.7)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), shards=8)


def op10_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flac.round_trip(_table(spark, sf_dir, "documents"))


def op11_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivorship.golden(_table(spark, sf_dir, "clients"), days=30)


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenfiles.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=1)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_token_counts": op2_token_counts,
    "op3_top_k": op3_top_k,
    "op4_mixing": op4_mixing,
    "op5_passages": op5_passages,
    "op6_packing": op6_packing,
    "op7_toxicity": op7_toxicity,
    "op8_secrets": op8_secrets,
    "op9_sharding": op9_sharding,
    "op10_flac": op10_flac,
    "op11_golden": op11_golden,
    "op12_token_files": op12_token_files,
    "op13_filter_audit": op13_filter_audit,
}

ORACLE: dict[str, str] = {
    "op3_top_k": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([x[1] * x[2] FOR x IN list_zip(q.e, c.e)]) AS BIGINT) AS score
            FROM v q, v c WHERE q.vec_id % 50 = 0 AND c.vec_id IS DISTINCT FROM q.vec_id AND len(c.e) = len(q.e)
        ), r AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank, vec_id, score FROM s
        ) SELECT * FROM r WHERE rank <= 5""",
    "op4_mixing": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
        ), s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CAST(1 + (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 AS DOUBLE) AS w FROM d GROUP BY source
        ), fill AS (
            SELECT 0 AS step, [CAST(-1 AS BIGINT)] AS stopped, (SELECT sum(source_size) FROM s) / (SELECT sum(w) FROM s) AS level
            UNION ALL
            SELECT step + 1, [step], (SELECT sum(source_size) - coalesce(sum(3 * source_size) FILTER (3 * source_size / w <= level), 0) FROM s)
                   / (SELECT sum(w) FILTER (3 * source_size / w > level) FROM s)
            FROM fill WHERE step < (SELECT count(*) FROM s) AND (SELECT count(*) FROM s WHERE 3 * source_size / w > level) > 0
        ), t AS (
            SELECT s.*, least(3.0 * source_size, w * (SELECT arg_max(level, step) FROM fill)) AS target FROM s
        ), r AS (
            SELECT *, floor(target / source_size) AS sure, target / source_size - floor(target / source_size) AS p,
                   target - floor(target / source_size) * source_size AS rest FROM t
        ), z AS (
            SELECT d.doc_id, d.size, r.*, (CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
            FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
        ), o AS (
            SELECT *, sum(size) OVER (PARTITION BY source ORDER BY ln(u) - ln(1 - u) - 0.5 * ln(greatest(size, 1)), doc_id, size ROWS UNBOUNDED PRECEDING) - size / 2 AS mid FROM z
        ) SELECT doc_id, size, source_size, target, CAST(size * (sure + CASE WHEN p > 0 AND mid <= rest THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM o""",
    "op11_golden": r"""
        WITH c AS (
            SELECT coalesce(master_id, client_id) AS k, client_id AS id, coalesce(5 - nullif(list_position(['partner', 'store', 'web', 'crm'], source), 0), 0) AS trust, updated_at AS t,
                   CASE WHEN regexp_matches(name, '[^\x20\x09-\x0D]') THEN name END AS name, CASE WHEN regexp_matches(email, '[^\x20\x09-\x0D]') THEN email END AS email,
                   CASE WHEN regexp_matches(city, '[^\x20\x09-\x0D]') THEN city END AS city, nation_id AS nation, CASE WHEN regexp_matches(segment, '[^\x20\x09-\x0D]') THEN segment END AS segment,
                   CASE WHEN isfinite(balance) THEN balance END AS balance FROM clients
        ), l AS (
            SELECT c.k, c.id, c.name, c.email, c.city, c.nation, c.segment, c.balance, t IS NULL OR t < m.latest - INTERVAL 720 HOURS AS stale,
                   row_number() OVER (PARTITION BY c.k ORDER BY t DESC NULLS LAST, trust DESC, id NULLS LAST) AS recent, trust
            FROM c JOIN (SELECT k, max(t) AS latest FROM c GROUP BY k) m ON c.k IS NOT DISTINCT FROM m.k
        ), r AS (
            SELECT *, row_number() OVER (PARTITION BY k ORDER BY stale, trust DESC, recent) AS trusted, first_value(segment) OVER (PARTITION BY k ORDER BY segment IS NULL, recent) AS main FROM l
        ), g AS (
            SELECT k, count(*) AS n, count(*) FILTER (stale) AS n_stale,
                   arg_min({'v': name, 'id': id}, {'a': -length(name), 'b': trusted}) FILTER (name IS NOT NULL) AS name, arg_min({'v': email, 'id': id}, trusted) FILTER (email IS NOT NULL) AS email,
                   arg_min({'v': segment, 'id': id}, recent) FILTER (segment IS NOT NULL) AS segment,
                   arg_min({'v': balance, 'id': id}, {'a': segment IS NULL OR main IS NULL OR segment <> main, 'b': recent}) FILTER (balance IS NOT NULL) AS balance,
                   arg_min({'city': city, 'nation': nation, 'id': id}, {'a': (city IS NULL)::INT + (nation IS NULL)::INT, 'b': trusted}) AS address FROM r GROUP BY k
        ) SELECT k AS cluster_id, n AS n_records, n_stale, name.v AS name, email.v AS email, segment.v AS segment, address.city AS city, address.nation AS nation_id,
            CAST(floor(100 * balance.v + 0.5) AS BIGINT) AS balance_cents, name.id AS name_from, email.id AS email_from, segment.id AS segment_from, balance.id AS balance_from,
            CASE WHEN address.city IS NOT NULL OR address.nation IS NOT NULL THEN address.id END AS address_from FROM g""",
    "op13_filter_audit": r"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
        f AS (
            SELECT doc_id, part, {'A': len(w) < 50, 'B': 100 * len(list_distinct(w)) < 65 * len(w), 'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
                   'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(doc_id > least, false)} AS f FROM w
        ), l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        m AS (
            SELECT part, [x FOR x IN [CASE WHEN f.A THEN 'A' END, CASE WHEN f.B THEN 'B' END, CASE WHEN f.C THEN 'C' END, CASE WHEN f.D THEN 'D' END, CASE WHEN f.E THEN 'E' END] IF x IS NOT NULL] AS fails,
                   count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
        ), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS own, string_split(substr(filter_order, 1, step - 1), '') AS before FROM o, (SELECT unnest(range(1, 6)) AS step))
        SELECT part, filter_order, step, CAST(coalesce(sum(n) FILTER (NOT own IN fails AND NOT list_has_any(fails, before)), 0) AS BIGINT) AS kept,
            CAST(coalesce(sum(n) FILTER (own IN fails AND NOT list_has_any(fails, before)), 0) AS BIGINT) AS removed, CAST(coalesce(sum(n) FILTER (own IN fails AND list_has_any(fails, before)), 0) AS BIGINT) AS redundant,
            CAST(coalesce(sum(n) FILTER (fails = [own]), 0) AS BIGINT) AS unique_fails, CAST(coalesce(sum(good) FILTER (own IN fails AND NOT list_has_any(fails, before)), 0) AS BIGINT) AS good_lost,
            CAST(coalesce(sum(toxic) FILTER (own IN fails AND NOT list_has_any(fails, before)), 0) AS BIGINT) AS toxic_lost, CAST(coalesce(sum(n * 120 // greatest(len(fails), 1)) FILTER (own IN fails), 0) AS BIGINT) AS shapley
        FROM m, s GROUP BY part, filter_order, step""",
}
