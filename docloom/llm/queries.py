"""The queries that apply each operator, with production parameters, to its whole table; and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from docloom.llm import ann, bpe, embedding_dedup, exact_dedup, language_id, lexical, minhash, packing, runs, sharding, suffix_dedup, token_counts, url_filter
from docloom.llm.common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_with_own_edits(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.merge_runs(table(spark, sf_dir, "documents"), keep="largest")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op6_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op7_cutting_stock_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), length=4096, end_id=2)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), every=50, k=5)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=200).drop("kept")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.collapse_runs(runs.repeated_tails(table(spark, sf_dir, "documents"))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))


def _terms(weights: dict[str, int]) -> str:
    return " + ".join(f"{w} * CAST(regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INTEGER)" for t, w in weights.items())


def oracle_sql() -> dict[str, str]:
    rules = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_filter.RULES)
    return {
        "op4_exact_dedup": """
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
            SELECT doc_id, max(doc_id) OVER g AS keep_id, CAST(count(*) OVER g AS BIGINT) AS group_size,
                   doc_id = max(doc_id) OVER g AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept, sha256(t) AS text_sha256
            FROM d WINDOW g AS (PARTITION BY t)""",
        "op5_url_filter": f"""
            WITH p AS (SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
                              CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
            q AS (SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
            r(h, pre, v) AS (VALUES {rules}),
            f AS (SELECT page_id, arg_max(h || pre, length(h || pre)) AS rule, arg_max(v, length(h || pre)) AS by_rule
                  FROM q JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, pre) GROUP BY page_id),
            c AS (SELECT page_id, host, path, {_terms(dict.fromkeys(url_filter.STRICT, 1))} AS strict_hits, {_terms(dict.fromkeys(url_filter.SOFT, 1))} AS soft_hits, {_terms(url_filter.SOFT)} AS soft_weight FROM q)
            SELECT c.page_id, host, path, rule, coalesce(by_rule, CASE WHEN strict_hits > 0 OR soft_weight >= 3 THEN 'block' ELSE 'allow' END) AS verdict, strict_hits, soft_hits, soft_weight
            FROM c LEFT JOIN f ON c.page_id = f.page_id""",
        "op12_embedding_near_dedup": """
            WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
            l AS MATERIALIZED (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93),
            r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
            SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, c.m AS component_id, e.vec_id = c.m AS kept
            FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) k ON e.vec_id = k.a JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) c ON e.vec_id = c.a""",
        "op11_ranked_search": r"""
            WITH t AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
            b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
            s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS n_terms FROM t WHERE len(ts) > 0),
            p AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(ts) AS term FROM t) WHERE term IN (SELECT term FROM b) GROUP BY r, term),
            w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM p GROUP BY term), s),
            x AS (SELECT p.r, p.term, w.w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(t.ts) * n_docs) // n_terms))) AS part FROM p JOIN w USING (term) JOIN t ON t.r = p.r, s),
            f AS (SELECT item_id, doc_id, CAST(score AS BIGINT) AS score FROM (SELECT b.item_id, x.r, sum(x.part) AS score FROM b JOIN x USING (term) GROUP BY b.item_id, x.r) g JOIN t ON t.r = g.r WHERE score > 0)
            SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score FROM f QUALIFY rank <= 50""",
    }
