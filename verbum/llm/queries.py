"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from verbum.llm.blocks import exact_duplicates
from verbum.llm.bpe import token_report
from verbum.llm.common import table
from verbum.llm.fingerprint import fingerprints
from verbum.llm.lines import line_report
from verbum.llm.manifest import manifest_report
from verbum.llm.mixing import mix
from verbum.llm.packing import pack
from verbum.llm.periods import periodic_runs, run_report, with_planted_runs
from verbum.llm.pii import find_personal_data
from verbum.llm.quality import quality_scores
from verbum.llm.simhash import near_duplicates
from verbum.llm.suffix import repeated_passages
from verbum.llm.urls import judge_urls


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("h")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op7_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(periodic_runs(with_planted_runs(table(spark, sf_dir, "documents"))))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_report(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_pii": op2_pii,
    "op3_line_dedup": op3_line_dedup,
    "op4_quality": op4_quality,
    "op5_fingerprint": op5_fingerprint,
    "op6_packing": op6_packing,
    "op7_simhash_neardup": op7_simhash_neardup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_url_filter": op9_url_filter,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE_SQL: dict[str, str] = {
    "op3_line_dedup": """
        WITH line AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (
            SELECT doc_id, line, pos,
                   translate(trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM line),
        held AS (
            SELECT key, min(doc_id) AS first_id FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        judged AS (
            SELECT k.*, h.first_id IS NULL OR h.first_id = k.doc_id AS stays
            FROM keyed k LEFT JOIN held h ON h.key = k.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (stays), '')) AS kept_sha256
        FROM judged GROUP BY doc_id
    """,
    "op9_url_filter": """
        WITH cut AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        part AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut),
        split AS (
            SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
            FROM part),
        rules(rule_host, rule_path, verdict) AS (
            VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
        judged AS (
            SELECT s.page_id, s.host, s.path, r.rule_host || r.rule_path AS rule, r.verdict,
                   row_number() OVER (PARTITION BY s.page_id ORDER BY length(r.rule_host || r.rule_path) DESC NULLS LAST) AS n
            FROM split s LEFT JOIN rules r
              ON (s.host = r.rule_host OR ends_with(s.host, '.' || r.rule_host)) AND starts_with(s.path, r.rule_path))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM judged WHERE n = 1
    """,
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
    "op13_merkle_manifest": """
        WITH RECURSIVE crc AS (
            SELECT doc_id, list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                       lambda s, c: list_reduce([xor(s, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))) AS inverse
            FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
        field AS (
            SELECT d.*, coalesce(xor(c.inverse, 4294967295) % 7 = 0, false) AS tampered,
                   coalesce(strlen(CAST(d.doc_id AS VARCHAR)) || ':' || d.doc_id, '-') AS f1, coalesce(strlen(source) || ':' || source, '-') AS f2,
                   coalesce(strlen(lang) || ':' || lang, '-') AS f3, coalesce(strlen(text) || ':' || text, '-') AS f5,
                   coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS f4,
                   coalesce(strlen(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS f4_more
            FROM documents d LEFT JOIN crc c USING (doc_id)),
        hashed AS (
            SELECT doc_id, lang, sha256(f1 || f2 || f3 || f4 || f5) AS leaf, CASE WHEN tampered THEN sha256(f1 || f2 || f3 || f4_more || f5) END AS claim FROM field),
        leaves AS MATERIALIZED (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM hashed),
        node AS (
            SELECT lang, 0 AS level, i, n, leaf AS digest FROM leaves
            UNION ALL
            SELECT lang, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM node WHERE n > 1 GROUP BY lang, level, i // 2, n),
        tree AS MATERIALIZED (SELECT * FROM node),
        subroot AS MATERIALIZED (
            SELECT lang, level AS height, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
        upper_node AS (
            SELECT 0 AS level, i, n, subroot AS digest FROM subroot
            UNION ALL
            SELECT level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i)) FROM upper_node WHERE n > 1 GROUP BY level, i // 2, n),
        forest AS MATERIALIZED (SELECT * FROM upper_node),
        root AS (SELECT level AS height, digest AS root FROM forest WHERE n = 1),
        step AS (
            SELECT l.doc_id, l.lang, l.i AS leaf_i, t.level, t.i % 2 AS odd, s.digest AS other
            FROM leaves l JOIN tree t ON t.lang IS NOT DISTINCT FROM l.lang AND t.i = l.i >> t.level AND t.n > 1
            LEFT JOIN tree s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = t.level AND s.i = xor(t.i, 1)
            UNION ALL
            SELECT l.doc_id, l.lang, l.i, r.height + f.level, f.i % 2, s.digest
            FROM leaves l JOIN subroot r ON r.lang IS NOT DISTINCT FROM l.lang
            JOIN forest f ON f.i = r.i >> f.level AND f.n > 1
            LEFT JOIN forest s ON s.level = f.level AND s.i = xor(f.i, 1)),
        proof AS MATERIALIZED (
            SELECT lang, leaf_i, list({'odd': odd, 'other': other} ORDER BY level) AS steps, sha256(coalesce(string_agg(other, '' ORDER BY level), '')) AS proof_sha256
            FROM step GROUP BY lang, leaf_i),
        folded AS (
            SELECT l.lang, l.i, 1 AS k, coalesce(l.claim, l.leaf) AS digest, p.steps FROM leaves l LEFT JOIN proof p ON p.lang IS NOT DISTINCT FROM l.lang AND p.leaf_i = l.i
            UNION ALL
            SELECT lang, i, k + 1, sha256(CASE WHEN steps[k].other IS NULL THEN digest WHEN steps[k].odd = 1 THEN steps[k].other || digest ELSE digest || steps[k].other END), steps
            FROM folded WHERE k <= coalesce(len(steps), 0))
        SELECT l.doc_id, l.leaf, r.subroot, t.root, coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.digest AS folded_root, f.digest = t.root AS verified
        FROM leaves l JOIN folded f ON f.lang IS NOT DISTINCT FROM l.lang AND f.i = l.i AND f.k = coalesce(len(f.steps), 0) + 1
        JOIN subroot r ON r.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proof p ON p.lang IS NOT DISTINCT FROM l.lang AND p.leaf_i = l.i CROSS JOIN root t
    """,
}
