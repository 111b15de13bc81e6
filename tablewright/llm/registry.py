"""The queries of this subpackage and the SQL that some of them can be checked with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm import decontaminate, line_dedup, lm_scoring, near_dedup, packing, prefix_trie, quality, secrets, substring_dedup, token_counts, token_files, web_archive, whitening
from tablewright.llm.common import new_path
from tablewright.runtime import ship_package


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encode_and_read_back(documents(spark, sf_dir))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("distance", 3).alias("distance"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir))


def op2_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op7_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(secrets.find_secrets(documents(spark, sf_dir)))


def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(documents(spark, sf_dir), benchmark)


def op10_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(documents(spark, sf_dir))


def op1_masked_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(documents(spark, sf_dir))


def op11_web_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "web-archive")
    web_archive.write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return web_archive.page_summary(spark, path)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {f.__name__: f for f in (op1_masked_lm_scoring, op2_setsketch_dedup, op3_template_decontamination, op4_line_dedup, op5_token_orc, op6_token_counts, op7_trigram_secrets, op8_quality_rules, op9_best_fit_packing, op10_chained_passages, op11_web_archive, op12_whitening, op13_prefix_trie)}

SQL = {
    "op13_prefix_trie": """
        WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
        convs AS (
            SELECT conv_id, conv_id - conv_id % 100 AS base, xor(list_reduce(
                list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b: list_reduce(
                    [0, 1, 2, 3, 4, 5, 6, 7], lambda y, k: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END, xor(c, b)),
                4294967295), 4294967295) % 6 AS h FROM ids),
        turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
                         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations),
        joined AS (SELECT c.conv_id, 0 AS side, t.pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos <= c.h
                   UNION ALL SELECT c.conv_id, 1, t.pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.h),
        keyed AS (SELECT conv_id, row_number() OVER w AS depth, text, list(sha256(length(role) || ':' || role || text)) OVER w AS path
                  FROM joined WINDOW w AS (PARTITION BY conv_id ORDER BY side, pos ROWS UNBOUNDED PRECEDING)),
        paths AS (SELECT conv_id, depth, text, sha256(array_to_string(path, ',')) AS k FROM keyed
                  UNION ALL SELECT conv_id, 0, '', 'root' FROM convs),
        lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
        nodes AS (SELECT depth, k, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * length(any_value(text)) AS w FROM paths GROUP BY depth, k),
        linked AS (SELECT n.*, p.k AS up FROM nodes n LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1),
        kids AS (SELECT up AS k, count(*) AS n_children FROM linked WHERE up IS NOT NULL GROUP BY up),
        totals AS (SELECT p.k, sum(n.w) AS saved_tokens, count(*) FILTER (kids.k IS NULL) AS n_leaves
                   FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN kids ON kids.k = n.k GROUP BY p.k),
        ends AS (SELECT p.k, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids FROM paths p JOIN lengths l ON l.conv_id = p.conv_id AND l.depth = p.depth GROUP BY p.k)
        SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children,
               t.n_leaves, t.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
        FROM linked n JOIN totals t ON t.k = n.k LEFT JOIN nodes u ON u.k = n.up LEFT JOIN kids ON kids.k = n.k LEFT JOIN ends e ON e.k = n.k""",
    "op11_web_archive": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
        d AS (SELECT page_id, strlen(h) AS payload_bytes, h, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p)
        SELECT page_id, payload_bytes,
               translate(to_base(('0x' || x[1:10])::BIGINT, 32, 8) || to_base(('0x' || x[11:20])::BIGINT, 32, 8)
                         || to_base(('0x' || x[21:30])::BIGINT, 32, 8) || to_base(('0x' || x[31:40])::BIGINT, 32, 8),
                         '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM d""",
    "op4_line_dedup": """
        WITH docs AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i
                      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
        keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM docs),
        hot AS (SELECT k, max(doc_id) AS owner FROM keyed WHERE length(k) >= 20
                GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
        marked AS (SELECT keyed.*, coalesce(doc_id <> owner, false) AS lost FROM keyed LEFT JOIN hot USING (k))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op2_setsketch_dedup": """
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
        shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                   WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                   ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM words),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
                   FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
                  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
        FROM documents d LEFT JOIN sizes s USING (doc_id)
        JOIN (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) r USING (doc_id)""",
}
