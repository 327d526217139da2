"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faremill.llm.alignment import align_documents
from faremill.llm.common import table
from faremill.llm.dart_minhash import near_duplicates
from faremill.llm.exact_dedup import find_copies
from faremill.llm.kd_search import top_k
from faremill.llm.merkle import write_manifest
from faremill.llm.packing import pack_documents
from faremill.llm.pieces import encode_nbest
from faremill.llm.secret_scan import scan_secrets
from faremill.llm.token_counts import count_tokens
from faremill.llm.token_files import write_tokens
from faremill.llm.toxicity import score_documents, train_model
from faremill.llm.url_rules import RULES, judge_urls, rule_table
from faremill.llm.warc import read_warc, write_warc
from faremill.session import workspace

Runner = Callable[[SparkSession, str], DataFrame]


def op1_kd_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op2_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_nbest(table(spark, sf_dir, "documents"), keep_ids=False)


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), rule_table(spark, RULES))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = workspace(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), archives)
    return read_warc(spark, archives).select(
        F.col("key").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return write_tokens(documents, workspace(spark, "token-files")).positions()


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = train_model(documents, table(spark, sf_dir, "labels"))
    return score_documents(documents, model, lang="lang")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))


def op11_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    manifest = write_manifest(
        table(spark, sf_dir, "documents"),
        workspace(spark, "manifest"),
        altered={"text": lower},
        where=F.crc32(F.col("doc_id").cast("string")) % 3 == 0,
    )
    return manifest.proofs()


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents")).drop("findings")


QUERIES: dict[str, Runner] = {
    "op1_kd_top_k": op1_kd_top_k,
    "op2_piece_nbest": op2_piece_nbest,
    "op3_dart_minhash": op3_dart_minhash,
    "op4_url_rules": op4_url_rules,
    "op5_warc": op5_warc,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_token_files": op8_token_files,
    "op9_toxicity": op9_toxicity,
    "op10_token_counts": op10_token_counts,
    "op11_cross_alignment": op11_cross_alignment,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_secret_scan": op13_secret_scan,
}

# DuckDB statements, where SQL can express the operator
_OP1 = """
WITH v AS (
  SELECT row_number() OVER () AS n, vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
s AS (
  SELECT q.n, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.n <> q.n AND len(c.e) = len(q.e)
),
r AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id)::INT AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP4 = """
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3)
                       ELSE '' END AS u
  FROM pages
),
p AS (
  SELECT row_number() OVER () AS n, page_id,
         translate(regexp_extract(u, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
),
rules(h, p, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
         ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
m AS (
  SELECT n, h || rules.p AS rule, verdict,
         row_number() OVER (PARTITION BY n ORDER BY length(h || rules.p) DESC, length(h) DESC) AS k
  FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(p.path, rules.p)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON m.n = p.n AND k = 1
"""

_OP5 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS s FROM pages
),
d AS (
  SELECT page_id, octet_length(b) AS payload_bytes,
         max(page_id) OVER (PARTITION BY s) AS main,
         translate(list_aggregate(
           [to_base(('0x' || substr(s, 1 + 5 * i, 5))::BIGINT, 32, 4) FOR i IN range(8)],
           'string_agg', ''),
           '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')
           AS payload_digest
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id = main THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = main THEN NULL ELSE main END AS refers_to
FROM d
"""

_OP7 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = first_value(doc_id) OVER (PARTITION BY n ORDER BY length(t) DESC, doc_id) AS kept,
       sha256(n) AS text_sha256
FROM d
"""

# a row number stands for the row, a dense number (0: the tree over them) for the language;
# crc32 takes eight steps for each sign of the number
_OP12 = """
WITH RECURSIVE d AS (
  SELECT doc_id, lang, text, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
    || coalesce(octet_length(encode(source)) || ':' || source, '-')
    || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
    || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') AS head,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) AS k,
    xor(4294967295, list_reduce(
      [4294967295] || flatten([[ord(c), 0, 0, 0, 0, 0, 0, 0] FOR c IN split(doc_id::VARCHAR, '')]),
      lambda crc, x: xor((xor(crc, x) >> 1), (xor(crc, x) & 1) * 3988292384))) % 3 = 0 AS altered
  FROM documents
),
hashed AS (
  SELECT *, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
  FROM d
),
leaves AS (
  SELECT doc_id, k, leaf,
         CASE WHEN altered THEN sha256(head || coalesce(octet_length(encode(low)) || ':' || low, '-'))
              ELSE leaf END AS read_leaf,
         row_number() OVER (ORDER BY k, doc_id, leaf) AS rn,
         row_number() OVER (PARTITION BY k ORDER BY doc_id, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY k) AS n
  FROM hashed
),
lower_nodes(k, lvl, pos, n, h) AS (
  SELECT k, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT k, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM lower_nodes WHERE n > 1 GROUP BY k, lvl, pos // 8, n
),
subroots AS (SELECT k, lvl, h, count(*) OVER () AS n FROM lower_nodes WHERE n = 1),
upper_nodes(lvl, pos, n, h) AS (
  SELECT 0, k - 1, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos))
  FROM upper_nodes WHERE n > 1 GROUP BY lvl, pos // 8, n
),
root AS (SELECT h AS root FROM upper_nodes WHERE n = 1),
siblings AS (
  SELECT rn, lvl, s.pos, s.h FROM leaves l JOIN lower_nodes s ON s.k = l.k AND s.n > 1
    AND s.pos // 8 = l.pos // (8 ** (lvl + 1))::BIGINT AND s.pos <> l.pos // (8 ** lvl)::BIGINT
  UNION ALL
  SELECT rn, 1000 + lvl, s.pos, s.h FROM leaves l JOIN upper_nodes s ON s.n > 1
    AND s.pos // 8 = (l.k - 1) // (8 ** (lvl + 1))::BIGINT AND s.pos <> (l.k - 1) // (8 ** lvl)::BIGINT
),
proofs AS (SELECT rn, sha256(string_agg(h, '' ORDER BY lvl, pos)) AS p FROM siblings GROUP BY rn),
lower_fold(rn, k, lvl, pos, h) AS (
  SELECT rn, k, 0, pos, read_leaf FROM leaves
  UNION ALL
  SELECT f.rn, f.k, f.lvl + 1, f.pos // 8,
         sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.h ELSE s.h END, '' ORDER BY s.pos))
  FROM lower_fold f
  JOIN lower_nodes s ON s.k = f.k AND s.lvl = f.lvl AND s.n > 1 AND s.pos // 8 = f.pos // 8
  GROUP BY f.rn, f.k, f.lvl, f.pos
),
upper_fold(rn, lvl, pos, h) AS (
  SELECT f.rn, 0, f.k - 1, f.h FROM lower_fold f JOIN subroots USING (k, lvl)
  UNION ALL
  SELECT f.rn, f.lvl + 1, f.pos // 8,
         sha256(string_agg(CASE WHEN s.pos = f.pos THEN f.h ELSE s.h END, '' ORDER BY s.pos))
  FROM upper_fold f JOIN upper_nodes s ON s.lvl = f.lvl AND s.n > 1 AND s.pos // 8 = f.pos // 8
  GROUP BY f.rn, f.lvl, f.pos
),
folded AS (SELECT rn, arg_max(h, lvl) AS folded_root FROM upper_fold GROUP BY rn)
SELECT doc_id, leaf, subroots.h AS subroot, root, coalesce(p, sha256('')) AS proof_sha256,
       folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (k) JOIN folded USING (rn) LEFT JOIN proofs USING (rn), root
"""

SQL: dict[str, str] = {
    "op1_kd_top_k": _OP1,
    "op4_url_rules": _OP4,
    "op5_warc": _OP5,
    "op7_exact_dedup": _OP7,
    "op12_merkle_manifest": _OP12,
}
