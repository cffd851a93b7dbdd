"""The dealt operators as catalogue queries: ``(spark, sf_dir) -> DataFrame`` and oracle SQL.

The functions here read the tables, call an operator with its production parameters and
derive the columns that are compared.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import benchmark_hits, contaminated
from .html_text import extract
from .jaccard_join import jaccard_components
from .language_id import language_id
from .mixing import mix_sources
from . import quality_fm
from .prefix_trie import conversation_trie
from .simhash_dedup import near_duplicates
from .suffix_dedup import repeat_report
from .token_alignment import alignment
from .token_count import token_counts
from .topk_search import top_k
from .toxicity import learnt_from, toxicity

Query = Callable[[SparkSession, str], DataFrame]

#: A text of more tokens than this does not fit the context of op9.
TOKEN_LIMIT = 4096


def tokenizer_path(name: str) -> str:
    """Path of a public tokenizer file; ``TOKENIZER_DIR`` names another folder."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def _fold(column: str, folds: int):
    """Fold of a row: crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string")) % folds


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("fold", _fold("doc_id", 3))
    training = docs.where(F.col("fold") != 1).select("text", "lang")
    found = language_id(docs, training)
    return found.select("doc_id", F.coalesce(_fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "rejected")


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = benchmark_hits(docs, table(spark, sf_dir, "benchmark"))
    return contaminated(hits).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                                     "contaminated")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), radius=2, words=3, seed=42)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = quality_fm.quality(docs, quality_fm.learnt_from(docs, learnable_labels(spark, sf_dir)))
    return scores.select("doc_id", F.coalesce(_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def learnable_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of the folds that are not held out."""
    return table(spark, sf_dir, "labels").where(_fold("doc_id", 5) != 0)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity(docs, *learnt_from(docs, learnable_labels(spark, sf_dir)))
    return scores.select("doc_id", F.coalesce(_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op12_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), percent=80, width=5)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                     tokenizer_path("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_language_id": op2_language_id,
    "op3_topk": op3_topk,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_mixing": op6_mixing,
    "op7_toxicity": op7_toxicity,
    "op8_html_text": op8_html_text,
    "op9_token_counts": op9_token_counts,
    "op10_quality": op10_quality,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_jaccard": op12_jaccard,
    "op13_token_alignment": op13_token_alignment,
}

#: Words of the texts, sampling order by a hash of the id, the water level by its equation.
OP6_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(CASE WHEN text IS NULL THEN 0
              ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS BIGINT) AS size,
         md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
         CAST(CASE row_number() OVER (ORDER BY source ASC NULLS LAST) % 3
              WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 2 END AS HUGEINT) AS w
  FROM d GROUP BY source),
level AS (
  SELECT a.source, a.source_size, a.w, (SELECT sum(source_size) FROM s) AS total,
         -- a source is full if the water at its own brim is within the budget
         2 * sum(CASE WHEN b.source_size * a.w <= a.source_size * b.w
                      THEN 2 * b.source_size * a.w ELSE 2 * a.source_size * b.w END)
           <= 3 * (SELECT sum(source_size) FROM s) * a.w AS filled
  FROM s a CROSS JOIN s b GROUP BY a.source, a.source_size, a.w),
rest AS (
  SELECT coalesce(sum(CASE WHEN filled THEN 2 * source_size END), 0) AS spent,
         sum(CASE WHEN NOT filled THEN w END) AS open_w
  FROM level),
t AS (
  SELECT source, source_size,
         CASE WHEN filled THEN 2 * source_size ELSE w * (3 * total - 2 * spent) END AS above,
         CASE WHEN filled THEN 1 ELSE 2 * open_w END AS below
  FROM level CROSS JOIN rest),
r AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE above // (below * source_size) END AS whole
  FROM t),
e AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS UNBOUNDED PRECEDING) AS running
  FROM d)
SELECT e.doc_id, e.size, CAST(r.source_size AS BIGINT) AS source_size,
       CAST(r.above AS DOUBLE) / CAST(r.below AS DOUBLE) AS target,
       CAST(e.size * r.whole + greatest(0, least(e.size, (r.above - r.whole * r.below * r.source_size)
            // r.below - (e.running - e.size))) AS BIGINT) AS taken
FROM e JOIN r ON e.source IS NOT DISTINCT FROM r.source
"""

#: Inner products of all pairs of a query and another row, ranked.
OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e,
         row_number() OVER () AS r
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, q.r, c.vec_id,
         CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
k AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 5
"""

#: Every prefix of every rebuilt conversation by the hash of its turns; a node's subtree by the
#: path of each node's smallest conversation. CRC-32 bit by bit.
OP11_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
i AS (
  SELECT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT),
               lambda a, c: list_reduce([xor(a, c)] || range(8),
                 lambda v, step: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)),
             4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM t)),
r AS (
  SELECT i.conv_id, 0 AS part, pos, role, text FROM i JOIN t ON t.conv_id = i.base AND pos <= h
  UNION ALL
  SELECT i.conv_id, 1, pos, role, text FROM i JOIN t ON t.conv_id = i.conv_id AND pos > h),
g AS (
  SELECT conv_id, text, row_number() OVER w AS d,
         list(sha256(length(role) || ':' || role || text)) OVER w AS turns
  FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)),
path AS (
  SELECT conv_id, d, md5(array_to_string(turns, ',')) AS k,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM g
  UNION ALL SELECT conv_id, 0, '', 0 FROM i),
node AS (SELECT d, k, min(conv_id) AS c, count(*) AS n, any_value(w) AS w FROM path GROUP BY d, k),
link AS (SELECT node.d, node.k, p.k AS up FROM node JOIN path p ON p.conv_id = node.c AND p.d = node.d - 1),
child AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM link GROUP BY ALL),
own AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (d, k)),
under AS (
  SELECT p.d, p.k, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((u.n - 1) * u.w) AS saved_tokens
  FROM own u JOIN path p ON p.conv_id = u.c AND p.d <= u.d GROUP BY ALL),
finish AS (
  SELECT d, k, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM (SELECT *, max(d) OVER (PARTITION BY conv_id) AS last FROM path) WHERE d = last GROUP BY ALL)
SELECT own.c AS conv_id, CAST(own.d AS BIGINT) AS depth, upper.c AS parent_conv_id,
       CAST(own.n AS BIGINT) AS n_convs, CAST(own.n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM own JOIN under USING (d, k) LEFT JOIN finish USING (d, k) LEFT JOIN link USING (d, k)
LEFT JOIN node upper ON upper.d = own.d - 1 AND upper.k = link.up
"""

#: Pairs of different sets by their common shingles; reachable sets by recursion.
OP12_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS words
  FROM documents),
u AS (SELECT r, len(words) AS n, array_to_string(words[1:4], ' ') AS start, unnest(words) AS w,
             generate_subscripts(words, 1) AS i FROM w),
v AS (
  SELECT r, n, i, CASE WHEN n < 5 THEN start
         ELSE concat_ws(' ', w, lead(w, 1) OVER o, lead(w, 2) OVER o, lead(w, 3) OVER o, lead(w, 4) OVER o) END AS t
  FROM u WINDOW o AS (PARTITION BY r ORDER BY i)),
s AS (SELECT DISTINCT r, t FROM v WHERE i <= greatest(n - 4, 1)),
g AS (SELECT r, count(*) AS n, md5(string_agg(t, chr(10) ORDER BY t)) AS k FROM s GROUP BY r),
d AS (SELECT w.r, doc_id, coalesce(n, 0) AS n, k FROM w LEFT JOIN g USING (r)),
one AS (SELECT min(r) AS r, k, any_value(n) AS n FROM d WHERE n > 0 GROUP BY k),
p AS (SELECT one.r, one.n, t FROM one JOIN s USING (r)),
often AS (SELECT t FROM p GROUP BY t HAVING count(*) > 1),
q AS (SELECT r, n, hash(t) AS t FROM p SEMI JOIN often USING (t)),
pair AS (
  SELECT a.r AS a, b.r AS b FROM q a JOIN q b
  ON a.t = b.t AND a.r <> b.r AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.r, a.n, b.r, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(a, b) AS (
  SELECT r, r FROM one UNION SELECT reach.a, pair.b FROM reach JOIN pair ON pair.a = reach.b),
least AS (SELECT k, min(doc_id) AS doc_id FROM d WHERE n > 0 GROUP BY k),
comp AS (
  SELECT one.k, min(least.doc_id) AS component_id
  FROM one JOIN reach ON reach.a = one.r JOIN one o ON o.r = reach.b JOIN least ON least.k = o.k GROUP BY one.k)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles,
       CASE WHEN d.n > 0 THEN component_id ELSE d.doc_id END AS component_id
FROM d LEFT JOIN comp USING (k)
"""

ORACLE: dict[str, str] = {"op3_topk": OP3_SQL, "op6_mixing": OP6_SQL, "op11_conversation_trie": OP11_SQL,
                          "op12_jaccard": OP12_SQL}
