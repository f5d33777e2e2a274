"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.exact_dedup import exact_groups

    return exact_groups(_table(spark, sf_dir, "documents"), hash_all=True)


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.vectors import near_vectors

    return near_vectors(_table(spark, sf_dir, "embeddings"))


OP1_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.98),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.html import main_text

    return main_text(_table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.jaccard import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents")).drop("same_set_id")


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.lm import score_documents

    return score_documents(_table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.quality import quality

    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.mixing import rates

    return rates(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.toxicity import toxicity

    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.warc import lookup, write_archive

    pages = _table(spark, sf_dir, "pages")
    return lookup(spark, write_archive(pages), pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.prefix_trie import prefix_trie

    return prefix_trie(_table(spark, sf_dir, "conversations"))


def _crc32(s: str) -> str:
    """SQL for the unsigned CRC-32 (polynomial 0xEDB88320) of an ASCII string s, byte by byte and bit by bit."""
    values = f"[4294967295] || list_transform(range(1, len({s}) + 1), lambda i: CAST(ascii({s}[i]) AS BIGINT))"
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    return f"xor(4294967295, list_reduce({values}, lambda a, b: {step}))"


OP11_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, r, x) AS v, CAST(conv_id AS VARCHAR) AS s FROM t GROUP BY conv_id),
c AS (SELECT o.conv_id, o.v, CAST({_crc32("o.s")} % 6 AS BIGINT) AS h, coalesce(b.v, []) AS bv FROM o LEFT JOIN o b ON b.conv_id = o.conv_id - o.conv_id % 100),
rb AS (SELECT conv_id, list_concat(bv[1:h], v[h + 1:]) AS v FROM c),
p AS (SELECT conv_id, d, v[1:d] AS k, len(v) = d AS ends FROM (SELECT conv_id, v, unnest(range(0, len(v) + 1)) AS d FROM rb)),
n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY k, d),
kids AS (SELECT k[1:d - 1] AS k, count(*) AS c FROM n WHERE d > 0 GROUP BY 1),
e AS (SELECT n.*, coalesce(kids.c, 0) AS n_children FROM n LEFT JOIN kids ON n.k = kids.k),
up AS (SELECT k[1:i] AS k, leaf, saving FROM (SELECT k, n_children = 0 AS leaf, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * length(k[d].x) END AS saving, unnest(range(0, d + 1)) AS i FROM e)),
s AS (SELECT k, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saving) AS BIGINT) AS saved_tokens FROM up GROUP BY k)
SELECT e.conv_id, e.d AS depth, q.conv_id AS parent_conv_id, e.n_convs, e.n_children, s.n_leaves, s.saved_tokens, e.ends_sha256
FROM e JOIN s ON e.k = s.k LEFT JOIN n q ON e.d > 0 AND q.d = e.d - 1 AND q.k = e.k[1:e.d - 1]
"""


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.lexical import search

    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, coalesce(text, '') AS x FROM documents), q AS (SELECT item_id, coalesce(text, '') AS x FROM benchmark WHERE item_id IS NOT NULL),
dt AS (SELECT i, doc_id, unnest(regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM d),
qt AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM q),
tf AS (SELECT i, doc_id, t, count(*) AS tf FROM dt GROUP BY ALL), n AS (SELECT i, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY i), s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
m AS (SELECT i, 100 - 50 + ((50 * n * n_docs) // n_terms) AS m FROM n, s), df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM df, s),
r AS (SELECT item_id, i, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM qt JOIN tf USING (t) JOIN w USING (t) JOIN m USING (i) GROUP BY ALL)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0) WHERE rank <= 50
"""


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sitewise.llm.sharding import sharded

    return sharded(_table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages), d AS (SELECT page_id, octet_length(b) AS n, sha1(b) AS h FROM p),
m AS (SELECT h, max(page_id) AS top FROM d WHERE n >= 1000 GROUP BY h)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest, CASE WHEN n >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 1000 AND page_id <> top THEN top END AS refers_to FROM d LEFT JOIN m USING (h)
"""

OP4_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 3, 2)), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
t AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p WHERE 100 * c >= 80 * (na + nb - c)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id FROM s JOIN c ON c.a = s.doc_id
"""

OP6_SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents),
g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM t JOIN g USING (h)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_html_extraction": op2_html_extraction,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_mixing_to_target_weights": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_warc": op10_warc,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_sharding": op13_sharding,
}
ORACLES: dict[str, str] = {
    "op1_embedding_near_dedup": OP1_SQL,
    "op4_ngram_jaccard_join": OP4_SQL,
    "op6_exact_dedup": OP6_SQL,
    "op10_warc": OP10_SQL,
    "op11_prefix_trie": OP11_SQL,
    "op12_lexical_search": OP12_SQL,
}
