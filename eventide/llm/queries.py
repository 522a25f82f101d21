"""The registered queries of this subpackage: each applies one operator, with
its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm import crf, fim, ftrl, html_extract, huffman, imatch, lemp, mixing, multi_index, packing, pii, simhash, subspace_join
from eventide.llm.common import table
from eventide.llm.tokens import vocabulary


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.groups(table(spark, sf_dir, "documents"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mixed_sizes(table(spark, sf_dir, "documents"))


def op4_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return imatch.edit_digests(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text; learned from rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    return crf.held_out(crf.predict(docs, crf.train(docs, crf.fold() != 1)))


def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth one."""
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with its personal numbers, dates and addresses replaced."""
    return pii.report(table(spark, sf_dir, "documents"))


def op8_huffman_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written in Huffman blocks and read back."""
    return huffman.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; learned from labelled rows outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    model = ftrl.train(docs, table(spark, sf_dir, "labels"), ftrl.fold() != 0)
    return ftrl.held_out(ftrl.score(docs, model))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return lemp.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) AS nd, CAST(sum(len(ts)) AS BIGINT) AS l FROM d WHERE len(ts) > 0),
m AS (SELECT r, doc_id, 100 - 90 + ((90 * len(ts) * nd) // l) AS m FROM d, s WHERE len(ts) > 0),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
      FROM f, s GROUP BY term, nd),
c AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM i JOIN w USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
             doc_id, score FROM c WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among those of its label."""
    return subspace_join.near_copies(table(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM v a JOIN v b
  ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
c AS (SELECT r, r AS near FROM v UNION SELECT c.r, l.b FROM c JOIN l ON l.a = c.near),
m AS (SELECT c.r, min(v.vec_id) AS component_id FROM c JOIN v ON v.r = c.near GROUP BY c.r),
n AS (SELECT a AS r, count(*) AS n_links FROM l GROUP BY a),
p AS (SELECT v.vec_id, coalesce(n_links, 0) AS n_links, component_id FROM v JOIN m USING (r) LEFT JOIN n USING (r))
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM p
UNION ALL
SELECT vec_id, 0, vec_id, vec_id IS NOT NULL FROM embeddings
WHERE NOT coalesce(vec_id IS NOT NULL AND label IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false)"""


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text cut in three and put in fill-in-the-middle order."""
    return fim.digests(table(spark, sf_dir, "documents"))


OP13_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT doc_id, t, length(t) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
             CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash, op2_html_extract, op3_mixing, op4_imatch, op5_language_id, op6_multi_index, op7_pii, op8_huffman_ids,
        op9_toxicity, op10_packing, op11_lexical_search, op12_embedding_dedup, op13_fill_in_middle)}


def oracle_sql() -> dict[str, str]:
    return {"op11_lexical_search": OP11_SQL, "op12_embedding_dedup": OP12_SQL, "op13_fill_in_middle": OP13_SQL}
