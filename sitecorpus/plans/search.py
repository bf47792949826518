"""Chunking and retrieval over the ``documents``, ``embeddings`` and ``benchmark`` tables.

Derived inputs (see FIXTURES.md): vector search runs every embedding as a query against all
embeddings; keyword search runs every ``benchmark`` item against all documents; hybrid
queries are the benchmark items, embedded as the vector with ``vec_id = item_id``, and a
document's vector is the one with ``vec_id = doc_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitecorpus.functions.text import sql_lit
from sitecorpus.operators.chunking import (
    EMAIL_RX, URL_RX, children, parents, preprocess, sql_children, sql_preprocess,
    sql_token_count,
)
from sitecorpus.operators.retrieval import (
    TERM_RX, TIE_DIGITS, hybrid_scores, keyword_top_k, retrieve, top_k, vector_top_k,
)
from sitecorpus.plans.catalog import register, table

K_VECTOR = 2
K_REPORT = 10
K_FINAL = 2
WEIGHT = 0.7
THRESHOLD = 0.7
REPORT_THRESHOLD = 0.3


def _docs(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def _queries(spark, sf_dir) -> DataFrame:
    bench = table(spark, sf_dir, "benchmark")
    emb = table(spark, sf_dir, "embeddings")
    return bench.join(emb, bench["item_id"] == emb["vec_id"], "left").select(
        F.col("item_id").alias("query_id"), "text", "embedding")


def _vectors(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")


def _hybrid(spark, sf_dir, k=None, threshold=None) -> DataFrame:
    return hybrid_scores(_queries(spark, sf_dir), _docs(spark, sf_dir), _vectors(spark, sf_dir), WEIGHT, k, threshold)


def _rounded(df: DataFrame) -> DataFrame:
    """Scores at six digits, for the output only."""
    return df.select(*[F.round(c, 6).alias(c) if c.endswith("score") else F.col(c) for c in df.columns])


# ---- SQL twins -------------------------------------------------------------------------------

_PRE = sql_preprocess("text")
_DOCS_PRE_SQL = f"SELECT doc_id, {_PRE} AS text FROM documents"
_COS = """CASE WHEN sqrt(list_dot_product(a::DOUBLE[], a::DOUBLE[])) > 0 AND sqrt(list_dot_product(b::DOUBLE[], b::DOUBLE[])) > 0
  THEN list_dot_product(a::DOUBLE[], b::DOUBLE[]) / (sqrt(list_dot_product(a::DOUBLE[], a::DOUBLE[])) * sqrt(list_dot_product(b::DOUBLE[], b::DOUBLE[])))
  ELSE 0.0 END"""
_VEC_SQL = f"""
  SELECT query_id, doc_id, round(s, 6) AS vector_score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(s, {TIE_DIGITS}) DESC, doc_id) AS rank
    FROM (
      SELECT q.vec_id AS query_id, c.vec_id AS doc_id,
             {_COS.replace('a::', 'q.embedding::').replace('b::', 'c.embedding::')} AS s
      FROM embeddings q, embeddings c) s) r
  WHERE rank <= {K_VECTOR}"""
_TOK = "unnest(regexp_extract_all(lower(text), " + sql_lit(TERM_RX) + "))"
_KW_SQL = f"""
  WITH dt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {_TOK} AS term FROM documents) x GROUP BY doc_id, term),
  n AS (SELECT count(*) AS n FROM documents),
  idf AS (SELECT term, ln(1.0 + (SELECT n FROM n) / count(*)) AS idf FROM dt GROUP BY term),
  dw AS (SELECT doc_id, dt.term, tf * idf AS w FROM dt JOIN idf ON dt.term = idf.term),
  dn AS (SELECT doc_id, sqrt(sum(w * w)) AS dn FROM dw GROUP BY doc_id),
  qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT item_id AS query_id, {_TOK} AS term FROM benchmark) x GROUP BY query_id, term),
  qw AS (SELECT query_id, qt.term, qtf * idf AS qw FROM qt JOIN idf ON qt.term = idf.term),
  qn AS (SELECT query_id, sqrt(sum(qw * qw)) AS qn FROM qw GROUP BY query_id),
  dots AS (SELECT query_id, doc_id, sum(w * qw) AS dot FROM dw JOIN qw ON dw.term = qw.term GROUP BY query_id, doc_id)
  SELECT dots.query_id, dots.doc_id, dot / (qn * dn) AS keyword_score
  FROM dots JOIN qn ON dots.query_id = qn.query_id JOIN dn ON dots.doc_id = dn.doc_id"""
_HYB_SQL = f"""
  WITH kw AS ({_KW_SQL}),
  q AS (SELECT b.item_id AS query_id, e.embedding FROM benchmark b LEFT JOIN embeddings e ON b.item_id = e.vec_id),
  ids AS (SELECT doc_id FROM documents UNION SELECT vec_id FROM embeddings),
  vs AS (
    SELECT q.query_id, ids.doc_id,
           CASE WHEN q.embedding IS NULL OR c.embedding IS NULL THEN 0.0
                ELSE {_COS.replace('a::', 'q.embedding::').replace('b::', 'c.embedding::')} END AS vector_score
    FROM q CROSS JOIN ids LEFT JOIN embeddings c ON ids.doc_id = c.vec_id)
  SELECT vs.query_id, vs.doc_id, vs.vector_score, coalesce(kw.keyword_score, 0.0) AS keyword_score,
         round({round(WEIGHT, 2)}::DOUBLE * vs.vector_score
               + {round(1 - WEIGHT, 2)}::DOUBLE * coalesce(kw.keyword_score, 0.0), {TIE_DIGITS}) AS score
  FROM vs LEFT JOIN kw ON vs.query_id = kw.query_id AND vs.doc_id = kw.doc_id"""


def _sql_topk(inner: str, k: int, score: str = "score") -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round({score}, {TIE_DIGITS}) DESC, doc_id) AS rank
  FROM ({inner}) t QUALIFY rank <= {k}"""


_HYB_OUT = "query_id, doc_id, round(vector_score, 6) AS vector_score, round(keyword_score, 6) AS keyword_score, round(score, 6) AS score"


# ---- queries --------------------------------------------------------------------------------

@register("normalize_spaces", f"SELECT doc_id, {_PRE} AS text FROM documents")
def q_normalize(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", preprocess("text").alias("text"))


_STRIP = (f"regexp_replace(regexp_replace(text, {sql_lit(URL_RX)}, '', 'g'), "
          f"{sql_lit(EMAIL_RX)}, '', 'g')")


@register("strip_urls_emails", f"SELECT doc_id, {sql_preprocess(_STRIP)} AS text FROM documents")
def q_strip_urls(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", preprocess("text", urls_emails=True).alias("text"))


@register("parent_chunks", f"""
  SELECT doc_id, text AS parent_text, {sql_token_count('text')} AS n_tokens FROM ({_DOCS_PRE_SQL}) d""")
def q_parents(spark, sf_dir):
    pre = _docs(spark, sf_dir).select("doc_id", preprocess("text").alias("text"))
    return parents(pre).select("doc_id", "parent_text", "n_tokens")


@register("child_chunks", sql_children(_DOCS_PRE_SQL, "doc_id", "text"))
def q_children(spark, sf_dir):
    pre = _docs(spark, sf_dir).select("doc_id", preprocess("text").alias("text"))
    return children(pre)


@register("vector_score", _VEC_SQL)
def q_vector(spark, sf_dir):
    emb = table(spark, sf_dir, "embeddings")
    return _rounded(vector_top_k(emb.select(F.col("vec_id").alias("query_id"), "embedding"),
                                 emb.select(F.col("vec_id").alias("doc_id"), "embedding"), K_VECTOR))


@register("keyword_score", f"""SELECT query_id, doc_id, round(keyword_score, 6) AS keyword_score, rank
  FROM ({_sql_topk(_KW_SQL, K_REPORT, "keyword_score")}) k""")
def q_keyword(spark, sf_dir):
    return _rounded(keyword_top_k(_queries(spark, sf_dir), _docs(spark, sf_dir), K_REPORT))


@register("hybrid_score", f"SELECT {_HYB_OUT}, rank FROM ({_sql_topk(_HYB_SQL, K_REPORT)}) h")
def q_hybrid(spark, sf_dir):
    return _rounded(top_k(_hybrid(spark, sf_dir, K_REPORT), K_REPORT))


@register("score_threshold", f"SELECT {_HYB_OUT} FROM ({_HYB_SQL}) h WHERE score >= {REPORT_THRESHOLD}")
def q_threshold(spark, sf_dir):
    """Every document that reaches the threshold, however many."""
    return _rounded(_hybrid(spark, sf_dir, None, REPORT_THRESHOLD))


@register("top_k", f"""SELECT query_id, doc_id, round(score, 6) AS score, rank FROM ({_sql_topk(
    f"SELECT query_id, doc_id, score FROM ({_HYB_SQL}) h WHERE score >= {THRESHOLD}", K_FINAL)}) r""")
def q_top_k(spark, sf_dir):
    res = retrieve(_queries(spark, sf_dir), _docs(spark, sf_dir), _vectors(spark, sf_dir),
                   method="hybrid", k=K_FINAL, weight=WEIGHT, threshold=THRESHOLD)
    return _rounded(res.select("query_id", "doc_id", "score", "rank"))
