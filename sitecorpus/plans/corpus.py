"""Corpus round trip: page records → markdown files with frontmatter → read back → parse →
duplicate analysis over the stored corpus (the "duplicates only" mode)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitecorpus.functions.text import sql_slug
from sitecorpus.functions.urls import sql_domain, sql_filename
from sitecorpus.operators.duplicates import (
    duplicate_titles, latest_pages, route_duplicates, with_title_key,
)
from sitecorpus.operators.frontmatter import (
    FENCE_RX, lint_frontmatter, parse_frontmatter, render_pages, split_frontmatter,
    sql_render_frontmatter, sql_yaml_quote, yaml_quote,
)
from sitecorpus.operators.html import sql_html_text, sql_language, sql_title, with_html_text
from sitecorpus.functions.text import sql_lit, py_strip
from sitecorpus.plans.catalog import register, table
from sitecorpus.plans.crawl import page_records
from sitecorpus.plans.sizing import materialize
from sitecorpus.session import shared_path
from sitecorpus.sinks.files import export_markdown_now, write_routed
from sitecorpus.sources.corpus import read_exported_corpus

# Capture time written into every record by the registered queries (Unix seconds); the
# library takes it as an argument instead of reading the clock.
CRAWL_DATE = 1700000000


def page_documents(pages: DataFrame, crawl_date: int = CRAWL_DATE) -> DataFrame:
    """Page records with the body (visible text) and the fields the frontmatter needs."""
    recs = with_html_text(page_records(pages), "html", "markdown")
    return recs.select("*", F.col("url").alias("url_source"),
                       F.lit(crawl_date).cast("long").alias("crawl_date"))


def rendered_pages(spark: SparkSession, sf_dir: str, include_language: bool = True) -> DataFrame:
    docs = page_documents(table(spark, sf_dir, "pages"))
    return render_pages(docs, include_language=include_language).drop("html")


def export_corpus(spark: SparkSession, sf_dir: str, out: str | None = None):
    """Write the latest page per file name as markdown; return (folder, manifest)."""
    out = out or shared_path(spark, "corpus", uuid.uuid4().hex)
    latest = latest_pages(rendered_pages(spark, sf_dir))
    return out, export_markdown_now(latest, out)


def analyze_corpus(files: DataFrame, keep: str = "none"):
    """Duplicate analysis over the files of a stored corpus: (routed records, duplicate stats).

    Unreadable files (bad UTF-8, bad YAML, empty block) are left out as the original tool
    skips them; a non-mapping block is reported in ``error``."""
    parsed = parse_frontmatter(split_frontmatter(files))
    readable = parsed.filter(F.col("error").isNull() & F.col("fm_error").isNull()
                             & (F.col("yaml_kind") != "null"))
    keyed = with_title_key(readable.withColumn("url_index", F.lit(0)), meta_col="meta",
                           stem_col="stem")
    # the statistics need names and titles only: those are written, not the texts
    narrow = materialize(keyed.select("filename", "title_key", "url_index"), "corpus-titles")
    stats = duplicate_titles(narrow, keep=keep)
    routed = route_duplicates(keyed, keep=keep, stats=stats)
    return routed, stats


# ---- SQL twins ---------------------------------------------------------------------------

_DOC_SQL = f"""
  SELECT page_id, page_id + 1 AS url_index, url, {sql_title('html')} AS title,
         {sql_domain('url')} AS domain, {sql_filename('url')} AS filename,
         {sql_language('html')} AS language, {sql_html_text('html')} AS markdown
  FROM pages"""
_RENDER = sql_render_frontmatter("title", "url", "domain", str(CRAWL_DATE), "''", "language")
_RENDERED_SQL = f"SELECT page_id, url_index, filename, title, {_RENDER} || markdown AS text FROM ({_DOC_SQL}) d"
_LATEST_RENDERED_SQL = f"""
  SELECT * FROM ({_RENDERED_SQL}) r
  QUALIFY row_number() OVER (PARTITION BY filename ORDER BY url_index DESC) = 1"""
_CORPUS_STATS_SQL = f"""
  SELECT title, count(*) AS total_files, count(*) AS moved_files, {sql_slug('title')} AS folder
  FROM ({_LATEST_RENDERED_SQL}) l GROUP BY title HAVING count(*) > 1"""


@register("yaml_escape", f"""
  SELECT page_id, {sql_yaml_quote(sql_title('html'))} AS quoted_title,
         {sql_yaml_quote('url')} AS quoted_url FROM pages""")
def q_yaml_escape(spark, sf_dir):
    recs = page_records(table(spark, sf_dir, "pages"))
    return recs.select("page_id", yaml_quote("title").alias("quoted_title"),
                       yaml_quote("url").alias("quoted_url"))


@register("frontmatter_render", f"SELECT page_id, filename, text FROM ({_RENDERED_SQL}) r")
def q_render(spark, sf_dir):
    return rendered_pages(spark, sf_dir).select("page_id", "filename", "text")


@register("frontmatter_split", f"""
  SELECT page_id, true AS has_frontmatter,
         regexp_extract(text, {sql_lit(FENCE_RX)}, 1) AS fm_block,
         regexp_extract(text, {sql_lit(FENCE_RX)}, 2) AS body
  FROM ({_RENDERED_SQL}) r""")
def q_split(spark, sf_dir):
    return (split_frontmatter(rendered_pages(spark, sf_dir), "text")
            .select("page_id", "has_frontmatter", "fm_block", "body"))


@register("frontmatter_fields", f"""
  SELECT page_id, title, url AS source_url, domain, '{CRAWL_DATE}' AS crawl_date,
         '' AS description, CASE WHEN language = '' THEN NULL ELSE language END AS language,
         'mapping' AS yaml_kind
  FROM ({_DOC_SQL}) d""")
def q_fields(spark, sf_dir):
    parsed = parse_frontmatter(split_frontmatter(rendered_pages(spark, sf_dir), "text"))
    m = F.col("meta")
    return parsed.select("page_id", *[F.try_element_at(m, F.lit(k)).alias(k) for k in
                                      ("title", "source_url", "domain", "crawl_date",
                                       "description", "language")], "yaml_kind")


@register("frontmatter_roundtrip")
def q_roundtrip(spark, sf_dir):
    """Lint over the documents' whole texts: the first line as title, all of the rest, line breaks
    included, as description."""
    docs = table(spark, sf_dir, "documents")
    rest = F.regexp_extract("text", r"(?s)^[^\n]*\n(.*)$", 1)
    recs = docs.select("doc_id", py_strip(F.substring_index("text", "\n", 1)).alias("title"),
                       F.concat(F.lit("doc://"), F.col("source"), F.lit("/"),
                                F.col("doc_id").cast("string")).alias("url_source"),
                       F.col("source").alias("domain"), rest.alias("description"))
    return lint_frontmatter(recs)


@register("read_corpus", f"""
  SELECT filename, regexp_replace(filename, '\\.md$', '') AS stem, text AS raw
  FROM ({_LATEST_RENDERED_SQL}) l""")
def q_read_corpus(spark, sf_dir):
    _, manifest = export_corpus(spark, sf_dir)
    return read_exported_corpus(manifest).select("filename", "stem", "raw")


@register("export_markdown", f"""
  SELECT filename, octet_length(encode(text)) AS bytes, NULL::VARCHAR AS error FROM ({_LATEST_RENDERED_SQL}) l""")
def q_export(spark, sf_dir):
    _, manifest = export_corpus(spark, sf_dir)
    return manifest.select("filename", "bytes", "error")


@register("duplicates_only", _CORPUS_STATS_SQL)
def q_duplicates_only(spark, sf_dir):
    _, manifest = export_corpus(spark, sf_dir)
    _, stats = analyze_corpus(read_exported_corpus(manifest))
    return stats.select("title", "total_files", "moved_files", "folder")


@register("write_routed", f"""
  SELECT l.filename, l.text AS raw, s.title IS NOT NULL AS routed, s.folder
  FROM ({_LATEST_RENDERED_SQL}) l LEFT JOIN ({_CORPUS_STATS_SQL}) s ON l.title = s.title""")
def q_write_routed(spark, sf_dir):
    out, manifest = export_corpus(spark, sf_dir)
    routed, _ = analyze_corpus(read_exported_corpus(manifest))
    dest = out + "_routed"
    write_routed(routed.select("filename", "raw", "is_duplicate", "folder"), dest)
    return spark.read.parquet(dest).select("filename", "raw", F.col("routed").cast("boolean").alias("routed"), "folder")
