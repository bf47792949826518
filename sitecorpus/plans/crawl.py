"""Crawl-side plans over the ``pages`` table: page records, URL names, last write per file
name, duplicate titles and their routing.

``pages`` stands for the captured crawl: its ``page_id`` order is the frontier order, so
``url_index = page_id + 1`` (1-based, as the frontier numbers URLs).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitecorpus.functions.text import sql_slug
from sitecorpus.functions.urls import sql_domain, sql_filename, url_domain, url_error, url_filename
from sitecorpus.operators.duplicates import (
    duplicate_breakdown, duplicate_titles, latest_pages, route_duplicates, with_title_key,
)
from sitecorpus.operators.html import extract_page_metadata, sql_description, sql_language, sql_title
from sitecorpus.functions.text import slug
from sitecorpus.plans.catalog import register, table


def page_records(pages: DataFrame) -> DataFrame:
    """One record per fetched page: position, names and the reader's metadata fields."""
    df = pages.select("page_id", "url", "html", (F.col("page_id") + 1).alias("url_index"))
    df = extract_page_metadata(df)
    return df.select(
        "page_id", "url", "url_index", "html", "title", "description", "language",
        url_domain("url").alias("domain"), url_filename("url").alias("filename"),
        url_error("url").alias("error"),
    )


def crawl_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: pages → title → file names → last write per name → repeated titles."""
    recs = latest_pages(page_records(table(spark, sf_dir, "pages")))
    keyed = with_title_key(recs, title_col="title", stem_col="filename")
    return duplicate_titles(keyed).select("title", "total_files", "moved_files", "folder")


# ---- oracle SQL fragments -------------------------------------------------------------

_PAGE_SQL = f"""
  SELECT page_id, url, page_id + 1 AS url_index, {sql_title('html')} AS title,
         {sql_domain('url')} AS domain, {sql_filename('url')} AS filename
  FROM pages"""
_LATEST_SQL = f"""
  SELECT * FROM ({_PAGE_SQL}) p
  QUALIFY row_number() OVER (PARTITION BY filename ORDER BY url_index DESC) = 1"""
_STATS_SQL = f"""
  SELECT title, count(*) AS total_files, count(*) AS moved_files, {sql_slug('title')} AS folder
  FROM ({_LATEST_SQL}) l GROUP BY title HAVING count(*) > 1"""


register("duplicate_titles", _STATS_SQL)(crawl_duplicates)


@register("url_domain", f"SELECT page_id, url, {sql_domain('url')} AS domain FROM pages")
def q_url_domain(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url", url_domain("url").alias("domain"))


@register("url_filename", f"SELECT page_id, {sql_filename('url')} AS filename FROM pages")
def q_url_filename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", url_filename("url").alias("filename"))


# Stand-in input: the pages of the tables carry no description, so each gets a meta tag made of its address,
# written in one of the ways that pages write it (see FIXTURES.md).
_TAGS = ["<meta name=\"description\" content=\"{u} &amp; it''s > all\">", "<META CONTENT=''say \"{u}\"'' NAME=''Description''/>",
         "<meta property=og:title content=no><meta content={p} name=description>", "<meta name=\"keywords\" content=\"description\">",
         "<meta  data-x=\"name=description\"\n name = \"description\"\n content = \" {u}\n  twice \">"]


def _described_sql() -> str:
    cases = " ".join(f"WHEN {i} THEN replace(replace('{t}', '{{u}}', url), '{{p}}', 'p' || page_id)" for i, t in enumerate(_TAGS)).replace("\n", "' || chr(10) || '")
    return f"SELECT page_id, url, replace(html, '<head>', '<head>' || CASE page_id % {len(_TAGS)} {cases} END) AS html FROM pages"


def described_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with a description tag in the head."""
    tag = F.lit(None).cast("string")
    for i, t in enumerate(_TAGS):
        text = F.replace(F.replace(F.lit(t.replace("''", "'")), F.lit("{u}"), F.col("url")),
                         F.lit("{p}"), F.concat(F.lit("p"), F.col("page_id").cast("string")))
        tag = F.when(F.col("page_id") % len(_TAGS) == i, text).otherwise(tag)
    return pages.withColumn("html", F.replace("html", F.lit("<head>"), F.concat(F.lit("<head>"), tag)))


@register("page_metadata", f"""
  SELECT page_id, {sql_title('html')} AS title, {sql_description('html')} AS description,
         {sql_language('html')} AS language FROM ({_described_sql()}) p""")
def q_page_metadata(spark, sf_dir):
    return (extract_page_metadata(described_pages(table(spark, sf_dir, "pages")))
            .select("page_id", "title", "description", "language"))


@register("latest_per_filename",
          f"SELECT page_id, url_index, filename FROM ({_LATEST_SQL}) l")
def q_latest(spark, sf_dir):
    recs = page_records(table(spark, sf_dir, "pages"))
    return latest_pages(recs).select("page_id", "url_index", "filename")


@register("title_key", f"SELECT page_id, filename, title AS title_key FROM ({_LATEST_SQL}) l")
def q_title_key(spark, sf_dir):
    recs = latest_pages(page_records(table(spark, sf_dir, "pages")))
    return with_title_key(recs, title_col="title", stem_col="filename").select(
        "page_id", "filename", "title_key")


@register("title_folder", f"""
  SELECT DISTINCT title, {sql_slug('title')} AS folder FROM ({_PAGE_SQL}) p""")
def q_title_folder(spark, sf_dir):
    recs = page_records(table(spark, sf_dir, "pages"))
    return recs.select("title").distinct().select("title", slug(F.col("title")).alias("folder"))


@register("route_duplicates", f"""
  SELECT l.page_id, l.filename, s.title IS NOT NULL AS is_duplicate, s.folder
  FROM ({_LATEST_SQL}) l LEFT JOIN ({_STATS_SQL}) s ON l.title = s.title""")
def q_route(spark, sf_dir):
    recs = latest_pages(page_records(table(spark, sf_dir, "pages")))
    keyed = with_title_key(recs, title_col="title", stem_col="filename")
    return route_duplicates(keyed).select("page_id", "filename", "is_duplicate", "folder")


@register("duplicate_breakdown", f"""
  SELECT title, total_files, moved_files, folder FROM ({_STATS_SQL}) s
  ORDER BY total_files DESC, title""")
def q_breakdown(spark, sf_dir):
    return duplicate_breakdown(crawl_duplicates(spark, sf_dir))
