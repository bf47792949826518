"""Frontier, captured responses, attempt outcomes, envelope and crawl reports.

The registered queries derive their inputs from the given tables (see FIXTURES.md):
- sitemaps: one file per (host, block of 50,000 page ids), URLs in page order;
- responses: one reader JSON body per page, built from the page's fields;
- attempts and outcomes: one attempt per ``events`` row, URL = user, crawl = user % 4.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from sitecorpus.functions.text import sql_lit, sql_strip
from sitecorpus.functions.urls import URL_RX, url_parts
from sitecorpus.operators.duplicates import duplicate_titles, route_duplicates
from sitecorpus.operators.html import sql_html_text, sql_language, sql_title, with_html_text
from sitecorpus.operators.reports import crawl_summary, failed_urls, progress, within_budget
from sitecorpus.operators.responses import (
    format_envelope, parse_envelope, parse_responses, resolve_attempts,
)
from sitecorpus.plans.catalog import register, table
from sitecorpus.plans.crawl import page_records
from sitecorpus.session import shared_path
from sitecorpus.sources.responses import read_responses
from sitecorpus.sources.sitemaps import (
    SITEMAP_NS, expand_seeds, parse_sitemaps, slice_frontier,
)

URLS_PER_SITEMAP = 50_000
START_INDEX = 3
BUDGET_SECONDS = 7 * 24 * 3600
MAX_RETRIES = 2


# ---- derived inputs ----------------------------------------------------------------------

def _xml_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def sitemap_files(pages: DataFrame) -> DataFrame:
    """``file, xml``: one sitemap per host and block of page ids, URLs in page order.
    A file holds at most ``URLS_PER_SITEMAP`` URLs, the protocol's limit."""
    _, host, _ = url_parts(F.col("url"))
    block = F.floor(F.col("page_id") / URLS_PER_SITEMAP)
    keyed = pages.select("page_id", "url", F.concat(
        F.lit("http://"), host, F.lit("/sitemap-"), block.cast("string"), F.lit(".xml")).alias("file"))
    entries = F.transform(F.array_sort(F.collect_list(F.struct("page_id", "url"))),
                          lambda e: F.concat(F.lit("<url><loc>"), _xml_escape(e["url"]),
                                             F.lit("</loc></url>")))
    head = f'<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="{SITEMAP_NS}">'
    return keyed.groupBy("file").agg(
        F.concat(F.lit(head), F.array_join(entries, "\n"), F.lit("</urlset>")).alias("xml"))


def _json_str(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.concat(F.lit('"'), c, F.lit('"'))


def page_responses(pages: DataFrame) -> DataFrame:
    """``url, body``: the reader's JSON for each page. Pages reached through a tracking
    link (``utm_source``) come back flagged as a cached snapshot."""
    recs = with_html_text(page_records(pages), "html", "content")
    warning = F.when(F.col("url").contains("utm_source"),
                     F.lit('"warning":"Cached Snapshot of the target page",')).otherwise(F.lit(""))
    body = F.concat(F.lit("{"), warning, F.lit('"data":{"title":'), _json_str(F.col("title")),
                    F.lit(',"content":'), _json_str(F.col("content")),
                    F.lit(',"url":'), _json_str(F.col("url")),
                    F.lit(',"metadata":{"lang":'), _json_str(F.col("language")), F.lit("}}}"))
    return recs.select("page_id", "url", body.alias("body"))


def event_attempts(events: DataFrame) -> DataFrame:
    """One fetch attempt per event: URL = user, ``signup`` events are the no-cache
    refetches, ``error`` events answer 500, ``view`` answers carry a cached-snapshot
    warning, cheap clicks (value < 5) answer with a body that is not JSON."""
    kind = F.when(F.col("event_type") == "signup", "refetch").otherwise("fetch")
    body = (F.when((F.col("event_type") == "click") & (F.col("value") < 5), F.lit("not json"))
            .when((F.col("event_type") == "signup") & (F.col("value") < 10),
                  F.lit('{"warning":"Cached snapshot","data":{}}'))
            .when(F.col("event_type") == "view", F.lit('{"warning":"Cached snapshot","data":{}}'))
            .otherwise(F.concat(F.lit('{"data":{"title":"u'), F.col("user_id").cast("string"),
                                F.lit('"}}'))))
    return events.select(F.col("user_id").cast("string").alias("url"), kind.alias("kind"),
                         F.col("ts").alias("started_at"), "event_id",
                         F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
                         F.lit(None).cast("string").alias("error"), body.alias("body"))


# attempts are numbered inside the resolver, in capture order
ATTEMPT_ORDER = ("started_at", "event_id")


def event_outcomes(events: DataFrame) -> DataFrame:
    """``crawl_id, url_index, url, ok, started_at`` with one URL per event."""
    return events.select((F.col("user_id") % 4).alias("crawl_id"),
                         (F.col("event_id") + 1).alias("url_index"),
                         F.concat(F.lit("https://site.example/e/"), F.col("event_id").cast("string")).alias("url"),
                         (F.col("event_type") != "error").alias("ok"),
                         F.col("ts").alias("started_at"))


# ---- SQL twins of the derived inputs ------------------------------------------------------

_HOST = f"regexp_extract(url, {sql_lit(URL_RX)}, 2)"
_SITEMAP_SQL = f"""
  SELECT 'http://' || {_HOST} || '/sitemap-' || CAST(page_id // {URLS_PER_SITEMAP} AS VARCHAR) || '.xml' AS file,
         row_number() OVER (PARTITION BY {_HOST}, page_id // {URLS_PER_SITEMAP} ORDER BY page_id) AS pos,
         url
  FROM pages"""


def _sql_json_str(e: str) -> str:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        e = f"replace({e}, {sql_lit(a)}, {sql_lit(b)})"
    return f"('\"' || {e} || '\"')"


_RESP_SQL = f"""
  SELECT page_id, url, title, content, language,
    '{{' || (CASE WHEN contains(url, 'utm_source') THEN '"warning":"Cached Snapshot of the target page",' ELSE '' END)
    || '"data":{{"title":' || {_sql_json_str('title')} || ',"content":' || {_sql_json_str('content')}
    || ',"url":' || {_sql_json_str('url')} || ',"metadata":{{"lang":' || {_sql_json_str('language')} || '}}}}}}' AS body
  FROM (SELECT page_id, url, {sql_title('html')} AS title, {sql_html_text('html')} AS content,
               {sql_language('html')} AS language FROM pages) p"""

_ATTEMPT_SQL = """
  SELECT url, kind, seq, status, body,
         json_valid(body) AS valid,
         CASE WHEN json_valid(body) THEN contains(lower(coalesce(json_extract_string(body, '$.warning'), '')), 'cached snapshot') ELSE false END AS cached
  FROM (
    SELECT CAST(user_id AS VARCHAR) AS url,
           CASE WHEN event_type = 'signup' THEN 'refetch' ELSE 'fetch' END AS kind,
           row_number() OVER (PARTITION BY user_id, event_type = 'signup' ORDER BY ts, event_id) AS seq,
           CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
           CASE WHEN event_type = 'click' AND value < 5 THEN 'not json'
                WHEN event_type = 'signup' AND value < 10 THEN '{"warning":"Cached snapshot","data":{}}'
                WHEN event_type = 'view' THEN '{"warning":"Cached snapshot","data":{}}'
                ELSE '{"data":{"title":"u' || CAST(user_id AS VARCHAR) || '"}}' END AS body
    FROM events) a"""

_OUTCOME_SQL = f"""
  WITH a AS ({_ATTEMPT_SQL}),
  g AS (
    SELECT url,
      min(seq) FILTER (WHERE kind = 'fetch' AND seq <= {MAX_RETRIES + 1} AND status < 400) AS dec_seq,
      count(*) FILTER (WHERE kind = 'fetch' AND seq <= {MAX_RETRIES + 1}) AS n_fetch,
      min(seq) FILTER (WHERE kind = 'refetch') AS ref_seq
    FROM a GROUP BY url),
  r AS (
    SELECT g.url, g.dec_seq, g.n_fetch, d.valid AS d_valid, d.cached AS d_cached,
           f.status AS r_status, f.valid AS r_valid, f.cached AS r_cached, g.ref_seq
    FROM g LEFT JOIN a d ON d.url = g.url AND d.kind = 'fetch' AND d.seq = g.dec_seq
           LEFT JOIN a f ON f.url = g.url AND f.kind = 'refetch' AND f.seq = g.ref_seq),
  o AS (
    SELECT url,
      CASE WHEN dec_seq IS NULL THEN 'http_error'
           WHEN NOT d_valid THEN 'invalid_json'
           WHEN d_cached THEN (CASE WHEN ref_seq IS NULL THEN 'no_refetch'
                                    WHEN r_status >= 400 THEN 'refetch_http_error'
                                    WHEN NOT r_valid THEN 'invalid_json'
                                    WHEN r_cached THEN 'still_cached' END)
      END AS reason,
      CAST(CASE WHEN dec_seq IS NULL THEN n_fetch ELSE dec_seq END AS INTEGER) AS n_attempts,
      coalesce(dec_seq IS NOT NULL AND d_valid AND d_cached, false) AS from_refetch
    FROM r)
  SELECT url, reason IS NULL AS ok, reason, n_attempts, from_refetch FROM o"""

_EVENT_OUTCOME_SQL = """
  SELECT user_id % 4 AS crawl_id, event_id + 1 AS url_index,
         'https://site.example/e/' || CAST(event_id AS VARCHAR) AS url,
         event_type <> 'error' AS ok, ts AS started_at
  FROM events"""


# ---- queries --------------------------------------------------------------------------------

@register("sitemap_urls", _SITEMAP_SQL)
def q_sitemap_urls(spark, sf_dir):
    return parse_sitemaps(sitemap_files(table(spark, sf_dir, "pages")))


def _frontier(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    files = sitemap_files(pages)
    seeds = files.select(F.col("file").alias("seed")).unionByName(
        pages.select(F.col("url").alias("seed")))
    return expand_seeds(seeds, parse_sitemaps(files))


@register("seed_dispatch", f"""
  SELECT file AS seed, pos AS url_index, url FROM ({_SITEMAP_SQL}) s
  UNION ALL SELECT url AS seed, 1 AS url_index, url FROM pages WHERE NOT suffix(url, '.xml')""")
def q_seed_dispatch(spark, sf_dir):
    return _frontier(spark, sf_dir)


@register("url_slice", f"""
  WITH s AS ({_SITEMAP_SQL})
  SELECT file AS seed, pos AS url_index, url, NULL::VARCHAR AS error FROM s WHERE pos >= {START_INDEX}
  UNION ALL SELECT file, max(pos), NULL, 'start_index_exceeds_total' FROM s GROUP BY file
  HAVING max(pos) < {START_INDEX}""")
def q_url_slice(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    files = sitemap_files(pages)
    frontier = expand_seeds(files.select(F.col("file").alias("seed")), parse_sitemaps(files))
    return slice_frontier(frontier, START_INDEX)


@register("response_scan", f"SELECT url, body FROM ({_RESP_SQL}) r")
def q_response_scan(spark, sf_dir):
    out = shared_path(spark, "responses", uuid.uuid4().hex)
    page_responses(table(spark, sf_dir, "pages")).select("url", "body").write.parquet(out)
    return read_responses(spark, out)


@register("response_fields", f"""
  SELECT url, title, content, url AS url_source, '' AS description, language,
         NULL::VARCHAR AS error FROM ({_RESP_SQL}) r""")
def q_response_fields(spark, sf_dir):
    resp = page_responses(table(spark, sf_dir, "pages"))
    return parse_responses(resp).select("url", "title", "content", "url_source", "description",
                                        "language", "error")


@register("fetch_outcome", _OUTCOME_SQL)
def q_fetch_outcome(spark, sf_dir):
    att = event_attempts(table(spark, sf_dir, "events"))
    return resolve_attempts(att, MAX_RETRIES, with_body=False, order=ATTEMPT_ORDER).select(
        "url", "ok", "reason", "n_attempts", "from_refetch")


@register("cached_refetch", f"""
  SELECT url, ok, reason, CASE WHEN ok THEN (SELECT body FROM ({_ATTEMPT_SQL}) a
         WHERE a.url = o.url AND a.kind = 'refetch' AND a.seq = 1) END AS body FROM ({_OUTCOME_SQL}) o
  WHERE from_refetch OR reason IN ('no_refetch', 'refetch_http_error', 'still_cached')
     OR (reason = 'invalid_json' AND from_refetch)""")
def q_cached_refetch(spark, sf_dir):
    att = event_attempts(table(spark, sf_dir, "events"))
    out = resolve_attempts(att, MAX_RETRIES, with_body=True, order=ATTEMPT_ORDER)
    return out.filter(F.col("from_refetch") | F.col("reason").isin(
        "no_refetch", "refetch_http_error", "still_cached", "refetch_error")).select(
        "url", "ok", "reason", "body")


def _envelopes(spark, sf_dir):
    resp = parse_responses(page_responses(table(spark, sf_dir, "pages")))
    return format_envelope(resp)


@register("envelope_format", f"""
  SELECT url, 'Title: ' || title || chr(10) || chr(10) || 'URL Source: ' || url || chr(10) || chr(10)
    || 'Description: ' || chr(10) || chr(10) || 'Language: ' || language || chr(10) || chr(10)
    || 'Markdown Content:' || chr(10) || content AS envelope
  FROM ({_RESP_SQL}) r""")
def q_envelope_format(spark, sf_dir):
    return _envelopes(spark, sf_dir).select("url", "envelope")


@register("envelope_parse", f"""
  SELECT url, title AS env_title, url AS env_url_source, '' AS env_description,
         language AS env_language, {sql_strip('content')} AS env_markdown
  FROM ({_RESP_SQL}) r""")
def q_envelope_parse(spark, sf_dir):
    return parse_envelope(_envelopes(spark, sf_dir)).select(
        "url", "env_title", "env_url_source", "env_description", "env_language", "env_markdown")


def _page_crawls(spark, sf_dir):
    recs = page_records(table(spark, sf_dir, "pages")).withColumn("crawl_id", F.col("page_id") % 4)
    return recs.withColumn("title_key", F.col("title"))


@register("crawl_summary", f"""
  WITH o AS ({_EVENT_OUTCOME_SQL}),
  b AS (SELECT crawl_id, count(*) AS total_urls, count(*) FILTER (WHERE ok) AS successful,
               count(*) FILTER (WHERE NOT ok) AS failed FROM o GROUP BY crawl_id),
  p AS (SELECT page_id % 4 AS crawl_id, {sql_title('html')} AS title FROM pages),
  s AS (SELECT crawl_id, title, count(*) AS n FROM p GROUP BY crawl_id, title HAVING count(*) > 1),
  d AS (SELECT crawl_id, CAST(sum(n) AS BIGINT) AS duplicate_files, count(*) AS duplicate_titles FROM s GROUP BY crawl_id),
  u AS (SELECT p.crawl_id, count(*) AS unique_files FROM p LEFT JOIN s ON p.crawl_id = s.crawl_id AND p.title = s.title
        WHERE s.title IS NULL GROUP BY p.crawl_id)
  SELECT b.crawl_id, total_urls, successful, failed,
         round(successful / total_urls * 100.0, 6) AS success_rate,
         coalesce(duplicate_files, 0) AS duplicate_files, coalesce(duplicate_titles, 0) AS duplicate_titles,
         successful - coalesce(duplicate_files, 0) AS unique_files_reported, coalesce(unique_files, 0) AS unique_files
  FROM b LEFT JOIN d ON b.crawl_id = d.crawl_id LEFT JOIN u ON b.crawl_id = u.crawl_id""")
def q_crawl_summary(spark, sf_dir):
    outcomes = event_outcomes(table(spark, sf_dir, "events"))
    pages = _page_crawls(spark, sf_dir)
    stats = duplicate_titles(pages, by=["crawl_id"])
    retained = route_duplicates(pages, stats=stats, by=["crawl_id"]).filter(~F.col("is_duplicate"))
    out = crawl_summary(outcomes, stats, retained)
    return out.withColumn("success_rate", F.round("success_rate", 6))


@register("failed_urls", f"""
  WITH o AS ({_EVENT_OUTCOME_SQL})
  SELECT crawl_id, url_index, url, count(*) OVER (PARTITION BY crawl_id) AS total_failed
  FROM o WHERE NOT ok""")
def q_failed_urls(spark, sf_dir):
    return failed_urls(event_outcomes(table(spark, sf_dir, "events")))


@register("crawl_progress", f"""
  WITH o AS ({_EVENT_OUTCOME_SQL}),
  r AS (SELECT crawl_id, url_index,
          count(*) OVER w AS processed, count(*) FILTER (WHERE ok) OVER w AS successful
        FROM o WINDOW w AS (PARTITION BY crawl_id ORDER BY url_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  SELECT crawl_id, url_index, processed, successful, processed - successful AS failed,
         round(successful / processed * 100.0, 6) AS success_rate FROM r""")
def q_crawl_progress(spark, sf_dir):
    out = progress(event_outcomes(table(spark, sf_dir, "events")))
    return out.withColumn("success_rate", F.round("success_rate", 6))


@register("time_budget", f"""
  WITH o AS ({_EVENT_OUTCOME_SQL})
  SELECT crawl_id, url_index, url FROM o
  QUALIFY epoch_us(started_at) - min(epoch_us(started_at)) OVER (PARTITION BY crawl_id) <= CAST({BUDGET_SECONDS} AS BIGINT) * 1000000""")
def q_time_budget(spark, sf_dir):
    kept = within_budget(event_outcomes(table(spark, sf_dir, "events")), BUDGET_SECONDS)
    return kept.select("crawl_id", "url_index", "url")
