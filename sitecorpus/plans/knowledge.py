"""Import of the retained corpus into the knowledge table.

Derived inputs (see FIXTURES.md): the corpus is the latest page per file name with the
repeated titles routed out. An earlier, interrupted import already stored the documents of
the plain-http pages; its listing is served in pages covering blocks of 200 page ids, and
its field registry holds the frontmatter keys of those documents except ``language`` (that
run left the language out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitecorpus.functions.text import sql_lit, sql_strip
from sitecorpus.functions.urls import URL_RX, url_parts
from sitecorpus.operators.duplicates import latest_pages, route_duplicates, with_title_key
from sitecorpus.operators.frontmatter import parse_frontmatter, split_frontmatter
from sitecorpus.operators.upsert import (
    apply_upsert, assign_metadata, document_id, document_name, existing_documents, field_id,
    import_summary, importable, plan_upsert, read_document_listing, read_field_registry,
    reconcile_registry,
)
from sitecorpus.plans.catalog import register
from sitecorpus.plans.sizing import materialize
from sitecorpus.plans.corpus import CRAWL_DATE, _LATEST_RENDERED_SQL, _DOC_SQL, rendered_pages

PAGE_IDS_PER_LISTING_PAGE = 200


def corpus_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retained corpus as files: one row per file with its text."""
    latest = latest_pages(rendered_pages(spark, sf_dir))
    keyed = with_title_key(latest, title_col="title", stem_col="filename")
    kept = route_duplicates(keyed).filter(~F.col("is_duplicate"))
    return kept.select("page_id", "url", "filename", F.col("filename").alias("path"),
                        F.regexp_replace("filename", r"\.md$", "").alias("stem"),
                        F.col("text").alias("raw"), F.lit(None).cast("string").alias("error"))


def corpus_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retained corpus as the importer sees it: one row per file with parsed frontmatter."""
    docs = import_docs(corpus_files(spark, sf_dir))
    # The corpus feeds the listing, the registry and the plan: its names, metadata and status
    # are written once to the shared folder, without the texts.
    return materialize(docs.drop("raw", "body", "fm_block"), "corpus-docs")


def import_docs(files: DataFrame) -> DataFrame:
    """Files of a corpus with their frontmatter, ``import_status`` and document name."""
    docs = importable(parse_frontmatter(split_frontmatter(files)))
    return docs.withColumn("doc_name", document_name(F.col("meta"), F.col("stem")))


def previous_import(docs: DataFrame) -> DataFrame:
    scheme, _, _ = url_parts(F.col("url"))
    return docs.filter(scheme == "http").select(
        "page_id", "filename", "meta", F.col("doc_name").alias("name"),
        document_id(F.col("doc_name"), F.col("filename")).alias("id"))


def listing_responses(docs: DataFrame) -> DataFrame:
    """``page, status, body``: the earlier import's documents, one listing page per block
    of 200 page ids (at most 200 documents per page)."""
    prev = previous_import(docs).withColumn(
        "page", (F.floor(F.col("page_id") / PAGE_IDS_PER_LISTING_PAGE) + 1).cast("int"))
    last_page = prev.agg(F.max("page")).first()[0] or 0
    per_page = prev.groupBy("page").agg(
        F.array_sort(F.collect_list(F.struct("page_id", "id", "name"))).alias("docs"))
    data = F.transform("docs", lambda d: F.struct(d["id"].alias("id"), d["name"].alias("name")))
    body = F.to_json(F.struct(data.alias("data"), (F.col("page") < last_page).alias("has_more")))
    return per_page.select("page", F.lit(200).alias("status"), body.alias("body"))


def registry_responses(docs: DataFrame) -> DataFrame:
    """``status, body``: one registry response listing the earlier run's fields."""
    keys = (previous_import(docs).select(F.explode(F.map_keys("meta")).alias("name"))
            .filter(F.col("name") != "language").distinct())
    typed = keys.select(F.struct(field_id(F.col("name")).alias("id"), "name", F.when(
        F.col("name") == "crawl_date", "time").otherwise("string").alias("type")).alias("f"))
    return typed.agg(F.to_json(F.struct(F.array_sort(F.collect_list("f")).alias("doc_metadata")))
                     .alias("body")).select(F.lit(200).alias("status"), "body")


def import_plan(spark: SparkSession, sf_dir: str, skip_existing: bool = False):
    docs = corpus_docs(spark, sf_dir)
    listing = read_document_listing(listing_responses(docs))
    plan = plan_upsert(docs.filter(F.col("import_status").isNull()),
                       existing_documents(listing), skip_existing)
    return docs, listing, plan


# ---- SQL twins -------------------------------------------------------------------------------

_TITLE_CUT = "(CASE WHEN length(l.title) > 150 THEN left(l.title, 147) || '...' ELSE l.title END)"
_DOCS_SQL = f"""
  SELECT l.page_id, l.filename, l.title, {_TITLE_CUT} || ' ({CRAWL_DATE})' AS doc_name,
         d.url, d.domain, d.language, d.markdown
  FROM ({_LATEST_RENDERED_SQL}) l JOIN ({_DOC_SQL}) d ON l.page_id = d.page_id
  WHERE l.title NOT IN (SELECT title FROM ({_LATEST_RENDERED_SQL}) x GROUP BY title HAVING count(*) > 1)"""
_DOCID = "left(sha256('doc|' || doc_name || '|' || filename), 32)"
_LISTING_SQL = f"""
  SELECT CAST(page_id // 200 + 1 AS INTEGER) AS page,
         row_number() OVER (PARTITION BY page_id // 200 ORDER BY page_id) AS pos,
         doc_name AS name, {_DOCID} AS id
  FROM ({_DOCS_SQL}) d WHERE lower(regexp_extract(url, {sql_lit(URL_RX)}, 1)) = 'http'"""
_EXISTING_FIELDS_SQL = f"""
  SELECT name, left(sha256('field|' || name), 32) AS field_id,
         CASE WHEN name = 'crawl_date' THEN 'time' ELSE 'string' END AS type
  FROM (SELECT DISTINCT unnest(regexp_extract_all(split_part(text, chr(10) || '---' || chr(10), 1), '([a-z_]+): "', 1)) AS name
        FROM ({_LATEST_RENDERED_SQL}) l JOIN ({_DOCS_SQL}) d USING (page_id)
        WHERE lower(regexp_extract(d.url, {sql_lit(URL_RX)}, 1)) = 'http') k WHERE name <> 'language'"""
_REGISTRY_SQL = f"""
  SELECT name, field_id, type, 'existing' AS action FROM ({_EXISTING_FIELDS_SQL}) e
  UNION ALL SELECT name, left(sha256('field|' || name), 32), type, 'create'
  FROM (VALUES ('source_url', 'string'), ('domain', 'string'), ('crawl_date', 'time'), ('description', 'string'),
        ('language', 'string')) r(name, type) WHERE name NOT IN (SELECT name FROM ({_EXISTING_FIELDS_SQL}) e)"""
_PLAN_SQL = f"""
  SELECT d.filename, d.doc_name, CASE WHEN l.id IS NULL THEN 'create' ELSE 'replace' END AS action,
         l.id AS old_id, left(sha256('doc|' || d.doc_name || '|' || d.filename || coalesce('|' || l.id, '')), 32) AS new_id
  FROM ({_DOCS_SQL}) d LEFT JOIN ({_LISTING_SQL}) l ON d.doc_name = l.name"""


@register("importable", f"""
  SELECT filename, CASE WHEN {sql_strip('markdown')} = '' THEN 'blank' END AS import_status
  FROM ({_DOCS_SQL}) d""")
def q_importable(spark, sf_dir):
    return corpus_docs(spark, sf_dir).select("filename", "import_status")


@register("document_name", f"SELECT filename, doc_name FROM ({_DOCS_SQL}) d")
def q_document_name(spark, sf_dir):
    return corpus_docs(spark, sf_dir).select("filename", "doc_name")


@register("document_listing", _LISTING_SQL)
def q_document_listing(spark, sf_dir):
    return read_document_listing(listing_responses(corpus_docs(spark, sf_dir)))


@register("field_listing", _EXISTING_FIELDS_SQL)
def q_field_listing(spark, sf_dir):
    return read_field_registry(registry_responses(corpus_docs(spark, sf_dir)))


@register("registry_plan", _REGISTRY_SQL)
def q_registry_plan(spark, sf_dir):
    existing = read_field_registry(registry_responses(corpus_docs(spark, sf_dir)))
    return reconcile_registry(existing, include_language=True)


@register("metadata_assign", f"""
  WITH d AS ({_DOCS_SQL}), r AS ({_REGISTRY_SQL}),
  e AS (
    SELECT filename, 'title' AS name, title AS value, 1 AS ord FROM d
    UNION ALL SELECT filename, 'source_url', url, 2 FROM d
    UNION ALL SELECT filename, 'domain', domain, 3 FROM d
    UNION ALL SELECT filename, 'crawl_date', '{CRAWL_DATE}', 4 FROM d
    UNION ALL SELECT filename, 'description', '', 5 FROM d
    UNION ALL SELECT filename, 'language', language, 6 FROM d WHERE language <> '')
  SELECT e.filename, r.field_id, e.name, e.value, e.ord FROM e JOIN r ON e.name = r.name""")
def q_metadata_assign(spark, sf_dir):
    docs = corpus_docs(spark, sf_dir)
    registry = reconcile_registry(read_field_registry(registry_responses(docs)), True)
    return assign_metadata(docs.filter(F.col("import_status").isNull()), registry)


@register("existing_lookup", f"SELECT name, id FROM ({_LISTING_SQL}) l")
def q_existing_lookup(spark, sf_dir):
    return existing_documents(read_document_listing(listing_responses(corpus_docs(spark, sf_dir))))


@register("upsert_plan", f"SELECT filename, doc_name, action, old_id, new_id FROM ({_PLAN_SQL}) p")
def q_upsert_plan(spark, sf_dir):
    _, _, plan = import_plan(spark, sf_dir)
    return plan.select("filename", "doc_name", "action", "old_id", "new_id")


@register("upsert_apply", f"""
  SELECT name, id FROM ({_LISTING_SQL}) l
  WHERE id NOT IN (SELECT old_id FROM ({_PLAN_SQL}) p WHERE action = 'replace')
  UNION ALL SELECT doc_name AS name, new_id AS id FROM ({_PLAN_SQL}) p""")
def q_upsert_apply(spark, sf_dir):
    _, listing, plan = import_plan(spark, sf_dir)
    return apply_upsert(listing, plan)


@register("import_summary", f"""
  SELECT count(*) FILTER (WHERE {sql_strip('markdown')} <> '') AS successful,
         count(*) FILTER (WHERE {sql_strip('markdown')} = '') AS failed
  FROM ({_DOCS_SQL}) d""")
def q_import_summary(spark, sf_dir):
    docs, listing, _ = import_plan(spark, sf_dir)
    plan = plan_upsert(docs, existing_documents(listing))
    return import_summary(plan)
