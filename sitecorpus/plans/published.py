"""Published folders and tables: the file-folder source, the knowledge table's snapshots and the duplicate
statistics that are kept run by run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from sitecorpus.functions.text import sql_slug
from sitecorpus.operators.duplicates import latest_pages, with_title_key
from sitecorpus.plans.catalog import ORACLES, register, table
from sitecorpus.plans.corpus import _RENDERED_SQL, rendered_pages
from sitecorpus.plans.crawl import _PAGE_SQL, page_records
from sitecorpus.plans.frontier import _SITEMAP_SQL, sitemap_files
from sitecorpus.plans.knowledge import import_plan
from sitecorpus.plans.sizing import materialize
from sitecorpus.session import shared_path
from sitecorpus.sinks.snapshots import DuplicateCounts, SnapshotTable, upsert_snapshot
from sitecorpus.sources.corpus import markdown_records
from sitecorpus.sources.folders import publish_markdown, read_folder
from sitecorpus.sources.sitemaps import parse_sitemaps

RUNS = 5


@register("publish_folder", f"""
  SELECT filename, text AS raw FROM ({_RENDERED_SQL}) r
  QUALIFY row_number() OVER (PARTITION BY filename ORDER BY page_id % 2 DESC, url_index DESC) = 1""")
def q_publish_folder(spark, sf_dir):
    """Two crawl runs published one after the other and read back, the later run's page of a name."""
    path = shared_path(spark, "published", uuid.uuid4().hex)
    pages = materialize(rendered_pages(spark, sf_dir).select("page_id", "url_index", "filename", "text"), "rendered")
    for run in (0, 1):
        publish_markdown(latest_pages(pages.filter(F.col("page_id") % 2 == run)), path)
    return markdown_records(read_folder(spark, path)).select("filename", "raw")


@register("sitemap_folder", f"SELECT file, pos, url FROM ({_SITEMAP_SQL}) s")
def q_sitemap_folder(spark, sf_dir):
    """The sitemaps published as files, read by the same source and parsed."""
    path = shared_path(spark, "published", uuid.uuid4().hex)
    files = materialize(sitemap_files(table(spark, sf_dir, "pages")), "sitemaps")
    name = F.concat(F.sha2("file", 256), F.lit(".xml"))
    publish_markdown(files.select(name.alias("filename"), F.col("xml").alias("text")), path)
    read = read_folder(spark, path, suffix=".xml").select("filename", F.col("content").alias("xml"))
    return parse_sitemaps(read.join(files.select("file", name.alias("filename")), "filename").select("file", "xml"))


@register("snapshot_upsert", ORACLES["upsert_apply"])
def q_snapshot_upsert(spark, sf_dir):
    """The listed documents as a published table, and the import applied to the buckets it touches."""
    _, listing, plan = import_plan(spark, sf_dir)
    known = SnapshotTable(spark, shared_path(spark, "snapshots", uuid.uuid4().hex), "name string, id string", "name", buckets=16)
    listed = listing.select("name", "id")
    known.rewrite(listed, lambda _: listed)
    upsert_snapshot(known, plan)
    return known.read()


@register("duplicate_counts", f"""
  SELECT title, count(*) AS total_files, count(*) AS moved_files, {sql_slug('title')} AS folder FROM (
    SELECT * FROM ({_PAGE_SQL}) p QUALIFY row_number() OVER (PARTITION BY filename ORDER BY page_id % {RUNS} DESC, url_index DESC) = 1) l
  GROUP BY title HAVING count(*) > 1""")
def q_duplicate_counts(spark, sf_dir):
    """Duplicate statistics after five crawl runs, updated by each."""
    pages = page_records(table(spark, sf_dir, "pages")).select("page_id", "url_index", "filename", "title")
    keyed = materialize(with_title_key(pages, title_col="title", stem_col="filename"), "titles")
    counts = DuplicateCounts(spark, shared_path(spark, "counts", uuid.uuid4().hex), buckets=16)
    for run in range(RUNS):
        counts.add(latest_pages(keyed.filter(F.col("page_id") % RUNS == run)).select("filename", "title_key"))
    return counts.repeated()
