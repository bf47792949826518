"""Sitemaps → ordered URL frontier.

XML parsing happens in Python (stdlib ElementTree) inside ``mapInPandas``: Spark's ``xpath``
ignores namespaces and fails the whole job on one malformed file, and the ``xml`` source
accepts un-namespaced files. Each sitemap is one row (the protocol caps a file at 50,000
URLs / 50 MB), parsing is map-only, and the output is one row per URL.
"""

from __future__ import annotations

import io
import xml.etree.ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: the sitemap protocol namespace.
SITEMAP_NS = "http://www.sitemaps.org/schemas/sitemap/0.9"
FRONTIER_SCHEMA = "file string, pos long, url string"


def _locations(data) -> list[str]:
    """Addresses of a sitemap given as bytes (any encoding the document declares) or text, read
    tag by tag; a file that is not well-formed has none."""
    raw = data.encode("utf-8") if isinstance(data, str) else bytes(data or b"")
    entry, address = (f"{{{SITEMAP_NS}}}{name}" for name in ("url", "loc"))
    found, open_entries, seen = [], 0, False
    try:
        for event, tag in ET.iterparse(io.BytesIO(raw), ("start", "end")):
            if event == "start":
                if tag.tag == entry:
                    open_entries, seen = open_entries + 1, False
            elif tag.tag == address and open_entries and not seen:
                seen = True
                if tag.text:
                    found.append(tag.text.strip())
            elif tag.tag == entry:
                open_entries -= 1
                tag.clear()
    except (ET.ParseError, ValueError, LookupError):
        return []
    return found


def parse_sitemaps(files: DataFrame, file_col: str = "file", xml_col: str = "xml") -> DataFrame:
    """``file, pos, url``: every ``url/loc`` in document order, 1-based ``pos`` per file."""
    def parse(batches):
        for pdf in batches:
            files_, pos, urls = [], [], []
            for f, x in zip(pdf[file_col], pdf[xml_col]):
                for i, u in enumerate(_locations(x), 1):
                    files_.append(f)
                    pos.append(i)
                    urls.append(u)
            if files_:  # an empty frame with object columns cannot be converted to Arrow
                yield pd.DataFrame({"file": files_, "pos": pd.Series(pos, dtype="int64"),
                                    "url": urls})

    return files.select(file_col, xml_col).mapInPandas(parse, FRONTIER_SCHEMA)


def read_sitemaps(spark: SparkSession, path: str) -> DataFrame:
    """Parse every sitemap file under ``path``, one file per row, as bytes: the XML parser reads
    the encoding that the file declares."""
    files = spark.read.format("binaryFile").load(path).select(
        F.col("path").alias("file"), F.col("content").alias("xml"))
    return parse_sitemaps(files)


def is_sitemap_seed(col) -> "F.Column":
    """A seed is a sitemap when it ends in lower-case ``.xml`` (query string included)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.endswith(".xml")


def expand_seeds(seeds: DataFrame, sitemaps: DataFrame, seed_col: str = "seed") -> DataFrame:
    """Frontier ``seed, url_index, url``: a page seed is its own single URL; a sitemap seed
    expands to the URLs of the parsed sitemap whose ``file`` equals the seed."""
    singles = (seeds.filter(~is_sitemap_seed(seed_col))
               .select(F.col(seed_col).alias("seed"), F.lit(1).cast("long").alias("url_index"),
                       F.col(seed_col).alias("url")))
    maps = seeds.filter(is_sitemap_seed(seed_col)).select(F.col(seed_col).alias("seed"))
    expanded = maps.join(sitemaps.withColumnRenamed("file", "seed"), "seed").select(
        "seed", F.col("pos").alias("url_index"), "url")
    return singles.unionByName(expanded)


def slice_frontier(frontier: DataFrame, start_index: int = 1) -> DataFrame:
    """Resume at the 1-based ``start_index`` of each seed, keeping the global numbering:
    ``seed, url_index, url, error``. A seed with fewer URLs than that is refused: one row without
    a URL, whose error is ``start_index_exceeds_total``."""
    if start_index < 1:
        raise ValueError(f"start_index must be >= 1, got {start_index}")
    kept = frontier.filter(F.col("url_index") >= start_index).select(
        "seed", "url_index", "url", F.lit(None).cast("string").alias("error"))
    refused = slice_errors(frontier, start_index).select(
        "seed", F.col("total_urls").alias("url_index"), F.lit(None).cast("string").alias("url"), "error")
    return kept.unionByName(refused)


def slice_errors(frontier: DataFrame, start_index: int) -> DataFrame:
    """Seeds whose URL count is below ``start_index`` (the original tool stops there)."""
    totals = frontier.groupBy("seed").agg(F.max("url_index").alias("total_urls"))
    return totals.filter(F.col("total_urls") < start_index).withColumn(
        "error", F.lit("start_index_exceeds_total"))
