"""Read a directory of markdown files (one record per ``*.md`` directly inside it)."""

from __future__ import annotations

import logging

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from sitecorpus.operators.frontmatter import normalize_newlines
from sitecorpus.session import setting

PART_BYTES = 4 << 20  # of file contents that a worker holds, about
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
STATUS_CACHE = "spark.sql.hive.filesourcePartitionFileCacheSize"


def listed_once(spark: SparkSession):
    """Spark keeps what it has listed for a second look by the same reader, up to 250 MB of the driver's memory.
    A reader of files of a page each looks once, and there are many."""
    return setting(spark, STATUS_CACHE, "0")


def read_markdown_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``path, filename, stem, raw, error`` for every ``*.md`` file directly in ``path``.

    Sub-folders (such as ``duplicates/``) are not read. Bytes that are not valid UTF-8 give
    ``raw = null`` and ``error = 'invalid_utf8'``. Note: Spark's file listing skips
    zero-byte files, which the original tool would have kept as empty records (they are
    skipped later as blank anyway), takes names that begin with ``_`` or ``.`` for hidden files,
    and refuses names with ``:``. A corpus written by ``export_markdown`` is therefore read from its
    manifest, see :func:`read_exported_corpus`.
    """
    parts = [p for p in path.replace("\\", "/").split("/") if p]
    if "duplicates" in parts:
        raise ValueError("corpus path lies inside a duplicates folder; nothing would import")
    try:
        with listed_once(spark):
            files = (spark.read.format("binaryFile")
                     .option("pathGlobFilter", "*.md")
                     .option("recursiveFileLookup", "false")
                     .load(path))
    except AnalysisException as ex:
        if "PATH_NOT_FOUND" not in str(ex):
            raise
        logging.getLogger(__name__).warning("corpus folder not found: %s", path)
        files = spark.createDataFrame([], BINARY_FILE_SCHEMA)
    # Spark packs some 32 small files into a partition, so a large corpus is mostly starts of tasks
    n = files.rdd.getNumPartitions()
    return markdown_records(files.coalesce(max(4 * spark.sparkContext.defaultParallelism, n // 16)))


def read_exported_corpus(manifest: DataFrame) -> DataFrame:
    """The records of :func:`read_markdown_corpus` for the files that a manifest of
    ``export_markdown`` lists, whatever their names; names without a file are left out. The folder
    is one that all executors mount. Contents leave the worker in parts of some ``PART_BYTES``, however many
    files a batch of the manifest names."""
    def load(batches):
        def part():
            return pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(contents, pa.binary())], names=["path", "content"])
        for batch in batches:
            paths, contents, size = [], [], 0
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as fh:
                    contents.append(fh.read())
                paths.append(path)
                size += len(contents[-1])
                if size >= PART_BYTES:
                    yield part()
                    paths, contents, size = [], [], 0
            if paths:
                yield part()

    written = manifest.filter(F.col("error").isNull()).select("path")
    return markdown_records(written.mapInArrow(load, "path string, content binary"))


def read_markdown_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Streaming twin of :func:`read_markdown_corpus`: new ``*.md`` files as they land. A listing serves all
    micro-batches whose files it found, and a task reads several hundred files."""
    with listed_once(spark):
        files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
                 .option("pathGlobFilter", "*.md").option("maxFilesPerTrigger", files_per_batch)
                 .option("maxCachedFiles", 10_000_000).option("discardCachedInputRatio", 0.0).load(path))
    tasks = max(4 * spark.sparkContext.defaultParallelism, files_per_batch // 512)
    return markdown_records(files.coalesce(tasks))


def markdown_records(files: DataFrame) -> DataFrame:
    """binaryFile rows → ``path, filename, stem, raw, error`` (text-mode UTF-8 decoding)."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    stem = F.when(name.rlike(r"^.+\.[^.]+$"), F.regexp_extract(name, r"^(.+)\.[^.]+$", 1)) \
        .otherwise(name)
    valid = F.is_valid_utf8("content")
    raw = F.when(valid, normalize_newlines(F.decode("content", "UTF-8")))
    return files.select(
        "path", name.alias("filename"), stem.alias("stem"), raw.alias("raw"),
        F.when(~valid, F.lit("invalid_utf8")).alias("error"),
    )
