"""Captured reader responses (``url, body``) and fetch attempts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RESPONSE_SCHEMA = "url string, body string"
ATTEMPT_SCHEMA = ("url string, url_index long, seq int, kind string, status int, "
                  "error string, body string, started_at timestamp")


def read_responses(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """One captured JSON body per requested URL; ``fmt`` is ``parquet`` or ``json`` (lines
    with ``url`` and ``body``). The schema is given, never inferred."""
    return spark.read.schema(RESPONSE_SCHEMA).format(fmt).load(path)


def read_responses_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Streaming twin of :func:`read_responses`: captured bodies as they land."""
    return spark.readStream.schema(RESPONSE_SCHEMA).format(fmt).load(path)


def read_attempts(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(ATTEMPT_SCHEMA).format(fmt).load(path)
