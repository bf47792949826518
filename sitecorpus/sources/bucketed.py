"""Co-located tables: attempts (with their bodies) stored bucketed by URL, so that a crawl numbers, settles and
joins them where they lie."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from sitecorpus.session import shared_path

ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def store_bucketed(df: DataFrame, key: str, buckets: int, name: str = "bucketed") -> DataFrame:
    """``df`` written once in ``buckets`` buckets by a hash of ``key``, sorted in each, and read back as a table
    whose scans tell Spark so: grouping, numbering and joining by the key (and further columns) then need
    no exchange. A capture writes this as it records; every later run reads it in place.

    A key with very many rows lies in one bucket; take the number of buckets so that a bucket is some
    hundred megabytes."""
    table = f"{name}_{uuid.uuid4().hex}"
    (df.write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", shared_path(df.sparkSession, "tables", table)).saveAsTable(table))
    return df.sparkSession.table(table)


@contextlib.contextmanager
def by_part_of_the_key(spark: SparkSession):
    """While a job runs: a join on (url, kind, place) may use a partitioning by url alone."""
    before = spark.conf.get(ALL_KEYS)
    spark.conf.set(ALL_KEYS, "false")
    try:
        yield
    finally:
        spark.conf.set(ALL_KEYS, before)
