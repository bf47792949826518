"""Catalog of named queries (one per operator of the inventory) and their SQL oracles.

Plan modules register a builder ``fn(spark, sf_dir) -> DataFrame`` under a key, with the
equivalent DuckDB SQL when the operation can be stated in SQL.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sitecorpus.session import ensure_checkpoint_dir, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            ensure_checkpoint_dir(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every plan module so that its queries are registered."""
    from sitecorpus.plans import corpus, crawl, frontier, jobs, knowledge, live, published, search  # noqa: F401
