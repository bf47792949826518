"""Written intermediates.

Joins are left to Spark: adaptive execution broadcasts a side by its measured bytes and splits
skewed partitions, so no operator counts rows to choose a plan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from sitecorpus.session import shared_path


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back: cuts the
    lineage (a lost executor re-reads files instead of recomputing) and lets several
    branches share one computation. Columnar files are much cheaper than RDD checkpoints."""
    path = shared_path(df.sparkSession, "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
