"""Tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sitecorpus.plans.sizing import materialize

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1024  # rows that go to a Python worker at once, at most


def store(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below ``spark.checkpoint.dir`` and read back. That cuts the
    lineage, and the job's shuffle files are removed as soon as it has ended. Python workers and the executors'
    buffers for them hold few rows at a time, whatever the session says of batches."""
    conf = df.sparkSession.conf
    rows = int(conf.get(ROWS, "10000"))
    for_job = {CLEAN: "true", ROWS: str(min(rows, BATCH_ROWS) if rows > 0 else BATCH_ROWS)}
    before = {key: conf.get(key, None) for key in for_job}
    for key, value in for_job.items():
        conf.set(key, value)
    try:
        return materialize(df, name)
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
