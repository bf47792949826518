"""Published snapshots of a keyed table.

Rows lie in buckets by a hash of their key. A snapshot names, for each bucket, the folder that holds it; an
update writes only the buckets it touches, as one folder with a partition per bucket, and then publishes a new
snapshot that points to them and, for all others, to the folders of before. Publishing is one
rename of a small file, so a reader sees the old table or the new one; of two writers
that began at one snapshot the second fails (where a rename replaces nothing, as on HDFS; elsewhere a
moment stays between the look and the rename). Folders may lie in any store that Spark writes to."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

SNAPSHOTS = "_snapshots"


class Conflict(RuntimeError):
    """Another writer published a snapshot first."""


class SnapshotTable:
    """A table below ``path`` with one or more rows a ``key`` in ``buckets`` buckets (a constant of the
    table: the number of entries of a snapshot)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, buckets: int = 64):
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path, schema, key, buckets
        self.fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, *parts))

    def bucket(self, key=None):
        """The bucket of a row (null keys have one too)."""
        return F.pmod(F.xxhash64(F.col(key or self.key)), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """The number of the last published snapshot; 0 before the first."""
        if not self.fs.exists(self._at(SNAPSHOTS)):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(self._at(SNAPSHOTS))]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def places(self, version: int | None = None) -> dict[int, str]:
        """Bucket to folder (below the table's path) in a snapshot."""
        version = self.version() if version is None else version
        if not version:
            return {}
        stream = self.fs.open(self._at(SNAPSHOTS, str(version)))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return {int(b): p for b, p in json.loads(text).items()}

    def read(self, version: int | None = None, only: set[int] | None = None) -> DataFrame:
        """The rows of a snapshot (the last one), or of some of its buckets."""
        places = self.places(version)
        paths = [os.path.join(self.path, p) for b, p in sorted(places.items()) if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rewrite(self, touched: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        """Publish the table with ``change`` applied to the buckets of the keys in ``touched`` (rows with
        the key column). ``change`` takes the rows of those buckets and returns their new rows. Returns
        the number of the new snapshot, or of the present one if nothing is touched."""
        version = self.version()
        old = self.places(version)
        buckets = {r[0] for r in touched.select(self.bucket()).distinct().collect()}  # at most ``buckets``
        if not buckets:
            return version
        rows = change(self.read(version, buckets)).withColumn("bucket", self.bucket())
        folder = f"data-{uuid.uuid4().hex}"
        # a heavy bucket is split by Spark's rebalancing, so a key with very many rows is written by many tasks
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(os.path.join(self.path, folder))
        names = {s.getPath().getName() for s in self.fs.listStatus(self._at(folder))}
        new = {b: p for b, p in old.items() if b not in buckets}
        new |= {b: f"{folder}/bucket={b}" for b in buckets if f"bucket={b}" in names}  # the rest are empty now
        self._publish(version + 1, new)
        return version + 1

    def _publish(self, version: int, places: dict[int, str]) -> None:
        target, draft = self._at(SNAPSHOTS, str(version)), self._at(f"draft-{uuid.uuid4().hex}")
        self.fs.mkdirs(self._at(SNAPSHOTS))
        stream = self.fs.create(draft, False)
        stream.write(bytearray(json.dumps(places), "utf-8"))
        stream.close()
        # a rename does not replace a file that is there: whoever comes second fails
        if self.fs.exists(target) or not self.fs.rename(draft, target):
            self.fs.delete(draft, False)
            raise Conflict(f"snapshot {version} of {self.path} is published already")


def upsert_snapshot(table: SnapshotTable, plan: DataFrame, name_col: str = "doc_name") -> int:
    """Apply an upsert plan to a published knowledge table (name, id), keyed by name: the state that
    ``apply_upsert`` gives, but only buckets that a created or replaced name falls into are read and
    written. A replaced row has its replacement's name, so both are in one bucket."""
    from sitecorpus.operators.upsert import apply_upsert
    changed = plan.filter(F.col("action").isin("create", "replace"))
    names = changed.select(F.col(name_col).alias(table.key))
    return table.rewrite(names, lambda rows: apply_upsert(rows, changed, name_col))


class DuplicateCounts:
    """Statistics of repeated titles kept up to date run by run.

    Two snapshot tables: each file name's present title, and each title's number of files. A run looks up its own
    names, so a page that replaces one of another title counts -1 there and +1 in its own; the sums of
    these deltas are merged into the touched titles' buckets. The work grows with the run, not with the
    corpus."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.names = SnapshotTable(spark, os.path.join(path, "names"), "filename string, title_key string", "filename", buckets)
        self.counts = SnapshotTable(spark, os.path.join(path, "counts"), "title_key string, total_files long", "title_key", buckets)

    def add(self, run: DataFrame) -> None:
        """A run's pages (filename, title_key), one a name (see ``latest_pages``)."""
        from sitecorpus.plans.sizing import materialize
        new = run.select("filename", "title_key")
        buckets = {r[0] for r in new.select(self.names.bucket()).distinct().collect()}
        before = self.names.read(only=buckets).join(new.select("filename"), "filename", "left_semi")
        steps = new.select("title_key", F.lit(1).alias("d")).unionByName(before.select("title_key", F.lit(-1).alias("d")))
        # written first: names and counts are published one after the other from the same deltas
        deltas = materialize(steps.groupBy("title_key").agg(F.sum("d").alias("d")).filter("d <> 0"), "title-deltas")
        self.names.rewrite(new, lambda rows: rows.join(new, "filename", "left_anti").unionByName(new))
        self.counts.rewrite(deltas, lambda rows: rows.unionByName(deltas.select("title_key", F.col("d").alias("total_files")))
                            .groupBy("title_key").agg(F.sum("total_files").alias("total_files")).filter("total_files > 0"))

    def repeated(self) -> DataFrame:
        """``title, total_files, moved_files, folder`` of the titles with more than one file, as
        ``duplicate_titles`` gives them. Pages without a usable title are never duplicates."""
        from sitecorpus.functions.text import slug
        rows = self.counts.read().filter("title_key IS NOT NULL AND total_files > 1")
        return rows.select(F.col("title_key").alias("title"), "total_files", F.col("total_files").alias("moved_files"),
                           slug("title_key").alias("folder"))
