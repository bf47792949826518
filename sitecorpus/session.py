"""Session construction and shared-folder helpers."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the library relies on: AQE for runtime coalescing and skew-join
# splitting, UTC so Unix-second columns render the same everywhere, Arrow for the few
# pandas UDFs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sitecorpus", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` and ``shuffle_partitions`` stay None so spark-submit decides; tests
    pass ``local[N]`` and a few partitions.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """One of the session's settings for a while."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster names it; where it is unset, a scratch folder is made in local mode only
    (one process), and a cluster is refused: its executors do not share such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="sitecorpus-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder, as Spark names it."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)


def posix_path(path: str) -> str:
    """The plain path of a ``file:`` URI or plain path, for writers in Python; any other store is
    refused (``open`` would make a local folder named after its scheme)."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path):
        raise ValueError(f"not a path that Python can write to: {path}")
    return path


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``sitecorpus`` importable by the Python workers (pandas UDFs, mapInPandas):
    zip the package once per process and ``addPyFile`` it, as ``--py-files`` would."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:") or base.startswith("/"):
        folder = os.path.join(posix_path(shared_path(spark, "py")), key)
        os.makedirs(folder, exist_ok=True)
    else:  # a non-POSIX shared store: build the zip on the driver, Spark ships it
        folder = tempfile.mkdtemp(prefix="sitecorpus-py-")
    out = os.path.join(folder, "sitecorpus.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(key)
