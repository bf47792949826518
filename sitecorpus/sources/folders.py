"""A data source for folders of many small files: sitemaps, and markdown pages that are published whole.

``spark.read.format("file_folder").load(path)`` plans its own partitions: files are put together up to
``partition_bytes`` of content (option), so a million small files are some hundred tasks, not a listing by
Spark, and empty files and names that begin with ``_`` or ``.`` or hold ``:`` are read as well.

``df.write.format("file_folder").mode(...).save(path)`` takes (filename, text) rows. Tasks write below a folder
of their own, with a list of what they wrote; the driver's commit publishes all of it by creating one small
file. Until then a reader sees nothing of it, an aborted write is removed, and what a lost task left behind is in
no list. ``append`` adds a version, ``overwrite`` starts anew.

``spark.readStream.format("file_folder")`` has the published versions as offsets.

A folder without published versions is read as it lies there (option ``suffix``, ``.md`` if not given). The path
is one that all executors mount, as for every writer of single files."""

from __future__ import annotations

import dataclasses
import json
import os
import shutil
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage,
)

from sitecorpus.session import posix_path

VERSIONS = "_versions"
SCHEMA = "path string, filename string, version long, content binary"
PARTITION_BYTES = 32 << 20
FILES = 10_000     # of a partition or a list, at most
BATCH_BYTES = 8 << 20


@dataclasses.dataclass
class Files(InputPartition):
    """Files of a partition: names in a folder, or a written list of them."""

    folder: str
    version: int
    names: list | None = None
    listed: str | None = None


@dataclasses.dataclass
class Written(WriterCommitMessage):
    lists: list


def _versions(root: str) -> list[tuple[int, dict]]:
    """Published versions in order."""
    try:
        names = sorted(int(n) for n in os.listdir(os.path.join(root, VERSIONS)) if n.isdigit())
    except FileNotFoundError:
        return []
    out = []
    for n in names:
        with open(os.path.join(root, VERSIONS, str(n)), encoding="utf-8") as fh:
            out.append((n, json.load(fh)))
    return out


def _lists(root: str, versions: list[tuple[int, dict]]) -> list[Files]:
    return [Files(os.path.join(root, v["folder"]), n, listed=os.path.join(root, v["folder"], name)) for n, v in versions for name in v["lists"]]


def _read(part: Files) -> Iterator[pa.RecordBatch]:
    names = part.names
    if names is None:
        with open(part.listed, encoding="utf-8") as fh:
            names = [json.loads(line) for line in fh]
    paths, contents, size = [], [], 0

    def batch():
        return pa.RecordBatch.from_arrays(
            [pa.array([os.path.join(part.folder, n) for n in paths], pa.string()), pa.array(paths, pa.string()),
             pa.array([part.version] * len(paths), pa.int64()), pa.array(contents, pa.binary())],
            names=["path", "filename", "version", "content"])
    for name in names:
        with open(os.path.join(part.folder, name), "rb") as fh:
            contents.append(fh.read())
        paths.append(name)
        size += len(contents[-1])
        if size >= BATCH_BYTES:
            yield batch()
            paths, contents, size = [], [], 0
    if paths:
        yield batch()


class FolderReader(DataSourceReader):
    def __init__(self, root: str, suffix: str, most: int):
        self.root, self.suffix, self.most = root, suffix, most

    def partitions(self) -> list[Files]:
        versions = _versions(self.root)
        if versions:
            start = max((i for i, (_, v) in enumerate(versions) if v["overwrite"]), default=0)
            return _lists(self.root, versions[start:]) or [Files(self.root, 0, names=[])]
        out, names, size = [], [], 0
        with os.scandir(self.root) as entries:
            files = sorted((e.name, e.stat().st_size) for e in entries if e.is_file() and e.name.endswith(self.suffix))
        for name, n in files:
            if names and (size + n > self.most or len(names) >= FILES):
                out.append(Files(self.root, 0, names=names))
                names, size = [], 0
            names.append(name)
            size += n
        return [*out, Files(self.root, 0, names=names)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _read(partition)


class FolderStream(DataSourceStreamReader):
    """An offset is the number of the last version that was read."""

    def __init__(self, root: str):
        self.root = root

    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": max((n for n, _ in _versions(self.root)), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Files]:
        some = [(n, v) for n, v in _versions(self.root) if start["version"] < n <= end["version"]]
        return _lists(self.root, some) or [Files(self.root, 0, names=[])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return _read(partition)

    def commit(self, end: dict) -> None:
        pass  # versions stay for other readers


class FolderWriter(DataSourceWriter):
    def __init__(self, root: str, overwrite: bool):
        self.root, self.overwrite, self.folder = root, overwrite, f"v-{uuid.uuid4().hex}"

    def write(self, rows: Iterator) -> Written:
        folder = os.path.join(self.root, self.folder)
        os.makedirs(folder, exist_ok=True)
        lists, names = [], []

        def close():
            lists.append(f"_list-{uuid.uuid4().hex}")
            with open(os.path.join(folder, lists[-1]), "x", encoding="utf-8") as fh:
                fh.writelines(json.dumps(n) + "\n" for n in names)
        for row in rows:
            name = row["filename"]
            if not name or os.path.basename(name) != name or name in (".", ".."):
                raise ValueError(f"not a file name: {name!r}")
            draft = os.path.join(folder, f"_draft-{uuid.uuid4().hex}")
            with open(draft, "wb") as fh:
                fh.write((row["text"] or "").encode("utf-8"))
            os.replace(draft, os.path.join(folder, name))  # a task that runs twice writes the same file
            names.append(name)
            if len(names) >= FILES:
                close()
                names = []
        if names:
            close()
        return Written(lists)

    def commit(self, messages: list) -> None:
        number = max((n for n, _ in _versions(self.root)), default=0) + 1
        os.makedirs(os.path.join(self.root, VERSIONS), exist_ok=True)
        draft = os.path.join(self.root, f"{VERSIONS}-{uuid.uuid4().hex}")
        with open(draft, "x", encoding="utf-8") as fh:
            json.dump({"folder": self.folder, "overwrite": self.overwrite, "lists": [x for m in messages if m for x in m.lists]}, fh)
            fh.flush()
            os.fsync(fh.fileno())
        try:
            os.link(draft, os.path.join(self.root, VERSIONS, str(number)))  # fails if another writer was first
        finally:
            os.remove(draft)

    def abort(self, messages: list) -> None:
        shutil.rmtree(os.path.join(self.root, self.folder), ignore_errors=True)


class FileFolder(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_folder"

    def schema(self) -> str:
        return SCHEMA

    @property
    def root(self) -> str:
        if not self.options.get("path"):
            raise ValueError("file_folder needs a path")
        return posix_path(self.options["path"])

    def reader(self, schema) -> FolderReader:
        return FolderReader(self.root, self.options.get("suffix", ".md"), int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def streamReader(self, schema) -> FolderStream:
        return FolderStream(self.root)

    def writer(self, schema, overwrite: bool) -> FolderWriter:
        return FolderWriter(self.root, overwrite)


def publish_markdown(pages: DataFrame, path: str, name_col: str = "filename", text_col: str = "text", mode: str = "append") -> None:
    """Publish pages (one a name, see ``latest_pages``) as files below ``path``: all of them or none."""
    pages.sparkSession.dataSource.register(FileFolder)
    pages.selectExpr(f"`{name_col}` AS filename", f"`{text_col}` AS text").write.format("file_folder").mode(mode).save(path)


def read_folder(spark: SparkSession, path: str, **options) -> DataFrame:
    """``path, filename, version, content`` of a folder's files; of a name in several versions the last."""
    from sitecorpus.operators.duplicates import latest_pages
    spark.dataSource.register(FileFolder)
    return latest_pages(spark.read.format("file_folder").options(**options).load(path), order="version")


def stream_folder(spark: SparkSession, path: str) -> DataFrame:
    """The files of new versions, as they are published."""
    spark.dataSource.register(FileFolder)
    return spark.readStream.format("file_folder").load(path)
