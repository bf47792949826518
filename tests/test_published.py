"""Published folders, snapshot tables and duplicate statistics kept run by run."""

import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from sitecorpus.operators.duplicates import duplicate_titles
from sitecorpus.operators.upsert import apply_upsert
from sitecorpus.session import shared_path
from sitecorpus.sinks.snapshots import Conflict, DuplicateCounts, SnapshotTable, upsert_snapshot
from sitecorpus.sources.folders import FileFolder, publish_markdown, read_folder, stream_folder


def _pages(spark, rows):
    return spark.createDataFrame(rows, "filename string, text string").repartition(3)


def _seen(spark, path):
    return {r.filename: bytes(r.content).decode() for r in read_folder(spark, path).collect()}


def _files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(path) for f in names)


def test_versions_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "out")
    publish_markdown(_pages(spark, [("a.md", "one"), ("_b.md", ""), (".c.md", None), ("d:e.md", "ü")]), path)
    assert _seen(spark, path) == {"a.md": "one", "_b.md": "", ".c.md": "", "d:e.md": "ü"}
    publish_markdown(_pages(spark, [("a.md", "two"), ("f.md", "x")]), path)
    assert _seen(spark, path) == {"a.md": "two", "_b.md": "", ".c.md": "", "d:e.md": "ü", "f.md": "x"}
    publish_markdown(_pages(spark, [("g.md", "only")]), path, mode="overwrite")
    assert _seen(spark, path) == {"g.md": "only"}
    publish_markdown(_pages(spark, []), path, mode="overwrite")
    assert _seen(spark, path) == {}


def test_aborted_write_leaves_no_file(spark, tmp_path):
    path = str(tmp_path / "out")
    publish_markdown(_pages(spark, [("a.md", "one")]), path)
    before = _files(path)
    for bad in ("no/name.md", "", "..", None):  # some tasks write before another fails
        with pytest.raises(Exception):
            publish_markdown(_pages(spark, [(f"x{i}.md", "t") for i in range(30)] + [(bad, "u")]), path)
        assert _files(path) == before and _seen(spark, path) == {"a.md": "one"}


def test_a_version_is_published_once(spark, tmp_path):
    first, second = (FileFolder({"path": str(tmp_path / "o")}).writer(None, False) for _ in range(2))
    written = [w.write(iter([{"filename": f"{i}.md", "text": "t"}])) for i, w in enumerate((first, second))]
    assert not os.path.exists(tmp_path / "o" / "_versions")  # nothing to see yet
    first.commit(written[:1])
    assert _seen(spark, str(tmp_path / "o")) == {"0.md": "t"}
    second.commit(written[1:] + [None])
    assert _seen(spark, str(tmp_path / "o")) == {"0.md": "t", "1.md": "t"}


def test_plain_folder_is_put_together(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"p{i}.md").write_bytes(b"x" * (i * 10))
    (tmp_path / "other.txt").write_text("no")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "deep.md").write_text("no")
    spark.dataSource.register(FileFolder)
    for most, parts in ((10 ** 9, 1), (2000, 5)):
        df = spark.read.format("file_folder").option("partition_bytes", most).load(str(tmp_path))
        rows = df.select("filename", F.length("content").alias("n"), F.spark_partition_id().alias("p")).collect()
        assert {r.filename: r.n for r in rows} == {f"p{i}.md": i * 10 for i in range(40)}
        assert len({r.p for r in rows}) == parts
    assert spark.read.format("file_folder").option("suffix", ".txt").load(str(tmp_path)).count() == 1
    with pytest.raises(Exception):
        spark.read.format("file_folder").load("s3://bucket/x").count()


def test_stream_takes_each_version_once(spark, tmp_path):
    path, out = str(tmp_path / "out"), str(tmp_path / "read")

    def drain():
        q = (stream_folder(spark, path).select("filename", "version").writeStream.format("parquet")
             .option("checkpointLocation", str(tmp_path / "c")).option("path", out).trigger(availableNow=True).start())
        q.awaitTermination()
        return sorted(map(tuple, spark.read.parquet(out).collect()))
    publish_markdown(_pages(spark, [("a.md", "1"), ("b.md", "2")]), path)
    publish_markdown(_pages(spark, [("a.md", "3")]), path)
    assert drain() == [("a.md", 1), ("a.md", 2), ("b.md", 1)]
    assert len(drain()) == 3
    publish_markdown(_pages(spark, [("c.md", "4")]), path)
    assert drain() == [("a.md", 1), ("a.md", 2), ("b.md", 1), ("c.md", 3)]


def _table(spark, schema="name string, id string", key="name"):
    return SnapshotTable(spark, shared_path(spark, "snapshot-test", uuid.uuid4().hex), schema, key, buckets=8)


def test_upsert_rewrites_touched_buckets_only(spark):
    rng = random.Random(1)
    known = _table(spark)
    listed = spark.createDataFrame([(f"n{i % 70}", f"id{i}") for i in range(100)] + [(None, "none")], "name string, id string")
    assert known.read().collect() == [] and known.rewrite(listed.limit(0), lambda r: r) == 0
    known.rewrite(listed, lambda _: listed)
    want = listed
    for step in range(3):
        names = rng.sample([f"n{i}" for i in range(90)], 2)
        ids = {r.name: r.id for r in want.collect()}
        plan = spark.createDataFrame([(n, "replace" if n in ids else "create", ids.get(n), f"new{step}{n}") for n in names]
                                     + [("n1", "skip", "id1", "id1")], "doc_name string, action string, old_id string, new_id string")
        before, at = known.places(), known.version()
        assert upsert_snapshot(known, plan) == at + 1
        touched = {r[0] for r in plan.filter("action <> 'skip'").select(known.bucket("doc_name")).collect()}
        after = known.places()
        assert all(after[b] == p for b, p in before.items() if b not in touched)
        assert all(after[b] != before.get(b) for b in touched) and len(touched) < 8
        want = spark.createDataFrame(apply_upsert(want, plan).select("name", "id").collect(), "name string, id string")
        assert sorted(map(str, known.read().collect())) == sorted(map(str, want.collect()))
        assert sorted(map(str, known.read(at).collect())) != sorted(map(str, want.collect()))  # the old snapshot stays readable


def test_second_writer_of_a_snapshot_fails(spark):
    known = _table(spark)
    rows = spark.createDataFrame([("a", "1")], "name string, id string")

    def slow(_):
        known.rewrite(rows, lambda r: rows)  # another writer, meanwhile
        return rows.withColumn("id", F.lit("lost"))
    with pytest.raises(Conflict):
        known.rewrite(rows, slow)
    assert [tuple(r) for r in known.read().collect()] == [("a", "1")]
    known.rewrite(rows, lambda r: r.limit(0))
    assert known.read().collect() == []


def test_duplicate_counts_after_each_run(spark):
    rng, now = random.Random(2), {}
    counts = DuplicateCounts(spark, shared_path(spark, "counts-test", uuid.uuid4().hex), buckets=4)
    for run in range(5):
        pages = {f"p{rng.randrange(40)}": rng.choice(["", None, *[f"T {i}" for i in range(12)]]) for _ in range(15)}
        counts.add(spark.createDataFrame(list(pages.items()), "filename string, title_key string"))
        now |= pages
        whole = spark.createDataFrame([(f, t, 0) for f, t in now.items()], "filename string, title_key string, url_index long")
        want = duplicate_titles(whole).select("title", "total_files", "moved_files", "folder").collect()
        assert sorted(map(tuple, counts.repeated().collect())) == sorted(map(tuple, want)), run
    assert {r.filename: r.title_key for r in counts.names.read().collect()} == now
