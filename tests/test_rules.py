"""Rules of single operators on edge cases (FIXTURES.md)."""

import collections
import os
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from sitecorpus.functions.urls import url_domain, url_error, url_filename, url_path
from sitecorpus.operators.chunking import parents
from sitecorpus.operators.duplicates import duplicate_breakdown, route_increment
from sitecorpus.operators.html import extract_page_metadata
from sitecorpus.operators.reports import crawl_summary, failed_urls
from sitecorpus.operators.responses import resolve_attempts
from sitecorpus.operators.upsert import read_document_listing
from sitecorpus.session import posix_path
from sitecorpus.sinks.files import export_markdown_now, write_reports, write_routed
from sitecorpus.sources.corpus import read_exported_corpus
from sitecorpus.sources.sitemaps import read_sitemaps, slice_frontier


def test_reports_hold_every_title(spark, tmp_path):
    stats = spark.range(3000).select((F.col("id") % 2).alias("crawl_id"), F.format_string("Title %05d", "id").alias("title"),
                                     (F.lit(2) + F.col("id") % 5).alias("total_files"), F.lit(2).cast("long").alias("moved_files"),
                                     F.format_string("title-%05d", "id").alias("folder"))
    outcomes = spark.range(40).select((F.col("id") % 2).alias("crawl_id"), F.col("id").alias("url_index"),
                                      F.format_string("u%d", "id").alias("url"), (F.col("id") >= 10).alias("ok"))
    out = str(tmp_path / "reports")
    write_reports(crawl_summary(outcomes, stats), failed_urls(outcomes), duplicate_breakdown(stats), out, "2024-01-31")
    lines = spark.read.text(out + "/crawl_summary").collect()
    per = collections.Counter(r.crawl_id for r in lines if r.value.startswith("title\t"))
    assert per == {0: 1500, 1: 1500}
    assert sum(r.value == "repeated_titles\t1500" for r in lines) == 2
    first = [f for f in sorted(os.listdir(out + "/crawl_summary/crawl_id=0")) if f.startswith("part")]
    text = "".join(open(f"{out}/crawl_summary/crawl_id=0/{f}", encoding="utf-8").read() for f in first).split("\n")
    assert text[0] == "generated_at\t2024-01-31"
    counts = [int(x.split("\t")[2]) for x in text if x.startswith("title\t")]
    assert counts == sorted(counts, reverse=True)
    urls = [r.value for r in spark.read.text(out + "/failed_urls").filter("crawl_id = 1").collect()]
    assert [u for u in urls if u.startswith("url")] == [f"url\tu{i}" for i in (1, 3, 5, 7, 9)]


A = "url string, kind string, seq int, status int, error string, body string"


def test_url_without_a_usable_fetch_fails(spark):
    rows = [("only-refetch", "refetch", 1, 200, None, "{}"), ("late", "fetch", 9, 200, None, "{}"), ("good", "fetch", 1, 200, None, "{}"),
            ("down", "fetch", 1, None, "timeout", None), ("cached", "fetch", 1, 200, None, '{"warning": "a cached snapshot"}'),
            ("cached", "refetch", 1, 200, None, '{"data": 1}')]
    got = {r.url: r for r in resolve_attempts(spark.createDataFrame(rows, A), 2).collect()}
    assert [(got[u].ok, got[u].reason, got[u].n_attempts) for u in ("only-refetch", "late", "good", "down")] == [
        (False, "no_attempts", 0), (False, "no_attempts", 0), (True, None, 1), (False, "timeout", 1)]
    assert got["good"].body == "{}" and got["cached"].body == '{"data": 1}' and got["cached"].from_refetch


def test_bodies_follow_a_given_order(spark):
    rows = [("u", "fetch", 30, 500, None, "late"), ("u", "fetch", 10, 500, None, "first"), ("u", "fetch", 20, 200, None, '{"second": 1}')]
    df = spark.createDataFrame(rows, "url string, kind string, at int, status int, error string, body string")
    row = resolve_attempts(df, 2, order=("at",)).first()
    assert (row.ok, row.decided_seq, row.body) == (True, 2, '{"second": 1}')


def test_export_of_odd_names(spark, tmp_path):
    long_name = "n" * 230 + ".md"
    rows = [("_a_b.md", "hidden"), ("u:p@ex.com:80_x.md", "colon"), (long_name, "long"), ("x" * 300 + ".md", "too long"), ("plain.md", None)]
    manifest = export_markdown_now(spark.createDataFrame(rows, "filename string, text string"), str(tmp_path / "corpus"))
    assert {r.filename: r.error for r in manifest.collect()} == {
        "_a_b.md": None, "u:p@ex.com:80_x.md": None, long_name: None, "x" * 300 + ".md": "bad_name", "plain.md": None}
    got = {r.filename: r.raw for r in read_exported_corpus(manifest).collect()}
    assert got == {"_a_b.md": "hidden", "u:p@ex.com:80_x.md": "colon", long_name: "long", "plain.md": ""}
    assert not [f for f in os.listdir(tmp_path / "corpus") if f.startswith(".") and not f.endswith(".crc")]


def test_python_writers_refuse_other_stores():
    assert posix_path("file:///a/b") == "/a/b" and posix_path("/a/b") == "/a/b"
    with pytest.raises(ValueError):
        posix_path("hdfs://host/a")


def test_routed_write_clusters_folders(spark, tmp_path):
    df = spark.range(600).select(F.format_string("%d.md", "id").alias("filename"), (F.col("id") < 400).alias("is_duplicate"),
                                 F.when(F.col("id") < 400, F.format_string("f%d", F.col("id") % 40)).alias("folder")).repartition(8)
    write_routed(df, str(tmp_path / "out"), records_per_file=100)
    back = spark.read.parquet(str(tmp_path / "out")).withColumn("routed", F.col("routed").cast("boolean"))
    assert back.filter("routed").count() == 400 and back.filter("not routed and folder is null").count() == 200
    assert back.select(F.input_file_name()).distinct().count() <= 16
    assert sorted(os.listdir(tmp_path / "out"))[-2:] == ["routed=false", "routed=true"]


def _listing(spark, bodies):
    df = spark.createDataFrame([(i + 1, 200, b) for i, b in enumerate(bodies)], "page int, status int, body string")
    return read_document_listing(df).count()


def test_unreadable_page_empties_the_listing(spark):
    page = '{"data": [{"id": "1", "name": "a"}], "has_more": %s}'
    assert _listing(spark, [page % "true", page % "false"]) == 2
    for bad in ("not json", None, "[1]"):
        assert _listing(spark, [page % "true", bad, page % "false"]) == 0
    assert _listing(spark, [page % "false", "not json"]) == 1  # behind the last page


def test_sitemaps_in_other_encodings(spark, tmp_path):
    body = "<urlset xmlns='http://www.sitemaps.org/schemas/sitemap/0.9'><url><loc> http://e.com/é </loc><loc>second</loc></url><url/></urlset>"
    for name, encoding in (("a.xml", "iso-8859-1"), ("b.xml", "utf-8"), ("c.xml", "utf-16")):
        (tmp_path / name).write_bytes(f"<?xml version='1.0' encoding='{encoding}'?>{body}".encode(encoding))
    (tmp_path / "bad.xml").write_bytes(b"<urlset><url>")
    (tmp_path / "odd.xml").write_bytes(b"<?xml version='1.0' encoding='no-such'?><a/>")
    assert [r.url for r in read_sitemaps(spark, str(tmp_path)).collect()] == ["http://e.com/é"] * 3


def test_start_beyond_the_last_url_is_refused(spark):
    df = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b"), ("t", 1, "c")], "seed string, url_index long, url string")
    got = {(r.seed, r.url_index, r.url, r.error) for r in slice_frontier(df, 2).collect()}
    assert got == {("s", 2, "b", None), ("t", 1, None, "start_index_exceeds_total")}


@pytest.mark.parametrize("tag, want", [
    ('<meta name="description" content="It\'s here">', "It's here"), ("<meta content='a > b' name='description'/>", "a > b"),
    ("<META NAME=description CONTENT=plain>", "plain"), ('<meta name="keywords" content="k"><meta name="description" content="d">', "d"),
    ('<meta name="description">', ""), ('<meta property="name=description" content="x">', ""), ("", ""),
    ('<meta name="description" content="a &apos;b&apos; &amp; c">', "a 'b' & c"),
    ('<meta charset=utf-8 name = "description"\n content =\'a "b" <meta x>\'>', 'a "b" <meta x>'),
    ('<meta <meta name="description" content="after an open tag">', "after an open tag"),
    ('<meta content="one" content="two" name="description">', "one"), ('<meta "stray name=x" name=description content=a/b/>', "a/b/"),
    ('<meta name="description" content>', ""), ("<metadata name=description content=x>", "")])
def test_description(spark, tag, want):
    df = spark.createDataFrame([(f"<html><head><title>It&apos;s</title>{tag}</head></html>",)], "html string")
    row = extract_page_metadata(df).first()
    assert (row.description, row.title) == (want, "It's")


MB = 1 << 20


@pytest.mark.parametrize("tag, want", [
    (f'<meta name="description" content="{"x" * MB}">', "x" * MB), (f"<meta name=description content={'y' * MB}>", "y" * MB),
    (f"<meta {'bare ' * (MB // 5)}name=description content=z>", "z"), (f"<meta {'=' * MB}", ""), ("<meta " * (MB // 6), ""),
    (f'<meta name="description" content="{"open " * (MB // 5)}', ""), (f"<meta {'a=b ' * (MB // 4)}>", ""), ("<meta" + "'" * MB, ""),
    (f"<meta{' ' * MB}>", ""), (f'<meta {chr(34)}{"<meta " * (MB // 6)}{chr(34)} name=description content=q>', "q"),
    (f'{"<title>" * 20000}<meta name="description" content="d">', "d")], ids=range(11))
def test_huge_open_and_bare_tags(spark, tag, want):
    """A megabyte of any of these ends neither the JVM nor the test's patience."""
    df = spark.createDataFrame([(f"<html><head>{tag}</head></html>",)], "html string")
    assert extract_page_metadata(df).first().description == want


URLS = [" http://a.com/x", "\x01\x02 http://a.com/x y", "http://a.com/x\ty\n", "http://[::1]/x", "http://[::1]:80/x", "http://[bad]/x", "http://[/x",
        "http://a]/x", "http://u@[fe80::1%25eth0]/x", "http://[1:2:3:4:5:6:7:8]/x", "http://[1:2:3]/x", "http://[v1.a]/x", "http://[::1.2.3.4]/",
        "http://x[::1]/", "http://[1::2::3]/", "http://[12345::]/", "http://[::1]x/", "http://[1:2:3:4:5:6:1.2.3.4]/"]


def test_urls_as_python_reads_them(spark):
    rows = spark.createDataFrame([(u,) for u in URLS], "u string").select(
        "u", url_error("u").alias("e"), url_domain("u").alias("d"), url_path("u").alias("p"), url_filename("u").alias("f")).collect()
    for r in rows:
        try:
            parsed = urlparse(r.u)
        except ValueError:
            assert r.e == "bad_url", r.u
            continue
        assert r.e is None and (r.d, r.p) == (parsed.netloc.replace("www.", ""), parsed.path), r.u


def test_cut_parents(spark):
    df = spark.createDataFrame([(1, "a b c d e\nf")], "doc_id long, text string")
    assert parents(df).first().parent_text == "a b c d e\nf"
    got = [(r.seg_no, r.piece_no, r.parent_text, r.n_tokens) for r in parents(df, max_parent_tokens=2).collect()]
    assert got == [(1, 1, "a b", 2), (1, 2, "c d", 2), (1, 3, "e", 1), (2, 1, "f", 1)]


def test_later_runs_win_at_any_position(spark):
    schema = "filename string, url_index long, title_key string, run int"
    kept = spark.createDataFrame([("f", 5 * 10 ** 12, "old", 1), ("g", 1, "g", 1)], schema)
    new = spark.createDataFrame([("f", 1, "new", 2)], schema)
    assert {(r.filename, r.title_key) for r in route_increment(kept, new).collect()} == {("f", "new"), ("g", "g")}


def test_import_of_a_damaged_folder(spark):
    from sitecorpus.plans.jobs import import_folder
    raws = {"good.md": '---\ntitle: "T"\ncrawl_date: "5"\ndomain: "d"\n---\n\nbody', "new.md": "no block, title from the name",
            "blank.md": '---\ntitle: "B"\n---\n\n \u00a0\n', "null.md": "---\n\n---\n\nbody", "list.md": "---\n- a\n---\n\nbody",
            "bad.md": "---\ntitle: [a\n---\n\nbody", "title.md": "---\ntitle:\n---\n\nbody", "bytes.md": None}
    files = spark.createDataFrame([("/c/" + k, k, k[:-3], v, None if v is not None else "invalid_utf8") for k, v in raws.items()],
                                  "path string, filename string, stem string, raw string, error string")
    listing = spark.createDataFrame([(1, 200, '{"data": [{"id": "old", "name": "T (5)"}], "has_more": false}')], "page int, status int, body string")
    registry = spark.createDataFrame([(1, 200, '{"doc_metadata": [{"id": "f1", "name": "domain", "type": "string"}]}'),
                                      (2, 200, '{"doc_metadata": [{"id": "f2", "name": "domain", "type": "string"}]}')],
                                     "page int, status int, body string")
    job = import_folder(files, listing, registry)
    got = {r.filename: (r.import_status, r.action) for r in job.plan.collect()}
    assert got == {"good.md": (None, "replace"), "new.md": (None, "create"), "blank.md": ("blank", None), "null.md": ("empty_frontmatter", None),
                   "list.md": ("not_mapping", None), "bad.md": ("unreadable", None), "title.md": ("bad_title", None), "bytes.md": ("unreadable", None)}
    assert sorted(r.path for r in job.failed.collect()) == [f"/c/{x}.md" for x in ("bad", "blank", "bytes", "list", "null", "title")]
    assert tuple(job.summary.first()) == (2, 6)
    state = {r.name: r.id for r in job.state.collect()}
    assert state.keys() == {"T (5)", "new ()"} and state["T (5)"] != "old"
    assert {(r.name, r.field_id) for r in job.metadata.collect() if r.name == "domain"} == {("domain", "f2")}
    skipped = import_folder(files, listing, registry, skip_existing=True)
    assert {r.filename: r.action for r in skipped.plan.collect()}["good.md"] == "skip"
    assert {r.name: r.id for r in skipped.state.collect()}["T (5)"] == "old"


@pytest.mark.parametrize("exact", [False, True])
def test_crawl_from_seeds_to_reports(spark, exact):
    from sitecorpus.plans.jobs import crawl
    seeds = spark.createDataFrame([("http://e.com/map.xml",), ("http://e.com/lone",)], "seed string")
    urls = ["http://e.com/a", "http://e.com/a?q=2", "http://e.com/b", "http://e.com/c", "http://e.com/never", "http://e.com/json"]
    maps = spark.createDataFrame([("http://e.com/map.xml", i + 1, u) for i, u in enumerate(urls)], "file string, pos long, url string")
    body = '{"data": {"title": "%s", "content": "text of %s", "description": "one\\ntwo"}}'
    rows = [(urls[0], "fetch", 1, 500, None, None), (urls[0], "fetch", 2, 200, None, body % ("Old", "a")), (urls[1], "fetch", 1, 200, None, body % ("Same", "a2")),
            (urls[2], "fetch", 1, 200, None, body % ("Same", "b")), (urls[3], "fetch", 1, 200, None, body % ("Own", "c")),
            (urls[5], "fetch", 1, 200, None, "not json"), ("http://e.com/lone", "fetch", 1, 200, None, body % ("Lone", "l"))]
    job = crawl(seeds, maps, spark.createDataFrame(rows, A), 7, exact_envelope=exact)
    assert {r.url: r.reason for r in job.outcomes.collect() if not r.ok} == {urls[4]: "no_attempts", urls[5]: "invalid_json"}
    pages = {r.filename: r for r in job.pages.collect()}
    assert {f: r.is_duplicate for f, r in pages.items()} == {"e.com_a.md": True, "e.com_b.md": True, "e.com_c.md": False, "e.com_lone.md": False}
    assert pages["e.com_a.md"].url == urls[1] and pages["e.com_a.md"].text.startswith('---\ntitle: "Same"\n')
    assert ("two" in pages["e.com_c.md"].description) == (not exact)  # a header line keeps one line
    summary = job.summary.first()
    assert (summary.total_urls, summary.successful, summary.failed, summary.duplicate_files) == (7, 5, 2, 2)
    refused = crawl(seeds, maps, spark.createDataFrame(rows, A), 7, start_index=6)
    assert [r.error for r in refused.frontier.collect() if r.url is None] == ["start_index_exceeds_total"]
    assert [r.url for r in refused.outcomes.collect()] == [urls[5]]
