"""Duplicate routing goldens (FIXTURES.md)."""

from pyspark.sql import functions as F

from sitecorpus.operators.duplicates import (
    duplicate_breakdown, duplicate_titles, latest_pages, route_duplicates, route_increment,
    with_title_key,
)


def _pages(spark, rows):
    df = spark.createDataFrame(rows, "filename string, title string, url_index long")
    return with_title_key(df, title_col="title", stem_col="filename")


def _routes(df, **kw):
    return {r.filename: (r.is_duplicate, r.folder) for r in route_duplicates(df, **kw).collect()}


def test_keep_none(spark):
    r = _routes(_pages(spark, [("a", "X", 1), ("b", "X", 2), ("c", "Y", 3), ("d", "x", 4)]))
    assert r == {"a": (True, "x"), "b": (True, "x"), "c": (False, None), "d": (False, None)}


def test_untitled_and_404(spark):
    r = _routes(_pages(spark, [("a", "", 1), ("b", "", 2), ("c", "!!!", 3), ("d", "!!!", 4),
                               ("e", "Page non trouvée – 404", 5), ("f", "Page non trouvée – 404", 6)]))
    assert r["a"] == r["b"] == (True, "untitled") and r["c"] == (True, "untitled")
    assert r["e"] == (True, "page-non-trouvée-404")


def test_stem_collides_with_title(spark):
    r = _routes(_pages(spark, [("s", None, 1), ("t", "s", 2)]))
    assert r["s"][0] and r["t"][0]


def test_keep_first(spark):
    r = _routes(_pages(spark, [("a", "X", 1), ("b", "X", 2), ("c", "X", 3)]), keep="first")
    assert r == {"a": (False, None), "b": (True, "x"), "c": (True, "x")}


def test_null_title_is_bad_title(spark):
    df = spark.createDataFrame([("a", {"title": None}), ("b", {"title": None})],
                               "filename string, meta map<string,string>")
    keyed = with_title_key(df.withColumn("stem", F.col("filename")), meta_col="meta")
    assert {r.error for r in keyed.collect()} == {"bad_title"}
    assert duplicate_titles(keyed.withColumn("url_index", F.lit(1))).count() == 0


def test_two_titles_share_folder(spark):
    df = _pages(spark, [("a", "A  -  B", 1), ("b", "A  -  B", 2), ("c", "a b", 3), ("d", "a b", 4)])
    stats = duplicate_titles(df).collect()
    assert len(stats) == 2 and {s.folder for s in stats} == {"a-b"}


def test_breakdown_order(spark):
    df = _pages(spark, [("a", "B", 1), ("b", "B", 2), ("c", "A", 3), ("d", "A", 4),
                        ("e", "C", 5), ("f", "C", 6), ("g", "C", 7)])
    assert [r.title for r in duplicate_breakdown(duplicate_titles(df)).collect()] == ["C", "A", "B"]


def test_latest_pages_later_write_wins(spark):
    df = spark.createDataFrame([("f", 1, "old"), ("f", 5, "new"), ("g", 2, "g")],
                               "filename string, url_index long, body string")
    assert {(r.filename, r.body) for r in latest_pages(df).collect()} == {("f", "new"), ("g", "g")}


def test_increment_title_comes_back(spark):
    retained = _pages(spark, [("k", "K", 1)]).withColumn("run", F.lit(1))
    # "X" was archived in run 1 (both copies routed out); a single new copy is kept
    batch = _pages(spark, [("x3", "X", 2), ("k", "K2", 3)]).withColumn("run", F.lit(2))
    out = {r.filename: (r.title_key, r.is_duplicate) for r in route_increment(retained, batch).collect()}
    assert out == {"x3": ("X", False), "k": ("K2", False)}


def test_ties_on_name_and_position_leave_one_row(spark):
    rows = [("a", "X", 1), ("a", "Y", 1), ("a", "Z", 0), ("b", "P", 2), ("b", "P2", 2), ("b", "P3", 2), ("c", "Q", 3), (None, "R", 1), (None, "R", 1)]
    df = spark.createDataFrame(rows, "filename string, title string, url_index long").withColumn("meta", F.create_map(F.lit("k"), "title"))
    got = [latest_pages(df.repartition(n)).collect() for n in (1, 3, 5)]
    for some in got:
        assert sorted(str(r.filename) for r in some) == ["None", "None", "a", "b", "c"]
        assert [r.title for r in some if r.filename == "a"] == [r.title for r in got[0] if r.filename == "a"] != ["Z"]
