"""Upsert planning goldens (FIXTURES.md)."""

from pyspark.sql import functions as F

from sitecorpus.operators.upsert import (
    apply_upsert, document_name, existing_documents, importable, plan_upsert,
    read_document_listing, reconcile_registry,
)


def test_document_names(spark):
    rows = [({"title": "t" * 150, "crawl_date": "5"}, "s"), ({"title": "t" * 151}, "s"),
            ({}, "s"), ({"title": "T", "crawl_date": None}, "s")]
    df = spark.createDataFrame(rows, "meta map<string,string>, stem string")
    got = [r[0] for r in df.select(document_name(F.col("meta"), F.col("stem"))).collect()]
    assert got[0] == "t" * 150 + " (5)"
    assert got[1] == "t" * 147 + "... ()"
    assert got[2] == "s ()"
    assert got[3] == "T (None)"


def test_blank_body_not_importable(spark):
    df = spark.createDataFrame(
        [(" \n ", None, None, "mapping", {"title": "t"}), ("x", None, None, "mapping", {"title": "t"}),
         ("x", None, None, "mapping", {"title": None})],
        "body string, error string, fm_error string, yaml_kind string, meta map<string,string>")
    assert [r.import_status for r in importable(df).collect()] == ["blank", None, "bad_title"]


def _listing(spark, pages):
    return read_document_listing(spark.createDataFrame(pages, "page int, status int, body string"))


def test_listing_paging(spark):
    p1 = '{"data":[{"id":"1","name":"a"},{"id":"","name":"b"}],"has_more":true}'
    p2 = '{"data":[{"id":"2","name":"a"}],"has_more":false}'
    p3 = '{"data":[{"id":"3","name":"c"}],"has_more":false}'
    rows = _listing(spark, [(1, 200, p1), (2, 200, p2), (3, 200, p3)]).collect()
    assert [(r.page, r.name, r.id) for r in rows] == [(1, "a", "1"), (2, "a", "2")]
    err = _listing(spark, [(1, 200, p1.replace("true", "true")), (2, 500, p2)]).collect()
    assert [(r.page, r.id) for r in err] == [(1, "1")]


def test_replace_skip_and_apply(spark):
    listing = spark.createDataFrame([(1, 1, "n", "1"), (1, 2, "n", "2"), (1, 3, "m", "3")],
                                    "page int, pos int, name string, id string")
    docs = spark.createDataFrame([("n", "f1"), ("n", "f2"), ("new", "f3")],
                                 "doc_name string, filename string")
    plan = plan_upsert(docs, existing_documents(listing))
    acts = sorted((r.filename, r.action, r.old_id) for r in plan.collect())
    assert acts == [("f1", "replace", "2"), ("f2", "replace", "2"), ("f3", "create", None)]
    state = apply_upsert(listing, plan).collect()
    ids = sorted(r.id for r in state)
    assert "2" not in ids and "1" in ids and "3" in ids and len(ids) == 5
    skip = plan_upsert(docs, existing_documents(listing), skip_existing=True).collect()
    assert {r.action for r in skip if r.doc_name == "n"} == {"skip"}


def test_registry_creates_missing(spark):
    existing = spark.createDataFrame([("title", "f1", "string"), ("domain", "f2", "string")],
                                     "name string, field_id string, type string")
    reg = {r.name: r.action for r in reconcile_registry(existing).collect()}
    assert reg == {"title": "existing", "domain": "existing", "source_url": "create",
                   "crawl_date": "create", "description": "create", "language": "create"}
