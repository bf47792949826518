"""Reader responses, attempt resolution and the envelope (FIXTURES.md goldens)."""

import datetime as dt

import pytest

from sitecorpus.operators.responses import (
    format_envelope, parse_envelope, parse_responses, resolve_attempts,
)

FULL = ('{"data":{"title":"T","content":"c","url":"u2","description":"d",'
        '"metadata":{"lang":"en"}}}')


def _resp(spark, bodies, include_language=True):
    df = spark.createDataFrame([(i, "req", b) for i, b in enumerate(bodies)],
                               "i int, url string, body string")
    return parse_responses(df, include_language).orderBy("i").collect()


def test_fields_and_defaults(spark):
    full, empty, data_empty, null_title = _resp(
        spark, [FULL, "{}", '{"data":{}}', '{"data":{"title":null}}'])
    assert (full.title, full.content, full.url_source, full.description, full.language) == \
        ("T", "c", "u2", "d", "en")
    for r in (empty, data_empty):
        assert (r.title, r.content, r.url_source, r.error) == ("", "", "req", None)
    assert null_title.title == "None"


@pytest.mark.parametrize("body", ['{"data":null}', '{"data":[1]}', '{"warning":null,"data":{}}', "[]"])
def test_bad_shape(spark, body):
    assert _resp(spark, [body])[0].error == "bad_shape"


def test_invalid_json_and_metadata_null(spark):
    nope, blank, meta = _resp(spark, ["nope", "", '{"data":{"metadata":null}}'])
    assert nope.error == blank.error == "invalid_json"
    assert meta.error == "bad_shape"
    assert _resp(spark, ['{"data":{"metadata":null}}'], include_language=False)[0].error is None


OK = '{"data":{"title":"x"}}'
CACHED = '{"warning":"Cached Snapshot of x","data":{}}'


def _resolve(spark, attempts, **kw):
    t = dt.datetime(2024, 1, 1)
    rows = [(u, 1, s, kind, st, err, body, t) for u, s, kind, st, err, body in attempts]
    df = spark.createDataFrame(rows, "url string, url_index long, seq int, kind string, "
                                     "status int, error string, body string, started_at timestamp")
    return {r.url: r for r in resolve_attempts(df, **kw).collect()}


def test_attempt_goldens(spark):
    att = [("a", 1, "fetch", 200, None, OK),
           ("b", 1, "fetch", 500, None, None), ("b", 2, "fetch", None, "timeout", None),
           ("b", 3, "fetch", 200, None, OK),
           ("c", 1, "fetch", 500, None, None), ("c", 2, "fetch", 500, None, None),
           ("c", 3, "fetch", 500, None, None), ("c", 4, "fetch", 200, None, OK),
           ("d", 1, "fetch", None, "connection", None), ("d", 2, "fetch", None, "connection", None),
           ("d", 3, "fetch", None, "connection", None),
           ("e", 1, "fetch", 200, None, "bad"), ("e", 2, "fetch", 200, None, OK),
           ("f", 1, "fetch", 200, None, CACHED), ("f", 1, "refetch", 200, None, OK),
           ("g", 1, "fetch", 200, None, CACHED), ("g", 1, "refetch", 200, None, CACHED),
           ("h", 1, "fetch", 200, None, '{"data":{"content":""}}')]
    r = _resolve(spark, att)
    assert (r["a"].ok, r["a"].n_attempts) == (True, 1)
    assert (r["b"].ok, r["b"].n_attempts) == (True, 3)
    assert (r["c"].ok, r["c"].reason, r["c"].n_attempts) == (False, "http_error", 3)
    assert (r["d"].ok, r["d"].reason) == (False, "connection")
    assert (r["e"].reason, r["e"].n_attempts) == ("invalid_json", 1)
    assert r["f"].ok and r["f"].from_refetch and r["f"].body == OK
    assert (r["g"].ok, r["g"].reason) == (False, "still_cached")
    assert r["h"].ok
    acc = _resolve(spark, [("f", 1, "fetch", 200, None, CACHED)], accept_cached=True)
    assert acc["f"].ok and not acc["f"].from_refetch
    zero = _resolve(spark, [("z", 1, "fetch", 404, None, None)], max_retries=0)
    assert (zero["z"].ok, zero["z"].n_attempts) == (False, 1)
    neg = _resolve(spark, [("z", 1, "fetch", 200, None, OK)], max_retries=-1)
    assert (neg["z"].ok, neg["z"].n_attempts) == (False, 0)


def test_envelope_quirks(spark):
    env = ["Title: Hello\n\nURL Source: u\n\nDescription: one\ntwo\n\nLanguage: en\n\n"
           "Markdown Content:\n  body  \n",
           "Title: Title: x Title: \n\nMarkdown Content:\nb",
           "Description: d\nTitle: over\n\nMarkdown Content:\nb",
           "Title: only", ""]
    df = spark.createDataFrame([(i, e) for i, e in enumerate(env)], "i int, envelope string")
    got = {r.i: r for r in parse_envelope(df).collect()}
    assert (got[0].env_title, got[0].env_description, got[0].env_markdown) == ("Hello", "one", "body")
    assert got[1].env_title == "x"
    assert got[2].env_title == "over"
    assert got[3].env_markdown == ""
    assert 4 not in got


def test_envelope_round_trip(spark):
    df = spark.createDataFrame([("T", "u", "d", "en", "line1\nline2")],
                               "title string, url_source string, description string, "
                               "language string, content string")
    r = parse_envelope(format_envelope(df)).first()
    assert (r.env_title, r.env_url_source, r.env_markdown) == ("T", "u", "line1\nline2")


def test_strict_mode_uses_python_rules(spark):
    df = spark.createDataFrame([(1, "u", '{"data":{}} trailing'), (2, "u", '{"data":{}}')],
                               "i int, url string, body string")
    loose = {r.i: r.error for r in parse_responses(df).collect()}
    strict = {r.i: r.error for r in parse_responses(df, strict=True).collect()}
    assert loose == {1: None, 2: None}
    assert strict == {1: "invalid_json", 2: None}
