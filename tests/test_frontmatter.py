"""Frontmatter split/parse goldens (FIXTURES.md) and the render → parse round trip."""

import pytest
from pyspark.sql import functions as F

from sitecorpus.operators.frontmatter import (
    lint_frontmatter, parse_frontmatter, render_frontmatter, split_frontmatter,
)

SAMPLE = ('---\ntitle: "Page"\nsource_url: "https://ex.com/p"\ndomain: "ex.com"\n'
          'crawl_date: "1700000000"\ndescription: "d"\nlanguage: "en"\n---\n\nBody text\n')


def _parse(spark, raws):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raws)], "i int, raw string")
    return parse_frontmatter(split_frontmatter(df)).orderBy("i").collect()


def test_sample_and_crlf(spark):
    a, b = _parse(spark, [SAMPLE, SAMPLE.replace("\n", "\r\n").replace("\r\n", "\n")])
    for r in (a, b):
        assert r.has_frontmatter and r.yaml_kind == "mapping"
        assert len(r.meta) == 6 and r.meta["crawl_date"] == "1700000000"
        assert r.body.startswith("\n")


@pytest.mark.parametrize("raw", ["no fence\n", "x\n---\na\n---\nb", "---\na: 1\n---"])
def test_not_matched(spark, raw):
    r = _parse(spark, [raw])[0]
    assert not r.has_frontmatter and r.body == raw and r.yaml_kind == "none"


def test_empty_block_and_list(spark):
    empty, lst = _parse(spark, ["---\n\n---\nb", "---\n- a\n---\nb"])
    assert empty.yaml_kind == "null" and empty.fm_error is None
    assert lst.fm_error == "not_mapping"


def test_typed_scalars_and_repeated_keys(spark):
    r = _parse(spark, ["---\ntitle: 2024-01-01\nn: 1\nx: true\ne:\nn: 2\n---\nb"])[0]
    assert r.meta["title"] == "2024-01-01" and r.meta["x"] == "True"
    assert r.meta["e"] is None and r.meta["n"] == "2"


def test_invalid_yaml(spark):
    r = _parse(spark, ['---\ntitle: "a\\d"\n---\nb'])[0]
    assert r.fm_error == "invalid_yaml"


def test_lint_reports_backslash_titles(spark):
    df = spark.createDataFrame(
        [(1, 'a "b"'), (2, "a\\d"), (3, "a\\n"), (4, "plain"), (5, "tail\\")],
        "doc_id long, title string").select(
        "doc_id", "title", F.lit("u").alias("url_source"), F.lit("d").alias("domain"),
        F.lit("").alias("description"))
    bad = {r.doc_id for r in lint_frontmatter(df).collect()}
    assert bad == {2, 3, 5}


def test_render_language_rule(spark):
    df = spark.createDataFrame([("t", "u", "d", 5, "", "en"), ("t", "u", "d", 5, "", "")],
                               "t string, u string, d string, c long, s string, l string")
    got = [r[0] for r in df.select(render_frontmatter("t", "u", "d", "c", "s", "l")).collect()]
    assert 'language: "en"' in got[0] and "language" not in got[1]
    assert got[0].endswith("---\n\n")


def test_missing_corpus_folder_is_empty(spark, tmp_path):
    from sitecorpus.sources.corpus import read_markdown_corpus
    assert read_markdown_corpus(spark, str(tmp_path / "nope")).count() == 0


def test_fast_path_agrees_with_pyyaml(spark):
    """Random Unicode values rendered in the fixed layout: the parsed map (JVM fast path or
    PyYAML slow path, chosen per row) equals what PyYAML reads from the same block."""
    import random

    import yaml

    rng = random.Random(11)
    pool = ("abcXYZ019 _-.:#&*!?%$@[]{}|>'\"\\\t/é漢ß😀  \u0085\x07"
            "﻿")
    vals = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 16))) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    fm = df.select("i", render_frontmatter("v", F.lit("u"), F.lit("d"), F.lit(1), F.lit(""),
                                           None, include_language=False).alias("raw"))
    got = {r.i: (r.meta, r.fm_error) for r in parse_frontmatter(split_frontmatter(fm)).collect()}
    for i, v in enumerate(vals):
        block = f'title: "{v.replace(chr(34), chr(92) + chr(34))}"\nsource_url: "u"\ndomain: "d"\n' \
                f'crawl_date: "1"\ndescription: ""'
        try:
            want = yaml.safe_load(block)
        except yaml.YAMLError:
            assert got[i][1] == "invalid_yaml", repr(v)
            continue
        meta, err = got[i]
        assert err is None and meta["title"] == want["title"], repr(v)
