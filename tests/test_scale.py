"""Sizes of what is dealt, joined and held."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_parts_of_an_exported_corpus(spark, tmp_path, monkeypatch):
    from sitecorpus.sinks.files import export_markdown_now
    from sitecorpus.sources.corpus import read_exported_corpus
    rows = [(f"p{i}.md", None if i == 3 else "ä" * 1000 + str(i)) for i in range(150)]
    manifest = export_markdown_now(spark.createDataFrame(rows, "filename string, text string"), str(tmp_path / "c"))
    assert manifest.count() == 150 and manifest.filter("error is not null").count() == 0
    read = read_exported_corpus(manifest)
    assert "MapInArrow" in _plan(read) and "MapInPandas" not in _plan(read)
    got = {r.filename: r.raw for r in read.collect()}
    assert got == {n: t or "" for n, t in rows}


def test_documents_terms_need_no_deal_of_their_own(spark):
    from sitecorpus.operators import retrieval
    docs = spark.createDataFrame([(1, "a b b"), (1, "b c"), (2, "a"), (None, "a d")], "doc_id long, text string")
    tf, idf, norms = retrieval.keyword_index(docs)
    assert {(r.term, r.doc_id): r.tf for r in tf.collect()} == {
        ("a", 1): 1, ("b", 1): 3, ("c", 1): 1, ("a", 2): 1, ("a", None): 1, ("d", None): 1}
    want = {}
    weight = {r.term: r.idf for r in idf.collect()}
    for r in tf.collect():
        want[r.doc_id] = want.get(r.doc_id, 0.0) + (r.tf * weight[r.term]) ** 2
    assert {r.doc_id: r.dn for r in norms.collect()} == pytest.approx({k: v ** 0.5 for k, v in want.items()})
    assert "LeftOuter" in _plan(norms)  # terms of one document alone do not meet the others


def test_blocks_of_vectors_grow(spark):
    from sitecorpus.operators import retrieval
    assert retrieval.vector_block(10) == retrieval.BLOCK_DOCS
    assert retrieval.vector_block(100_000) == 12_500
    assert retrieval.vector_block(10 ** 7) == retrieval.MOST_VECTORS


def test_larger_blocks_find_the_same(spark, monkeypatch):
    from sitecorpus.operators import retrieval
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(4)]) for i in range(300)]
    corpus = spark.createDataFrame(rows, "doc_id long, embedding array<float>")
    queries = corpus.select(F.col("doc_id").alias("query_id"), "embedding")

    def found():
        return sorted((r.query_id, r["rank"], r.doc_id, round(r.vector_score, 9))
                      for r in retrieval.vector_top_k(queries, corpus, 3).collect())
    one = found()
    monkeypatch.setattr(retrieval, "BLOCK_DOCS", 20)
    monkeypatch.setattr(retrieval, "MOST_VECTORS", 60)
    monkeypatch.setattr(retrieval, "SCORES", 500)
    assert retrieval.vector_block(300) == 38 and found() == one and len(one) == 900


def test_components_grow_by_edges(spark):
    from sitecorpus.llm.components import components, extended
    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(180)] + [(i, i + 1) for i in range(500, 560)]
    edges += [(a, b) for a in range(600, 630) for b in range(600, a)]

    def roots(pairs):
        up = {x: x for e in pairs for x in e if e[0] != e[1]}

        def find(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in pairs:
            if a != b:
                a, b = sorted((find(a), find(b)))
                up[b] = a
        return {x: find(x) for x in up}

    def frame(pairs):
        return spark.createDataFrame(pairs, "a long, b long")
    rng.shuffle(edges)
    assert {r.node: r.root for r in components(frame(edges)).collect()} == roots(edges)
    some = extended(components(frame(edges[:300])), frame(edges[300:]))
    assert {r.node: r.root for r in some.collect()} == roots(edges)
    assert components(frame([(1, 1)])).count() == 0


def test_clean_texts_are_not_dealt_for_secrets(spark):
    from sitecorpus.llm.secret_scans import digest, find_secrets
    rows = [(1, "password = abcdefghijkl"), (2, "nothing here"), (3, None), (1, "password = abcdefghijkl"),
            (None, "x 0123456789abcdef"), (4, "x 0123456789abcdef")]
    found, _ = find_secrets(spark.createDataFrame(rows, "doc_id long, text string"), keep=["text"])
    assert "Union" in _plan(found)
    got = sorted((str(r.doc_id), r.d) for r in found.select("doc_id", digest(F.col("spans")).alias("d")).collect())
    assert got == sorted([("1", "assign:0:23"), ("1", "assign:0:23"), ("2", ""), ("3", ""), ("None", "hex:2:18"), ("4", "hex:2:18")])
