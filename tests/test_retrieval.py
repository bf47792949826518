"""Retrieval rules (FIXTURES.md): zero vector, missing vector, threshold, ties, weights, blocks."""

import numpy as np
import pytest

from sitecorpus.operators import retrieval
from sitecorpus.operators.retrieval import above, hybrid_scores, keyword_top_k, retrieve, top_k, vector_top_k

Q = "query_id long, text string, embedding array<float>"


def _tables(spark):
    docs = spark.createDataFrame([(1, "red apple"), (2, "green apple pie"), (3, "blue sky"), (4, "blue sky")],
                                 "doc_id long, text string")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (3, [0.0, 1.0]), (9, [1.0, 1.0]), (4, None)],
                                    "doc_id long, embedding array<float>")
    return docs, vectors


def test_vector_zero_ties_and_missing(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None)], "query_id long, embedding array<float>")
    c = spark.createDataFrame([(10, [1.0, 0.0]), (5, [2.0, 0.0]), (7, [0.0, 1.0]), (1, None)],
                              "doc_id long, embedding array<float>")
    got = {(r.query_id, r.rank): (r.doc_id, r.vector_score) for r in vector_top_k(q, c, k=2).collect()}
    assert got[(1, 1)] == (5, 1.0) and got[(1, 2)] == (10, 1.0)
    assert got[(2, 1)] == (5, 0.0) and (3, 1) not in got


def test_threshold_inclusive_and_disabled(spark):
    df = spark.createDataFrame([(1, 1, 0.7), (1, 2, 0.69)], "query_id long, doc_id long, score double")
    assert above(df, 0.7).count() == 1 and above(df, 0.7, enabled=False).count() == 2


def test_hybrid_weight_and_missing_sides(spark):
    docs, vectors = _tables(spark)
    q = spark.createDataFrame([(1, "apple", [1.0, 0.0]), (2, "sky", None), (3, "nothing", [0.0, 1.0])], Q)
    got = {(r.query_id, r.doc_id): r for r in hybrid_scores(q, docs, vectors, 0.7, None).collect()}
    assert len(got) == 3 * 5  # four documents and a vector without one
    r = got[(1, 1)]
    assert r.score == pytest.approx(0.7 * r.vector_score + 0.3 * r.keyword_score) and r.vector_score == pytest.approx(1)
    assert got[(2, 3)].vector_score == 0 and got[(2, 3)].keyword_score > 0
    assert got[(3, 3)].score == pytest.approx(0.7) and got[(3, 1)].score == 0
    with pytest.raises(ValueError):
        hybrid_scores(q, docs, vectors, 1.2)


@pytest.mark.parametrize("method, weight", [("hybrid", 0.7), ("hybrid", 1.0), ("hybrid", 0.0), ("semantic", 0.5), ("keyword", 0.5)])
def test_retrieve_with_a_query_that_lacks_a_vector(spark, method, weight):
    docs, vectors = _tables(spark)
    q = spark.createDataFrame([(1, "apple", [1.0, 0.0]), (2, "sky", None)], Q)
    got = [(r.query_id, r["rank"], r.doc_id) for r in
           retrieve(q, docs, vectors, method, 2, weight, threshold_enabled=False).collect()]
    assert (1, 1, 1) in got
    if method == "keyword" or (method, weight) == ("hybrid", 0.0):
        assert (2, 1, 3) in got and (2, 2, 4) in got  # equal texts: ties to the lower id


def test_keyword_scores_range(spark):
    docs, _ = _tables(spark)
    q = spark.createDataFrame([(1, "Apple pie", None)], Q)
    s = {r.doc_id: r.keyword_score for r in keyword_top_k(q, docs, 10).collect()}
    assert set(s) == {1, 2} and all(0 < x <= 1 for x in s.values()) and s[2] > s[1]


def test_blocks_do_not_change_results(spark, monkeypatch):
    docs, vectors = _tables(spark)
    q = spark.createDataFrame([(i, t, [float(i), 1.0]) for i, t in enumerate(["apple", "sky pie", "red blue"])], Q)
    whole = sorted(top_k(hybrid_scores(q, docs, vectors, 0.4, 3), 3).collect())
    for name in ("BLOCK_DOCS", "BLOCK_QUERIES", "STRIP", "BLOCK_HEADS"):
        monkeypatch.setattr(retrieval, name, 2)
    assert sorted(top_k(hybrid_scores(q, docs, vectors, 0.4, 3), 3).collect()) == whole


def test_only_pruned_pairs_are_shuffled(spark):
    docs, vectors = _tables(spark)
    q = spark.createDataFrame([(1, "apple", [1.0, 0.0])], Q)
    plan = top_k(hybrid_scores(q, docs, vectors, 0.7, 2), 2)._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):  # keyed by query and document: never; by query: after the limit of a block
        assert not ("Exchange" in line and "query_id" in line and "doc_id" in line)
    assert "WindowGroupLimit" in plan


def _plain(queries, docs, weight, k):
    """(query, doc, score) of the best k by brute force over (vec or None, {term: weight}) entries."""
    def unit(v):
        n = np.linalg.norm(v) if v is not None else 0
        return np.asarray(v) / n if n else np.zeros(8)
    out = []
    for q, (qv, qt) in queries.items():
        scores = [(-round(weight * float(unit(qv) @ unit(dv)) + (1 - weight) * sum(w * dt.get(t, 0) for t, w in qt.items()), 12), d)
                  for d, (dv, dt) in docs.items()]
        out += [(q, d, -s) for s, d in sorted(scores)[:k]]
    return out


@pytest.mark.parametrize("weight", [1.0, 0.0, 0.6])
def test_skipped_blocks_change_nothing(spark, monkeypatch, weight):
    """On clustered documents most (query, block) pairs are skipped, and the rows are those of brute force."""
    monkeypatch.setattr(retrieval, "BLOCK_DOCS", 20)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(25, 8))

    def entry(c, i):
        vec = None if i % 37 == 5 else [0.0] * 8 if i % 53 == 7 else (centres[c] + rng.normal(size=8) * 0.03).tolist()
        terms = {int(t): float(w) for t, w in zip([1000 + c, 2000 + c, *rng.integers(0, 5, 2)], [0.7, 0.6, 0.2, 0.1])}
        return vec, ({} if i % 41 == 3 else terms)
    docs = {i: entry(int(rng.integers(25)), i) for i in range(1000)}
    docs |= {2000 + i: docs[8] for i in range(60)}  # ties over several blocks
    queries = {i: entry(i % 25, i + 1) for i in range(40)}

    def table(entries, key):
        rows = [(i, v, [(t, w) for t, w in sorted(ts.items())] or None) for i, (v, ts) in entries.items()]
        return spark.createDataFrame(rows, f"{key} long, vec array<double>, terms {retrieval.TERMS}")
    blocks = retrieval.blocks_of(table(docs, "doc_id"))
    search = retrieval.Search(table(queries, "query_id"), blocks, weight, 5)
    got = sorted((r.query_id, r.doc_id, r.score) for r in top_k(search.found, 5).collect())
    want = sorted(_plain(queries, docs, weight, 5))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-9)
    met, every = search.seeds.count() + search.rest.count(), len(queries) * blocks[0].count()
    assert every > 1500 and met < 0.4 * every
    pairs = [(r.query_id, r.block) for r in search.seeds.unionByName(search.rest).collect()]
    assert len(set(pairs)) == len(pairs)


def test_bounds_hold_and_thresholds_skip(spark, monkeypatch):
    monkeypatch.setattr(retrieval, "BLOCK_DOCS", 10)
    rng = np.random.default_rng(4)
    docs = spark.createDataFrame([(i, rng.normal(size=4).tolist(), [(int(t), 0.5) for t in set(rng.integers(0, 30, 3).tolist())]) for i in range(200)],
                                 f"doc_id long, vec array<double>, terms {retrieval.TERMS}")
    q = spark.createDataFrame([(i, rng.normal(size=4).tolist(), [(int(t), 0.6) for t in set(rng.integers(0, 30, 2).tolist())]) for i in range(12)],
                              f"query_id long, vec array<double>, terms {retrieval.TERMS}")
    blocks = retrieval.blocks_of(docs)
    place = {int(d): b.block for b in blocks[0].collect() for d in np.frombuffer(b.ids, np.int64)}
    assert sorted(place) == list(range(200))
    every = retrieval.Search(q, blocks, 0.5, None)
    bound = {(r.query_id, r.block): r.bound for r in every.seeds.unionByName(every.rest).collect()}
    assert len(bound) == 12 * blocks[0].count()
    rows = every.found.collect()
    assert len(rows) == 12 * 200 and all(r.score <= bound[r.query_id, place[r.doc_id]] + 1e-9 for r in rows)
    some = retrieval.Search(q, blocks, 0.5, None, threshold=0.45)
    assert sorted((r.query_id, r.doc_id) for r in some.found.collect()) == sorted((r.query_id, r.doc_id) for r in rows if r.score >= 0.45)
    assert some.seeds.count() + some.rest.count() < len(bound)


def test_no_documents_and_no_queries(spark):
    none = spark.createDataFrame([], "doc_id long, embedding array<float>")
    q = spark.createDataFrame([(1, [1.0])], "query_id long, embedding array<float>")
    assert vector_top_k(q, none).collect() == [] and vector_top_k(q.limit(0), none).collect() == []


def test_top_k_plans_partial_limit(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(10)], "query_id long, doc_id long, score double")
    out = top_k(df, 2)
    assert [r.doc_id for r in out.orderBy("rank").collect()] == [9, 8]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
