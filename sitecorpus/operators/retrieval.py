"""Batch retrieval of a query table against a corpus: vector (cosine), keyword (TF-IDF
cosine) and weighted hybrid scores, score threshold and top-k.

Search is exact, blocked and pruned. Documents lie in blocks of like ones: by the nearest of some
pivot vectors or, without a vector, by their heaviest term. A block is one written row of flat
arrays: ids, unit vectors, and postings by term with the heaviest first. Its head is small: centre and
radius of its vectors and the greatest weight of each term. No document of a block can score above

    w * (query . centre + radius) + (1 - w) * sum over terms of (query weight * greatest weight),

its bound for that query. Each query is first scored against the block with its best bound; its
k-th score there is a floor for its k-th score overall, so blocks whose bound lies below it (or below
the threshold) are skipped and never meet the query. Only (query, block) pairs that are left are joined, and only each block's best
``k`` leave its task. No table of (query, document) pairs exists.

Scores are ranked and compared at ``TIE_DIGITS`` digits: sums of the same terms in another order
differ beyond them, so equal documents stay ties, which go to the lower id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sitecorpus.plans.sizing import materialize

TERM_RX = r"[\p{L}\p{N}]+"
TIE_DIGITS = 12
MARGIN = 1e-9         # by which a bound may be too low for rounding
BLOCK_DOCS = 4096     # documents of a block, about
BLOCK_QUERIES = 4096  # queries that meet a block in one task, about
MOST_VECTORS = 32768  # documents of a block, or queries that meet one, in a search by vectors alone
FEW_BLOCKS = 8        # blocks of such a search, at least, before they hold more than BLOCK_DOCS
SCORES = 1 << 20      # scores that are held at once
BLOCK_HEADS = 64      # heads that meet queries in one task, about (a head has up to some 50,000 terms)
MAX_PIVOTS = 1024     # pivot vectors, collected to the driver
STRIP = 256
TERMS = "array<struct<t:bigint,w:double>>"
SCORED = "query_id long, doc_id long, vector_score double, keyword_score double, score double"
PAIR = "query_id long, block long, bound double"
BLOCK = ("block long, n long, dim long, ids binary, vectors binary, term binary, first binary, row binary, "
         "weight binary, centre binary, radius double, greatest binary")


def term_rows(df: DataFrame, id_col: str, id_alias: str, text_col: str) -> DataFrame:
    """``(id, term)`` rows, one per token occurrence: the lower-cased text is split on runs
    of non-letter/digit characters and the empty edge pieces are dropped."""
    parts = F.split(F.lower(F.col(text_col)), r"[^\p{L}\p{N}]+")
    return (df.select(F.col(id_col).alias(id_alias), F.explode(parts).alias("term"))
            .filter(F.col("term") != ""))


def keyword_index(docs: DataFrame, doc_id: str = "doc_id", doc_text: str = "text"):
    """Term index of the corpus: ``tf (term, doc_id, tf)`` written once to the shared folder
    (tokenizing happens once), plus ``idf (term, idf)`` with ``idf = ln(1 + N / df)`` and
    ``norms (doc_id, dn)`` with ``dn = sqrt(sum((tf * idf)^2))`` derived from it. A term has one
    row per document, so even a stop word is a small share of the joined rows. The texts are dealt by
    ``doc_id``, not their terms one by one, so counting and adding up find a document's terms together."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(doc_text).alias("text")).repartition("doc_id")
    tf = term_rows(texts, "doc_id", "doc_id", "text").groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("tf"))
    tf = materialize(tf.select("term", "doc_id", "tf"), "term-counts")
    n_docs = float(docs.count())
    df = materialize(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term-documents")
    idf = df.select("term", F.log(1.0 + F.lit(n_docs) / F.col("df")).alias("idf"))
    # most terms of a large corpus are in one document: their idf is known and they take no part in the join
    common = df.filter("df > 1").select("term", F.log(1.0 + F.lit(n_docs) / F.col("df")).alias("idf"))
    w = F.col("tf") * F.coalesce("idf", F.log(1.0 + F.lit(n_docs) / F.lit(1)))
    norms = tf.join(common, "term", "left").groupBy("doc_id").agg(F.sqrt(F.sum(w * w)).alias("dn"))
    return tf, idf, norms


def _weighted_terms(rows: DataFrame, key: str) -> DataFrame:
    """``key, terms`` from (key, term, w): one row per key, a term as its hash, by hash."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(
        F.xxhash64("term").alias("t"), "w"))).alias("terms"))


def _keyword_sides(queries: DataFrame, docs: DataFrame, index) -> tuple[DataFrame, DataFrame]:
    """Unit term weights of the queries (query_id, terms) and of the documents (doc_id, terms);
    documents keep only terms that some query has, and only documents with such a term appear.
    Query terms absent from the corpus weigh nothing."""
    tf, idf, norms = index if index is not None else keyword_index(docs)
    counts = (term_rows(queries, "query_id", "query_id", "text")
              .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("n")))
    asked = materialize(counts.join(idf, "term").select(
        "query_id", "term", "idf", (F.col("n") * F.col("idf")).alias("w")), "query-terms")
    length = asked.groupBy("query_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("qn"))
    q = _weighted_terms(asked.join(length, "query_id").withColumn("w", F.col("w") / F.col("qn")), "query_id")
    held = tf.join(asked.select("term", "idf").distinct(), "term").select(
        "doc_id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    # a document's terms are one row before they meet its norm
    d = _weighted_terms(held, "doc_id").join(norms, "doc_id").select("doc_id", F.transform(
        "terms", lambda e: F.struct(e["t"].alias("t"), (e["w"] / F.col("dn")).alias("w"))).alias("terms"))
    return q, d


def _unit(vectors: pd.Series, width: int) -> np.ndarray:
    """The first ``width`` components of rows of length 1; a zero or missing vector is a row of zeros."""
    out = np.zeros((len(vectors), max([width, *(len(v) for v in vectors if v is not None)])))
    for i, v in enumerate(vectors):
        if v is not None:
            out[i, :len(v)] = v
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)[:, :width]


def _flat(columns: pd.Series, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The entries of array cells one after the other, and each one's row."""
    cells = [np.empty(0, kind) if c is None else np.asarray(c, kind) for c in columns]
    return (np.concatenate(cells) if cells else np.empty(0, kind)), np.repeat(np.arange(len(cells)), [len(c) for c in cells])


def _packed(key: tuple, d: pd.DataFrame) -> pd.DataFrame:
    """One block's row from its documents (doc_id, vec, t, w)."""
    d = d.sort_values("doc_id", kind="stable")
    dim = max((len(v) for v in d["vec"] if v is not None), default=0)
    vectors = _unit(d["vec"], dim)
    (term, row), (weight, _) = _flat(d["t"], np.int64), _flat(d["w"], np.float64)
    order = np.lexsort((row, -weight, term))  # by term, the heaviest first
    term, row, weight = term[order], row[order].astype(np.int32), weight[order]
    first = np.flatnonzero(np.diff(term, prepend=term[:1] - 1)) if len(term) else np.empty(0, np.int64)
    centre = vectors.mean(axis=0)
    radius = float(np.sqrt(((vectors - centre) ** 2).sum(axis=1).max()))
    return pd.DataFrame([{
        "block": key[0], "n": len(d), "dim": dim, "ids": d["doc_id"].to_numpy(np.int64).tobytes(), "vectors": vectors.tobytes(),
        "term": term[first].tobytes(), "first": np.append(first, len(term)).astype(np.int64).tobytes(), "row": row.tobytes(),
        "weight": weight.tobytes(), "centre": centre.tobytes(), "radius": radius, "greatest": weight[first].tobytes()}])


def vector_block(n: int) -> int:
    """Rows of a block in a search by vectors alone, out of ``n``: such a block is small, and each doubling
    halves the copies of the other side that are dealt to blocks."""
    return min(MOST_VECTORS, max(BLOCK_DOCS, math.ceil(n / FEW_BLOCKS)))


def blocks_of(docs: DataFrame, vectors_only: bool = False) -> tuple[DataFrame, int]:
    """The corpus as blocks (written), and how many numbers they have. ``docs`` are (doc_id, vec,
    terms), either side may be null. Like documents share a block; a group too large for one is
    dealt to several by a hash of the id."""
    n = docs.count()
    size = vector_block(n) if vectors_only else BLOCK_DOCS
    many = min(MAX_PIVOTS, max(1, math.ceil(n / size)))
    rows = docs.select("doc_id", "vec", F.col("terms.t").alias("t"), F.col("terms.w").alias("w"), _kind(docs, many).alias("kind"))
    if many == 1:  # all fit into one block
        dealt, at = rows.withColumn("block", F.lit(0).cast("long")), 1
    else:
        # a kind is cheaper to find twice than a document to write again
        # 2 * MAX_PIVOTS + 1 kinds at most, so the window without a partition is over few rows
        upto = Window.orderBy("kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        place = materialize(rows.groupBy("kind").agg(F.ceil(F.count(F.lit(1)) / size).alias("parts"))
                            .withColumn("at", F.sum("parts").over(upto) - F.col("parts")), "search-places")
        at = place.agg(F.sum("parts")).first()[0] or 1
        dealt = rows.join(place, "kind").withColumn("block", F.col("at") + F.pmod(F.xxhash64("doc_id"), F.col("parts")))
    return materialize(dealt.groupBy("block").applyInPandas(_packed, BLOCK), "search-blocks"), at


def _kind(docs: DataFrame, many: int) -> Column:
    """Below ``many``: the nearest of that many pivot vectors, which are the documents' with the least hashes of
    their ids. From there on, without a vector: by the heaviest term."""
    heaviest = F.array_max(F.transform("terms", lambda e: F.struct(e["w"], e["t"])))["t"]
    other = F.coalesce(F.pmod(heaviest, F.lit(many)), F.lit(many).cast("long")) + many
    if many == 1:
        return other
    least = docs.filter("vec IS NOT NULL").orderBy(F.xxhash64("doc_id")).limit(many)
    sample = least.agg(F.collect_list("vec")).first()[0]  # MAX_PIVOTS vectors at most
    if not sample:
        return other
    dim = max(map(len, sample))
    pivots = _unit(pd.Series(sample, dtype=object), dim)

    @F.pandas_udf("long")
    def nearest(vec: pd.Series, other: pd.Series) -> pd.Series:
        out = other.to_numpy(np.int64, copy=True)
        for a in range(0, len(vec), STRIP):
            part = vec.iloc[a:a + STRIP]
            found = (_unit(part, dim) @ pivots.T).argmax(axis=1)
            out[a:a + STRIP] = np.where([v is None for v in part], out[a:a + STRIP], found)
        return pd.Series(out)
    return nearest("vec", other)


def _query_terms(queries: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query row, term and weight of all terms of some queries."""
    (t, owner), (w, _) = _flat(queries["t"], np.int64), _flat(queries["w"], np.float64)
    return owner, t, w


def _found(sorted_terms: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end of each asked term's stretch."""
    return np.searchsorted(sorted_terms, asked, "left"), np.searchsorted(sorted_terms, asked, "right")


def _bounds(q: pd.DataFrame, h: pd.DataFrame, weight: float) -> np.ndarray:
    """The bound of each query (row) for each head (column)."""
    dim = int(h["dim"].max())
    centres = np.zeros((len(h), dim))
    for i, c in enumerate(h["centre"]):
        c = np.frombuffer(c)
        centres[i, :len(c)] = c
    vectors = _unit(q["vec"], dim)
    some = np.any(vectors != 0, axis=1)[:, None]
    vector = np.where(some, np.minimum(vectors @ centres.T + h["radius"].to_numpy(), 1.0), 0.0)
    terms = [np.frombuffer(t, np.int64) for t in h["term"]]
    term = np.concatenate(terms)
    block = np.repeat(np.arange(len(h)), [len(t) for t in terms])
    greatest = np.concatenate([np.frombuffer(g) for g in h["greatest"]])
    order = np.argsort(term, kind="stable")
    term, block, greatest = term[order], block[order], greatest[order]
    keyword = np.zeros((len(q), len(h)))
    owner, asked, w = _query_terms(q)
    for i, a, b, x in zip(owner, *_found(term, asked), w, strict=True):
        keyword[i, block[a:b]] += x * greatest[a:b]  # a term is once in a block
    return weight * vector + (1 - weight) * keyword


def _pairs(weight: float, least: float, matches: bool, seeds: bool):
    """Of the queries and heads that meet: each query's best block, or all others whose bound reaches
    the query's floor."""
    def pairs(q: pd.DataFrame, h: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(h):
            return pd.DataFrame({"query_id": np.empty(0, np.int64), "block": np.empty(0, np.int64), "bound": np.empty(0)})
        h = h.sort_values("block", kind="stable")
        bound = _bounds(q, h, weight)
        able = bound > 0 if matches else np.ones(bound.shape, bool)
        able &= bound >= least - MARGIN
        best = np.zeros(bound.shape, bool)
        best[np.arange(len(q)), bound.argmax(axis=1)] = True
        able &= best if seeds else ~best & (bound >= q["floor"].to_numpy()[:, None] - MARGIN)
        i, j = np.nonzero(able)
        return pd.DataFrame({"query_id": q["query_id"].to_numpy()[i], "block": h["block"].to_numpy()[j], "bound": bound[i, j]})
    return pairs


def _scorer(weight: float, k: int | None, threshold: float | None, only_matches: bool):
    def score(q: pd.DataFrame, d: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(d):
            block = d.iloc[0]
            ids, n, dim = np.frombuffer(block["ids"], np.int64), int(block["n"]), int(block["dim"])
            docs = np.frombuffer(block["vectors"]).reshape(n, dim)
            term, first = np.frombuffer(block["term"], np.int64), np.frombuffer(block["first"], np.int64)
            row, w = np.frombuffer(block["row"], np.int32), np.frombuffer(block["weight"])
            strip = max(1, min(STRIP, SCORES // max(n, 1)))
            for at in range(0, len(q), strip):
                part = q.iloc[at:at + strip]
                vector = _unit(part["vec"], dim) @ docs.T
                keyword = np.zeros(vector.shape)
                owner, asked, x = _query_terms(part)
                place = np.minimum(np.searchsorted(term, asked), max(len(term) - 1, 0))
                hit = term[place] == asked if len(term) else np.zeros(len(asked), bool)
                for i, p, weighs in zip(owner[hit].tolist(), place[hit].tolist(), x[hit].tolist(), strict=True):
                    a, b = first[p], first[p + 1]
                    keyword[i, row[a:b]] += weighs * w[a:b]
                fused = np.round(weight * vector + (1 - weight) * keyword, TIE_DIGITS)
                keep = keyword > 0 if only_matches else np.ones(fused.shape, bool)
                if threshold is not None:
                    keep &= fused >= threshold
                for i, query in enumerate(part["query_id"].to_numpy()):
                    pick = np.flatnonzero(keep[i])
                    if k is not None and len(pick) > k:
                        edge = np.partition(fused[i, pick], len(pick) - k)[len(pick) - k]
                        pick = pick[fused[i, pick] >= edge]
                    pick = pick[np.argsort(-fused[i, pick], kind="stable")][:k]
                    out.append((np.full(len(pick), query), ids[pick], vector[i, pick], keyword[i, pick], fused[i, pick]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.empty(0, t) for t in (np.int64, np.int64, float, float, float)]
        return pd.DataFrame(dict(zip(("query_id", "doc_id", "vector_score", "keyword_score", "score"), columns, strict=True)))
    return score


def _each(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


class Search:
    """One search: the queries against the blocks, in two steps (see the module's text). ``seeds`` and
    ``rest`` are the (query, block) pairs that are scored; every other pair is skipped."""

    def __init__(self, queries: DataFrame, blocks: tuple[DataFrame, int], weight: float, k: int | None,
                 threshold: float | None = None, only_matches: bool = False, vectors_only: bool = False):
        self.args = weight, k, threshold, only_matches
        self.blocks, self.n_blocks = blocks
        n = queries.count()
        self.groups = max(1, math.ceil(n / (vector_block(n) if vectors_only else BLOCK_QUERIES)))
        self.queries = queries.select("query_id", "vec", F.col("terms.t").alias("t"), F.col("terms.w").alias("w"),
                                      F.pmod(F.xxhash64("query_id"), F.lit(self.groups)).alias("qb"))
        self.seeds = self._meet(self.queries, True)
        if self.n_blocks == 1:  # every query's best block is the only one
            self.rest, self.found = self.seeds.limit(0), self._score(self.seeds)
            return
        first = materialize(self._score(self.seeds), "search-first")
        if k is None:
            floor = self.queries.withColumn("floor", F.lit(float("-inf")))
        else:
            rank = Window.partitionBy("query_id").orderBy(F.col("score").desc())
            kth = first.withColumn("r", F.row_number().over(rank)).filter(F.col("r") == k).select("query_id", F.col("score").alias("floor"))
            floor = self.queries.join(kth, "query_id", "left").fillna(float("-inf"), ["floor"])
        self.rest = self._meet(floor, False)
        self.found = first.unionByName(self._score(self.rest))

    def _meet(self, queries: DataFrame, seeds: bool) -> DataFrame:
        weight, _, threshold, matches = self.args
        chunks = max(1, math.ceil(self.n_blocks / BLOCK_HEADS))
        heads = self.blocks.select("block", "dim", "term", "centre", "radius", "greatest",
                                   F.pmod("block", F.lit(chunks)).alias("hb"), _each(self.groups).alias("qb"))
        heads = heads.toDF(*heads.columns)
        q = queries.withColumn("hb", _each(chunks))
        least = threshold if threshold is not None else float("-inf")
        return q.groupBy("qb", "hb").cogroup(heads.groupBy("qb", "hb")).applyInPandas(_pairs(weight, least, matches, seeds), PAIR)

    def _score(self, pairs: DataFrame) -> DataFrame:
        asked = pairs.select("query_id", "block").join(self.queries, "query_id")
        met = asked.select("block", "qb").distinct()
        held = self.blocks.select("block", "n", "dim", "ids", "vectors", "term", "first", "row", "weight").join(met, "block")
        held = held.toDF(*held.columns)
        return asked.groupBy("block", "qb").cogroup(held.groupBy("block", "qb")).applyInPandas(_scorer(*self.args), SCORED)


def score_blocks(queries: DataFrame, docs: DataFrame, weight: float, k: int | None,
                 threshold: float | None = None, only_matches: bool = False, vectors_only: bool = False) -> DataFrame:
    """Best ``k`` documents (all, with None) of each query and every block that can hold one of its best:
    ``query_id, doc_id, vector_score, keyword_score, score``. ``queries`` are (query_id, vec,
    terms), ``docs`` (doc_id, vec, terms); a missing side of either counts 0."""
    return Search(materialize(queries, "search-queries"), blocks_of(materialize(docs, "search-docs"), vectors_only),
                  weight, k, threshold, only_matches, vectors_only).found


def _none(kind: str) -> Column:
    return F.lit(None).cast(kind)


def vector_top_k(queries: DataFrame, corpus: DataFrame, k: int = 2, query_id: str = "query_id",
                 doc_id: str = "doc_id", vec: str = "embedding") -> DataFrame:
    """Exact cosine top-k per query: ``query_id, doc_id, vector_score, rank``. A zero vector
    scores 0, rows without a vector take no part. Ties go to the lower ``doc_id``."""
    def side(df, key, name):
        return df.filter(F.col(vec).isNotNull()).select(
            F.col(key).alias(name), F.col(vec).cast("array<double>").alias("vec"), _none(TERMS).alias("terms"))
    found = score_blocks(side(queries, query_id, "query_id"), side(corpus, doc_id, "doc_id"), 1.0, k, vectors_only=True)
    return top_k(found, k).select("query_id", "doc_id", "vector_score", "rank")


def keyword_top_k(queries: DataFrame, docs: DataFrame, k: int = 2, index=None) -> DataFrame:
    """TF-IDF cosine in [0, 1], top-k per query among the documents that share a term with it:
    ``query_id, doc_id, keyword_score, rank``. Terms are lower-cased letter/digit runs."""
    q, d = _keyword_sides(queries, docs, index)
    found = score_blocks(q.withColumn("vec", _none("array<double>")), d.withColumn("vec", _none("array<double>")), 0.0, k, only_matches=True)
    return top_k(found, k).select("query_id", "doc_id", "keyword_score", "rank")


def hybrid_scores(queries: DataFrame, docs: DataFrame, vectors: DataFrame, weight: float = 0.7,
                  k: int | None = 2, threshold: float | None = None, index=None) -> DataFrame:
    """``score = w * vector + (1 - w) * keyword`` with ``w`` rounded to two digits, for each query
    the best ``k`` of every document block that reach the threshold. A document or query without a
    vector or without common terms counts 0 there."""
    if not 0.0 <= weight <= 1.0:
        raise ValueError("weight must lie in [0, 1]")
    qt, dt = _keyword_sides(queries, docs, index)
    q = queries.select("query_id", F.col("embedding").cast("array<double>").alias("vec")).join(qt, "query_id", "left")
    ids = docs.select("doc_id").unionByName(vectors.select("doc_id")).distinct()
    v = vectors.select("doc_id", F.col("embedding").cast("array<double>").alias("vec"))
    d = ids.join(dt, "doc_id", "left").join(v, "doc_id", "left")
    return score_blocks(q, d, round(weight, 2), k, threshold)


def above(df: DataFrame, threshold: float = 0.7, enabled: bool = True,
          score: str = "score") -> DataFrame:
    return df.filter(F.col(score) >= threshold) if enabled else df


def top_k(df: DataFrame, k: int = 2, score: str = "score", key: str = "query_id",
          tie: str = "doc_id") -> DataFrame:
    """k best rows per query, ties to the lower id; adds ``rank``. The row_number filter
    plans a partial top-k before the shuffle (WindowGroupLimit)."""
    w = Window.partitionBy(key).orderBy(F.col(score).desc(), F.col(tie).asc())
    return df.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= k)


def retrieve(queries: DataFrame, docs: DataFrame, vectors: DataFrame, method: str = "hybrid",
             k: int = 2, weight: float = 0.7, threshold: float = 0.7,
             threshold_enabled: bool = True) -> DataFrame:
    """Semantic, keyword or hybrid retrieval. ``queries``: query_id, text, embedding;
    ``docs``: doc_id, text; ``vectors``: doc_id, embedding. Null embeddings are allowed."""
    if method not in ("semantic", "keyword", "hybrid"):
        raise ValueError("method must be semantic, keyword or hybrid")
    if method == "semantic" or (method == "hybrid" and weight >= 1.0):
        res = vector_top_k(queries, vectors, k).select("query_id", "doc_id", F.col("vector_score").alias("score"))
    elif method == "keyword" or (method == "hybrid" and weight <= 0.0):
        res = keyword_top_k(queries, docs, k).select("query_id", "doc_id", F.col("keyword_score").alias("score"))
    else:
        res = hybrid_scores(queries, docs, vectors, weight, k, threshold if threshold_enabled else None)
    return top_k(above(res, threshold, threshold_enabled), k)
