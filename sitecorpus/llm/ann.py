"""Approximate nearest neighbours with an inverted multi-index.

Method: the two halves of a vector are quantised separately, so K + K centroids make K * K cells.
For a query, the pairs of centroids are visited by the sum of the two half distances (a heap over
the sorted half lists), until the cells visited hold ``probe`` of all vectors; the entries of
those cells are compared exactly.

The codebooks are fitted on a bounded sample; every vector is indexed. Vectors lie in blocks by the
first half's centroid, large ones dealt into several; a query goes to the blocks it visits with
the list of second-half centroids, and each block returns its best ``k`` for each query.
"""

from __future__ import annotations

import dataclasses
import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sitecorpus.llm.stored import store

CENTROIDS = 64          # of each half
SAMPLE_ROWS = 16_384    # vectors the codebooks are fitted on, about
PROBE = 0.5             # share of the vectors in the visited cells
BLOCK_ROWS = 8_192      # vectors of a block, about
QUERY_ROWS = 4_096      # queries of a block, about


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances, by the expanded product."""
    return (x ** 2).sum(1)[:, None] + (y ** 2).sum(1)[None, :] - 2 * (x @ y.T)


def _kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Up to k centroids, whatever the order of the rows."""
    if not x.shape[1]:
        return np.zeros((1, 0))
    x = x[np.lexsort(x.T)]
    distinct = np.unique(x, axis=0)
    centers = distinct[np.random.default_rng(5).permutation(len(distinct))[:k]]
    for _ in range(rounds):
        near = _near(x, centers).argmin(1)
        size = np.bincount(near, minlength=len(centers))
        total = np.stack([np.bincount(near, x[:, d], len(centers)) for d in range(x.shape[1])], 1)
        centers = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centers)
    return centers


@dataclasses.dataclass
class Codebooks:
    first: np.ndarray
    second: np.ndarray

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each half to its centroids."""
        cut = self.first.shape[1]
        return _near(x[:, :cut], self.first), _near(x[:, cut:], self.second)

    def visit(self, x: np.ndarray, population: np.ndarray, want: float) -> list[dict[int, int]]:
        """For each vector, the cells to visit: second-half centroids (as bits) by first."""
        out = []
        for a, b in zip(*self.halves(x), strict=True):
            i, j = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
            a, b = a[i], b[j]
            heap, cells, held = [(a[0] + b[0], 0, 0)], {}, 0
            while heap and held < want:
                _, p, q = heapq.heappop(heap)
                r, s = int(i[p]), int(j[q])
                cells[r] = cells.get(r, 0) | 1 << s
                held += population[r, s]
                if q + 1 < len(b):
                    heapq.heappush(heap, (a[p] + b[q + 1], p, q + 1))
                if q == 0 and p + 1 < len(a):
                    heapq.heappush(heap, (a[p + 1] + b[0], p + 1, 0))
            out.append(cells)
        return out


def _usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _best(q: np.ndarray, q_ids: np.ndarray, allowed: np.ndarray, v: np.ndarray, v_ids: np.ndarray,
          k: int) -> list[tuple]:
    """(query, vector, distance) of each query's k nearest allowed vectors. The expanded product
    finds all that may be among them, differences decide."""
    out = []
    for at in range(0, len(q), 256):
        part = q[at:at + 256]
        d = _near(part, v)
        slack = 1e-9 * ((part ** 2).sum(1)[:, None] + (v ** 2).sum(1)[None, :])
        d[~allowed[at:at + 256]] = np.inf
        for r in range(len(part)):
            ok = np.isfinite(d[r])
            if not ok.any():
                continue
            edge = np.partition(d[r], min(k, ok.sum()) - 1)[min(k, ok.sum()) - 1]
            pick = np.flatnonzero(d[r] - slack[r] <= edge + slack[r].max())
            pick = pick[ok[pick]]
            exact = np.sqrt(((v[pick] - part[r]) ** 2).sum(1))
            order = np.lexsort((v_ids[pick], exact))[:k]
            out += [(int(q_ids[at + r]), int(v_ids[pick[o]]), float(exact[o])) for o in order]
    return out


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, probe: float = PROBE, key: str = "vec_id",
            vector: str = "embedding", centroids: int = CENTROIDS, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row where ``is_query``,
    by Euclidean distance and then smaller id; a query's own id is no candidate.

    Rows with a null key and vectors that are null, zero, of another length than most, or hold a
    null or non-finite component take no part. Rows of one id count as one, with the least of their vectors
    (by components in order), which asks if any of them does. With fewer
    candidates than ``k`` all of the visited cells are returned, and for so few rows all cells are
    visited. An empty table, or one without queries, gives an empty result; other columns are
    ignored."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = (vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"),
                           F.coalesce(is_query, F.lit(False)).alias("asks"))
            .filter(F.col("vec_id").isNotNull() & _usable(F.col("v"))))
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").head(1)
    if not lengths:
        return spark.createDataFrame([], schema)
    rows = rows.filter(F.size("v") == lengths[0]["n"]).groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    rows = store(rows, "ann-rows")
    total = rows.count()
    share = min(1.0, sample_rows / total)
    sample = _matrix(rows.filter(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) <= share * (1 << 30))
                     .select("v").limit(2 * sample_rows).toPandas()["v"])
    cut = max(1, sample.shape[1] // 2)
    books = Codebooks(_kmeans(sample[:, :cut], centroids), _kmeans(sample[:, cut:], centroids))

    @F.pandas_udf("int")
    def cell(column: pd.Series) -> pd.Series:
        a, b = books.halves(_matrix(column))
        return pd.Series((a.argmin(1) * len(books.second) + b.argmin(1)).astype(np.int32))

    indexed = store(rows.withColumn("cell", cell("v")), "ann-cells")
    population = np.zeros(len(books.first) * len(books.second), np.int64)
    for c, n in indexed.groupBy("cell").count().collect():  # as many rows as cells at most
        population[c] = n
    population = population.reshape(len(books.first), -1)
    dealt = np.maximum(1, -(-population.sum(1) // BLOCK_ROWS))
    groups = max(1, math.ceil(indexed.filter("asks").count() / QUERY_ROWS))
    want = max(probe * total, min(total, 50 * k))

    def send(parts):
        for part in parts:
            found = books.visit(_matrix(part["v"]), population, want)
            out = [(i, a, s, bits.to_bytes(len(books.second) // 8 + 1, "little"), v)
                   for i, v, cells in zip(part["vec_id"], part["v"], found, strict=True)
                   for a, bits in cells.items() for s in range(dealt[a])]
            yield pd.DataFrame(out, columns=["query_id", "first", "sub", "seconds", "v"])

    n_second = len(books.second)
    asked = (indexed.filter("asks").select("vec_id", "v")
             .mapInPandas(send, "query_id long, first int, sub int, seconds binary, v array<double>")
             .withColumn("group", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")))
    first = F.floor(F.col("cell") / n_second).cast("int")
    held = indexed.select("vec_id", "v", first.alias("first"), (F.col("cell") % n_second).alias("second"),
                          F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    subs = F.element_at(F.array(*[F.lit(int(n)) for n in dealt]), F.col("first") + 1)
    held = held.withColumn("sub", F.pmod(F.xxhash64("vec_id"), subs).cast("int"))

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            v, ids, second = _matrix(b["v"]), b["vec_id"].to_numpy(), b["second"].to_numpy()
            for at in range(0, len(a), 512):
                q = a.iloc[at:at + 512]
                bits = np.stack([np.unpackbits(np.frombuffer(x, np.uint8), bitorder="little") for x in q["seconds"]])
                allowed = bits[:, second].astype(bool) & (q["query_id"].to_numpy()[:, None] != ids[None, :])
                out += _best(_matrix(q["v"]), q["query_id"].to_numpy(), allowed, v, ids, k)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    by = ["first", "sub", "group"]
    found = asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInPandas(
        compare, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
