"""Connected components of a graph given as DataFrames, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitecorpus.llm.stored import store


def _simple(edges: DataFrame) -> DataFrame:
    """Each edge once (a < b), without loops."""
    return store(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")


def _parents(edges: DataFrame) -> DataFrame:
    """(node, root): each node follows its smallest neighbour, as long as that is smaller than itself, to the
    end. A step doubles what a node has followed; edges take no part in it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = store(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                .select("node", F.least("node", "low").alias("root")), "roots")
    while True:
        jump = now.select(F.col("node").alias("root"), F.col("root").alias("far"))
        new = store(now.join(jump, "root").select("node", F.col("far").alias("root"), (F.col("far") < F.col("root")).alias("moved")), "roots")
        now = new.select("node", "root")
        if not new.filter("moved").head(1):
            return now


def _renamed(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """The edges between the roots of their ends (an end without a root stays)."""
    one = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    two = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    return edges.join(one, "a", "left").join(two, "b", "left").select(
        F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long; either direction, repeats allowed);
    ``root`` is the smallest node that it reaches.

    Each round merges the nodes that follow each other to one smallest node and keeps the distinct edges
    between what is left, so a dense group's edges are read once and then are gone. Rounds are written
    tables and end when no edge is left."""
    rest, rounds = _simple(edges), []
    while rest.head(1):
        rounds.append(_parents(rest))
        rest = _simple(_renamed(rest, rounds[-1]))
    if not rounds:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = rounds.pop()
    while rounds:
        out = _followed(rounds.pop(), out)
    return store(out, "components")


def _followed(roots: DataFrame, later: DataFrame) -> DataFrame:
    """``roots`` with the roots of their roots."""
    far = later.select(F.col("node").alias("root"), F.col("root").alias("far"))
    return roots.join(far, "root", "left").select("node", F.coalesce("far", "root").alias("root"))


def extended(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """The components after ``edges`` are added to those that ``roots`` (node, root) states; the edges that
    gave these are not needed any more."""
    merged = components(_renamed(edges, roots))
    old = _followed(roots, merged)
    return store(old.unionByName(merged.join(roots.select("node"), "node", "left_anti")), "components")
