"""Mixing sources to target weights, in DataFrame operations only.

Method: the documents' sizes (words) are added up per source; each source's target is its weight's
share of the whole, held to ``MOST`` times its size, with the excess reshared by weight until no
source is above. A source's repetition rate is target / size, and a document is taken floor(rate)
times plus once more with probability equal to the rate's fraction, drawn from a hash of the seed
and the row, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitecorpus.llm.stored import store

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in order, repeating
MOST = 3.0
SEED = 20


def n_words(text: str) -> Column:
    """Words: runs of bytes other than space and 0x09-0x0D."""
    trimmed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"^[\x20\x09-\x0D]+", "")
    parts = F.size(F.split(trimmed, r"[\x20\x09-\x0D]+", -1))
    return F.when(F.length(trimmed) == 0, 0).otherwise(
        parts - F.when(trimmed.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)).cast("long")


def _draw(seed: int, key: Column) -> Column:
    """A number from 0 to below 1: the first 52 bits of an MD5 hash."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), key).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target) for (source, source_size), one row per source.

    Sources by code point, null last, take the weights in turn. The targets are min(most * size,
    level * weight) with one level at which they add up to the whole: the sources sorted by
    size / weight are capped from the smallest on, as long as the level for the rest, had they all
    the remainder, is above their own cap. The table of sources is small, so one window sorts it."""
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    ranked = sizes.withColumn("weight", F.element_at(
        F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(most))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # level if this source and all after it are not capped, and all before it are
    ranked = ranked.withColumn("level", (
        F.sum("source_size").over(everything)
        - F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    open_ = ranked.withColumn("free", F.col("level") * F.col("weight") <= F.col("cap"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source", "level"))
                  ).over(everything)["level"]
    return open_.select("source", "source_size", F.when(level.isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), level * F.col("weight"))).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST, seed: int = SEED,
        key: str = "doc_id", source: str = "source", text: str = "text",
        keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``keep`` columns, source, size, source_size, target
    and copies (how often the mix takes it).

    A null source is a source of its own, last in order. A null or empty text has size 0 and a
    source of such texts alone has target 0 and gives no copies. Repeated rows are drawn alike; a
    null key is drawn by its text. An empty table gives an empty result."""
    rows = docs.select(F.col(key).alias("doc_id"), *(keep or []), F.col(source).alias("source"), n_words(text).alias("size"),
                       _draw(seed, F.coalesce(F.col(key).cast("string"), F.col(text))).alias("draw"))
    if not keep:
        rows = store(rows, "mix-sizes")  # narrow: the texts are read once
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rates = store(targets(sizes, weights, most), "mix-targets").withColumnRenamed("source", "of")
    out = rows.join(rates, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(most))).otherwise(0.0)
    return out.withColumn("copies", (F.floor(rate) + (F.col("draw") < rate - F.floor(rate)).cast("long"))).drop("draw")
