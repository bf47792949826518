"""Duplicate-title analysis and routing (keys, stats, folders, routing, breakdown).

Only narrow key columns are shuffled: counts are computed on (key, filename, url_index) rows
and joined back, so page bodies never enter an exchange unless the joined-back side is too
big to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitecorpus.functions.text import slug


def with_title_key(df: DataFrame, meta_col: str = "meta", stem_col: str = "stem",
                   title_col: str | None = None) -> DataFrame:
    """``title_key``: the title when the title key is present (even ``""``), else the stem.

    With ``title_col`` the title comes from a plain column (null = absent); otherwise from
    a ``map<string,string>`` of parsed frontmatter. A present-but-null title never counts
    as a duplicate and is flagged ``bad_title``.
    """
    if title_col is not None:
        has, val = F.col(title_col).isNotNull(), F.col(title_col)
    else:
        m = F.col(meta_col)
        has = F.coalesce(F.map_contains_key(m, F.lit("title")), F.lit(False))
        val = F.try_element_at(m, F.lit("title"))
    key = F.when(has, val).otherwise(F.col(stem_col))
    err = F.when(has & val.isNull(), F.lit("bad_title"))
    out = df.withColumn("title_key", key)
    if "error" in df.columns:
        return out.withColumn("error", F.coalesce(F.col("error"), err))
    return out.withColumn("error", err)


def latest_pages(df: DataFrame, key: str = "filename", order: str = "url_index") -> DataFrame:
    """For each ``key`` keep only the row with the greatest ``order`` (later writes win); of rows tied on
    both, the one with the least hash of all columns (rows equal in every column are one page and all
    stay). Rows without a key all stay.

    Only narrow rows are aggregated (partial aggregation before the shuffle): (key, order), and for the
    tied (key, hash). The keys that collide — usually few — are joined back (broadcast by Spark when
    they are small in bytes, so the wide page rows are then not shuffled).
    """
    mark = F.xxhash64(*[F.col(c) for c in df.columns if df.schema[c].dataType.typeName() not in ("map", "variant")])
    each = df.groupBy(key, order).agg(F.count(F.lit(1)).alias("_n"))
    top = (each.groupBy(key).agg(F.max(F.struct(F.col(order).alias("_keep"), "_n")).alias("_top"), F.sum("_n").alias("_all"))
           .filter("_all > 1").select(F.col(key).alias("_key"), "_top._keep", "_top._n"))
    # without ties Spark finds this join empty and drops the branch
    ties = top.filter("_n > 1").select(F.col("_key").alias("_tied"), F.col("_keep").alias("_last"))
    marks = (df.join(ties, (F.col(key) == F.col("_tied")) & (F.col(order) == F.col("_last")))
             .select("_tied", mark.alias("_mark")).groupBy("_tied").agg(F.min("_mark").alias("_mark")))
    collisions = top.join(marks, F.col("_key") == F.col("_tied"), "left").select("_key", "_keep", "_mark")
    joined = df.join(collisions, F.col(key) == F.col("_key"), "left")
    last = (F.col(order) == F.col("_keep")) & (F.col("_mark").isNull() | (mark == F.col("_mark")))
    return joined.filter(F.col("_keep").isNull() | last).select(df.columns)


def duplicate_titles(df: DataFrame, key: str = "title_key", keep: str = "none",
                     order: str = "url_index", tie: str = "filename",
                     by: list[str] | tuple = ()) -> DataFrame:
    """Stats per repeated title: ``title, total_files, moved_files, folder`` (+ first member
    when ``keep='first'``). Partial aggregation before the shuffle absorbs heavy titles."""
    if keep not in ("none", "first"):
        raise ValueError("keep must be 'none' or 'first'")
    valid = df.filter(F.col(key).isNotNull())
    aggs = [F.count(F.lit(1)).alias("total_files")]
    if keep == "first":
        aggs.append(F.min(F.struct(F.col(order).alias("o"), F.col(tie).alias("t"))).alias("_first"))
    stats = valid.groupBy(*by, F.col(key).alias("title")).agg(*aggs).filter("total_files > 1")
    moved = F.col("total_files") if keep == "none" else F.col("total_files") - 1
    stats = stats.withColumn("moved_files", moved).withColumn("folder", slug(F.col("title")))
    if keep == "first":
        stats = stats.select(*by, "title", "total_files", "moved_files", "folder",
                             F.col("_first.o").alias("keep_" + order),
                             F.col("_first.t").alias("keep_" + tie))
    return stats


def route_duplicates(df: DataFrame, key: str = "title_key", keep: str = "none",
                     order: str = "url_index", tie: str = "filename",
                     stats: DataFrame | None = None, by: list[str] | tuple = ()) -> DataFrame:
    """Add ``is_duplicate`` and ``folder`` to every page.

    The stats side has one row per repeated title: Spark broadcasts it when it is small in
    bytes and otherwise splits a heavy title's partition. No window over the title is used, so
    a heavy title never lands whole on one task.
    """
    if stats is None:
        stats = duplicate_titles(df, key=key, keep=keep, order=order, tie=tie, by=by)
    cols = [*by, "title", "folder"] + ([f"keep_{order}", f"keep_{tie}"] if keep == "first" else [])
    side = stats.select(*cols).withColumnRenamed("title", "_tk")
    cond = df[key] == side["_tk"]
    for b in by:
        side = side.withColumnRenamed(b, f"_by_{b}")
        cond = cond & (df[b] == side[f"_by_{b}"])
    joined = df.join(side, cond, "left").drop(*[f"_by_{b}" for b in by])
    routed = F.col("_tk").isNotNull()
    if keep == "first":
        routed = routed & ~((F.col(order) == F.col(f"keep_{order}"))
                            & (F.col(tie) == F.col(f"keep_{tie}")))
    out = joined.withColumn("is_duplicate", routed).withColumn(
        "folder", F.when(routed, F.col("folder")))
    return out.drop("_tk", f"keep_{order}", f"keep_{tie}")


def duplicate_breakdown(stats: DataFrame, limit: int | None = None) -> DataFrame:
    """Stats by ``total_files`` descending, ties by title ascending."""
    out = stats.orderBy(F.col("total_files").desc(), F.col("title").asc())
    return out.limit(limit) if limit is not None else out


def route_increment(retained: DataFrame, batch: DataFrame, run_col: str = "run",
                    key: str = "filename", order: str = "url_index",
                    title_col: str = "title_key") -> DataFrame:
    """One later run: duplicates are judged over *retained ∪ new* only (pages routed out
    earlier are not looked at, so a title whose copies were all archived can come back).
    A new page replaces a retained one with the same file name first; later runs win, then
    later positions."""
    both = retained.unionByName(batch, allowMissingColumns=True)
    both = both.withColumn("_seq", F.struct(F.col(run_col), F.col(order)))
    latest = latest_pages(both, key=key, order="_seq").drop("_seq")
    return route_duplicates(latest, key=title_col)
