"""Crawl reports: summary, failed URLs, progress after each URL, time budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

PROGRESS_BUCKET = 100_000


def crawl_summary(outcomes: DataFrame, dup_stats: DataFrame | None = None,
                  retained: DataFrame | None = None, key: str = "crawl_id") -> DataFrame:
    """Per crawl: ``total_urls, successful, failed, success_rate`` (percent, null when no
    URL was processed), ``duplicate_files, duplicate_titles``,
    ``unique_files_reported`` (successful − moved, as the original report computes it) and
    ``unique_files`` (records actually retained, when ``retained`` is given).

    ``dup_stats`` and ``retained`` carry the same ``key``; all inputs are reduced to one row
    per crawl before they are joined."""
    base = outcomes.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_urls"),
        F.count(F.when(F.col("ok"), 1)).alias("successful"),
        F.count(F.when(~F.col("ok"), 1)).alias("failed"))
    return summary_of_counts(base, dup_stats, retained, key)


def summary_of_counts(base: DataFrame, dup_stats: DataFrame | None = None, retained: DataFrame | None = None,
                      key: str = "crawl_id") -> DataFrame:
    """:func:`crawl_summary` from counts per crawl (``total_urls, successful, failed``), for example those
    gathered while the outcomes were written (:mod:`sitecorpus.operators.metrics`)."""
    out = base.withColumn("success_rate", F.when(
        F.col("total_urls") > 0, F.col("successful") / F.col("total_urls") * 100.0))
    if dup_stats is not None:
        d = dup_stats.groupBy(key).agg(
            F.sum("moved_files").cast("long").alias("duplicate_files"),
            F.count(F.lit(1)).alias("duplicate_titles"))
        out = out.join(d, key, "full")
    else:
        out = out.withColumn("duplicate_files", F.lit(0).cast("long")).withColumn(
            "duplicate_titles", F.lit(0).cast("long"))
    out = out.fillna(0, ["total_urls", "successful", "failed", "duplicate_files",
                         "duplicate_titles"])
    out = out.withColumn("unique_files_reported", F.col("successful") - F.col("duplicate_files"))
    if retained is not None:
        r = retained.groupBy(key).agg(F.count(F.lit(1)).alias("unique_files"))
        out = out.join(r, key, "left").fillna(0, ["unique_files"])
    return out


def failed_urls(outcomes: DataFrame, key: str = "crawl_id") -> DataFrame:
    """Failed URLs in crawl order with the crawl's failure total."""
    failed = outcomes.filter(~F.col("ok"))
    totals = failed.groupBy(key).agg(F.count(F.lit(1)).alias("total_failed"))
    return (failed.join(totals, key).select(key, "url_index", "url", "total_failed")
            .orderBy(key, "url_index"))


def progress(outcomes: DataFrame, key: str = "crawl_id", order: str = "url_index",
             bucket: int = PROGRESS_BUCKET) -> DataFrame:
    """Running ``processed, successful, failed, success_rate`` after each URL.

    Two levels, so that no task holds a whole crawl: counts per (crawl, bucket of
    ``bucket`` positions), running offsets over the (small) bucket table, then a running
    window inside each bucket plus its offset."""
    rows = outcomes.select(key, order, F.col("ok").cast("int").alias("_ok"),
                           F.floor(F.col(order) / bucket).alias("_b"))
    per_bucket = rows.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n"), F.sum("_ok").alias("_s"))
    wb = Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(key, "_b", F.coalesce(F.sum("_n").over(wb), F.lit(0)).alias("_n0"),
                                F.coalesce(F.sum("_s").over(wb), F.lit(0)).alias("_s0"))
    w = Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    running = rows.select(key, order, "_b", F.count(F.lit(1)).over(w).alias("_n"),
                          F.sum("_ok").over(w).alias("_s"))
    joined = running.join(offsets, [key, "_b"])
    processed = F.col("_n") + F.col("_n0")
    ok = (F.col("_s") + F.col("_s0")).cast("long")
    return joined.select(key, order, processed.alias("processed"), ok.alias("successful"),
                         (processed - ok).alias("failed"),
                         (ok / processed * 100.0).alias("success_rate"))


def within_budget(attempts: DataFrame, seconds: int, key: str = "crawl_id",
                  order: str = "url_index", start_col: str = "started_at") -> DataFrame:
    """URLs started at most ``seconds`` after their crawl started (0 = no limit).

    Start times rise with crawl order, so keeping the URLs within the budget is the same as
    stopping at the first URL beyond it."""
    if seconds <= 0:
        return attempts
    starts = attempts.groupBy(key).agg(F.min(start_col).alias("_t0"))
    joined = attempts.join(starts, key)
    within = F.timestamp_diff("MICROSECOND", F.col("_t0"), F.col(start_col)) <= seconds * 1_000_000
    return joined.filter(within).drop("_t0")
