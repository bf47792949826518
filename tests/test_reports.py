"""Report and budget goldens (FIXTURES.md)."""

import datetime as dt

from sitecorpus.operators.duplicates import duplicate_breakdown
from sitecorpus.operators.reports import crawl_summary, failed_urls, progress, within_budget
from sitecorpus.sinks.files import write_reports


def _outcomes(spark, oks):
    return spark.createDataFrame([(0, i + 1, f"u{i}", ok) for i, ok in enumerate(oks)],
                                 "crawl_id long, url_index long, url string, ok boolean")


def test_rate_rounding_and_na(spark):
    row = crawl_summary(_outcomes(spark, [True] + [False] * 15)).first()
    assert row.success_rate == 6.25
    empty = {"total_urls": 0, "successful": 0, "failed": 0, "success_rate": None}


def test_unique_files_reported_can_go_negative(spark):
    stats = spark.createDataFrame([(0, "T", 3, 3, "t")],
                                  "crawl_id long, title string, total_files long, moved_files long, folder string")
    row = crawl_summary(_outcomes(spark, []).limit(0), stats).first()
    assert row.total_urls == 0 and row.unique_files_reported == -3


def test_progress_running_totals(spark):
    rows = progress(_outcomes(spark, [True, False, True]), bucket=2).orderBy("url_index").collect()
    assert [(r.processed, r.successful, r.failed) for r in rows] == [(1, 1, 0), (2, 1, 1), (3, 2, 1)]


def test_time_budget(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(0, i + 1, t0 + dt.timedelta(seconds=s)) for i, s in enumerate([0, 5, 10, 11])],
                               "crawl_id long, url_index long, started_at timestamp")
    assert within_budget(df, 10).count() == 3
    assert within_budget(df, 0).count() == 4


def test_percent_is_rounded_half_even_on_the_exact_value(spark, tmp_path):
    fine = {0: 1, 1: 5, 2: 3, 3: 15, 4: 16, 5: 0}  # of 16; 35 of 100 and others below
    rows = [(c, i + 1, f"u{i}", i < n) for c, n in fine.items() for i in range(16)]
    rows += [(10 + n, i + 1, f"v{i}", i < n) for n in (1, 7, 123, 399) for i in range(400)]
    outcomes = spark.createDataFrame(rows, "crawl_id long, url_index long, url string, ok boolean")
    stats = spark.createDataFrame([], "crawl_id long, title string, total_files long, moved_files long, folder string")
    write_reports(crawl_summary(outcomes, stats), failed_urls(outcomes), duplicate_breakdown(stats), str(tmp_path / "r"), "now")
    got = {r.crawl_id: r.value.split("\t")[1] for r in spark.read.text(str(tmp_path / "r" / "crawl_summary")).collect()
           if r.value.startswith("fetched_percent")}
    want = {c: f"{n / 16 * 100:.1f}" for c, n in fine.items()} | {10 + n: f"{n / 400 * 100:.1f}" for n in (1, 7, 123, 399)}
    assert got == want and got[0] == "6.2" and got[1] == "31.2" and got[2] == "18.8"
