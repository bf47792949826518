"""Counts gathered while rows are written, and attempts that lie where they are needed."""

import time
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitecorpus.operators.metrics import LiveCounts, ObservedOutcomes, observe_stream
from sitecorpus.operators.reports import crawl_summary, summary_of_counts
from sitecorpus.operators.responses import resolve_attempts
from sitecorpus.plans import jobs
from sitecorpus.plans.catalog import table
from sitecorpus.plans.frontier import ATTEMPT_ORDER, event_attempts, event_outcomes
from sitecorpus.plans.sizing import materialize
from sitecorpus.session import shared_path
from sitecorpus.sources.bucketed import ALL_KEYS, by_part_of_the_key, store_bucketed


def _rows(df):
    return sorted(map(str, df.collect()))


def test_observed_counts_equal_the_summary(spark):
    outcomes = event_outcomes(table(spark, SF_SMALL, "events"))
    stats = spark.createDataFrame([(0, "T", 3, 3, "t"), (9, "U", 2, 2, "u")],
                                  "crawl_id long, title string, total_files long, moved_files long, folder string")
    counted = ObservedOutcomes(outcomes, [0, 1, 2, 3, 7])
    written = materialize(counted.rows, "outcomes")
    got = summary_of_counts(counted.counts(), stats)
    assert _rows(got) == _rows(crawl_summary(written, stats).select(got.columns))
    plan = summary_of_counts(counted.counts())._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan  # no second pass over the outcomes
    empty = ObservedOutcomes(outcomes.limit(0), [0])
    materialize(empty.rows, "outcomes")
    assert empty.counts().collect() == []


def test_listener_follows_the_micro_batches(spark, tmp_path):
    outcomes = event_outcomes(table(spark, SF_SMALL, "events"))
    outcomes.repartition(4).write.parquet(str(tmp_path / "o"))
    stream = spark.readStream.schema(outcomes.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "o"))
    live = LiveCounts([0, 1, 2, 3])
    spark.streams.addListener(live)
    try:
        query = (observe_stream(stream, [0, 1, 2, 3]).writeStream.format("noop").trigger(availableNow=True)
                 .option("checkpointLocation", shared_path(spark, "streams", uuid.uuid4().hex)).start())
        query.awaitTermination()
        for _ in range(100):  # events come a little later
            if sum(v for k, v in live.totals().items() if k.startswith("total")) == outcomes.count():
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(live)
    want = {r.crawl_id: (r.total_urls, r.successful) for r in crawl_summary(outcomes).collect()}
    got = live.totals()
    assert {c: (got[f"total_{c}"], got[f"ok_{c}"]) for c in range(4)} == want
    assert len(live.batches) == 4


def test_bucketed_attempts_are_settled_where_they_lie(spark):
    attempts = event_attempts(table(spark, SF_SMALL, "events"))
    want = _rows(resolve_attempts(attempts, order=ATTEMPT_ORDER))
    captured = store_bucketed(attempts, "url", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as with bodies of any real size
    try:
        with by_part_of_the_key(spark):
            settled = resolve_attempts(captured, order=ATTEMPT_ORDER)
            assert _rows(settled) == want
            plan = settled._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.split("Initial Plan")[0]
        loose = resolve_attempts(attempts, order=ATTEMPT_ORDER)
        assert _rows(loose) == want and "Exchange" in loose._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.conf.get(ALL_KEYS) == "true"


def test_crawl_counts_its_pages_while_it_writes_them(spark):
    seeds = spark.createDataFrame([("http://a.com/x",), ("http://a.com/y",), ("http://a.com/z",)], "seed string")
    body = '{"data":{"title":"T","content":"c"}}'
    attempts = spark.createDataFrame([("http://a.com/x", "fetch", 1, 200, None, body), ("http://a.com/y", "fetch", 1, 500, None, None)],
                                     "url string, kind string, seq int, status int, error string, body string")
    sitemaps = spark.createDataFrame([], "file string, pos long, url string")
    done = jobs.crawl(seeds, sitemaps, store_bucketed(attempts, "url", 2), 1700000000)
    assert [tuple(r)[:4] for r in done.summary.collect()] == [(0, 3, 1, 2)]
    assert "FileScan" not in done.summary._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert done.outcomes.filter(F.col("ok")).count() == 1 and done.pages.count() == 1
