"""Run metrics that are gathered while the rows are written: no second pass over the outcomes."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

COUNTS = "crawl_id long, total_urls long, successful long, failed long"


def outcome_metrics(crawls: list[int], key: str = "crawl_id") -> list:
    """Two counters for each of the crawls that a job runs."""
    out = []
    for c in crawls:
        mine = F.col(key).eqNullSafe(F.lit(c))
        out += [F.count(F.when(mine, 1)).alias(f"total_{c}"), F.count(F.when(mine & F.col("ok"), 1)).alias(f"ok_{c}")]
    return out


def counts_of(spark: SparkSession, metrics: dict, crawls: list[int]) -> DataFrame:
    """The counters as the summary's first columns, one row a crawl that has URLs."""
    rows = [(c, metrics[f"total_{c}"], metrics[f"ok_{c}"], metrics[f"total_{c}"] - metrics[f"ok_{c}"]) for c in crawls]
    return spark.createDataFrame([r for r in rows if r[1]], COUNTS)


class ObservedOutcomes:
    """Outcomes (crawl_id, ok, ...) whose counters fill while ``rows`` are written, by whatever writes them
    first. ``counts`` waits for that."""

    def __init__(self, outcomes: DataFrame, crawls: list[int], key: str = "crawl_id"):
        self.spark, self.crawls, self.observation = outcomes.sparkSession, list(crawls), Observation()
        self.rows = outcomes.observe(self.observation, *outcome_metrics(self.crawls, key))

    def counts(self) -> DataFrame:
        return counts_of(self.spark, self.observation.get, self.crawls)


class LiveCounts(StreamingQueryListener):
    """The running totals of a stream of outcomes (see ``observe_stream``), from its progress events: what the
    original prints after each URL, with no aggregation and no state in the query."""

    def __init__(self, crawls: list[int], name: str = "outcomes"):
        self.crawls, self.name = list(crawls), name
        self.batches: dict[int, dict] = {}
        self.lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.take(event.progress)

    def take(self, progress) -> None:
        """The figures of one micro-batch; a batch that is run again replaces its own."""
        row = progress.observedMetrics.get(self.name)
        if row is not None:
            with self.lock:
                self.batches[progress.batchId] = row.asDict()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def totals(self) -> dict:
        with self.lock:
            done = list(self.batches.values())
        return {f"{kind}_{c}": sum(b[f"{kind}_{c}"] for b in done) for c in self.crawls for kind in ("total", "ok")}


def observe_stream(outcomes: DataFrame, crawls: list[int], name: str = "outcomes", key: str = "crawl_id") -> DataFrame:
    return outcomes.observe(name, *outcome_metrics(list(crawls), key))
