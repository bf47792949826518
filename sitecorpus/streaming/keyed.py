"""Keyed stream state: one state a URL, a file name and a title, in Spark's own state store
(``transformWithState`` over RocksDB). A micro-batch touches the states of the keys it holds and nothing else;
a restart goes on from the checkpoint; the state is read back as a table (``statestore`` source)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor

from sitecorpus.session import setting
from sitecorpus.sources.corpus import listed_once

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def rocksdb(spark: SparkSession):
    """The state store that keyed state needs, while a query is started or read."""
    return setting(spark, PROVIDER, ROCKSDB)


def few_listing_tasks(spark: SparkSession):
    """A micro-batch looks its files up again, by default in a task for each file (10,000 at most)."""
    return setting(spark, LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))


def drain(stream: DataFrame, checkpoint: str) -> int | None:
    """Run ``stream`` over all that is available (``availableNow``); its rows go nowhere, the state below
    ``checkpoint`` is the result. Returns the number of the last micro-batch that this run did (None: nothing
    was new)."""
    spark = stream.sparkSession
    with rocksdb(spark), few_listing_tasks(spark), listed_once(spark):
        query = (stream.writeStream.format("noop").outputMode("append")
                 .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        query.awaitTermination()
    done = [p.batchId for p in query.recentProgress if p.numInputRows > 0]
    return max(done, default=None)


def state_rows(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    """The key's and the value's columns of a state variable after the last micro-batch. Which of the
    query's operators has it, the checkpoint's metadata says (a row for each store of each operator)."""
    with rocksdb(spark):
        known = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorProperties").distinct()
        operator = next(r.operatorId for r in known.collect() if f'"{variable}"' in r.operatorProperties.replace("\\", ""))
        rows = (spark.read.format("statestore").option("operatorId", operator)
                .option("stateVarName", variable).load(checkpoint))
        return rows.select("key.*", "value.*")


# ---- attempts of a URL ------------------------------------------------------------------------

class FirstAttempts(StatefulProcessor):
    """Keeps, for each URL, its first ``limit`` attempts of each kind in the order of the ``place``
    columns, whatever the order in which they arrive."""

    def __init__(self, columns: list[str], kind: str, place: list[str], limit: int, schema: T.StructType):
        self.columns, self.kind, self.place, self.limit, self.schema = columns, kind, place, limit, schema

    def init(self, handle) -> None:
        self.state = handle.getValueState("attempts", self.schema)

    def handleInputRows(self, key, rows, timerValues):
        held = [tuple(a) for a in self.state.get()[0]] if self.state.exists() else []
        at, kind = [self.columns.index(c) for c in self.place], self.columns.index(self.kind)
        for part in rows:  # a URL with very many attempts passes in parts
            # nulls stay None: numbers of a column with nulls would come as floats
            new = part[self.columns].astype(object)
            held += list(new.where(new.notna(), None).itertuples(index=False, name=None))
            held.sort(key=lambda a: (a[kind], *[a[i] for i in at]))
            kept, number, last = [], 0, None
            for a in held:
                number = number + 1 if a[kind] == last else 1
                last = a[kind]
                if number <= self.limit:
                    kept.append(a)
            held = kept
        self.state.update(([self._plain(a) for a in held],))
        yield pd.DataFrame({"url": [key[0]], "held": [len(held)]})

    def _plain(self, attempt: tuple) -> tuple:
        """Python's own types, as the state's schema wants them."""
        out = []
        for value, f in zip(attempt, self.schema[0].dataType.elementType.fields, strict=True):
            if value is None:
                out.append(None)
            elif isinstance(f.dataType, T.BooleanType):
                out.append(bool(value))
            elif isinstance(f.dataType, T.IntegralType):
                out.append(int(value))
            else:
                out.append(value)
        return tuple(out)

    def close(self) -> None:
        pass


def first_attempts(attempts: DataFrame, limit: int, place: list[str]) -> DataFrame:
    """The stream that keeps each URL's first attempts; ``attempts`` are narrow (url, kind, ``place``,
    ...), without bodies."""
    columns = [c for c in attempts.columns if c != "url"]
    entry = T.StructType([attempts.schema[c] for c in columns])
    schema = T.StructType([T.StructField("attempts", T.ArrayType(entry))])
    return attempts.groupBy("url").transformWithStateInPandas(
        FirstAttempts(columns, "kind", place, limit, schema), "url string, held long", "append", "none")


def kept_attempts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The attempts that the states hold, one row each."""
    return state_rows(spark, checkpoint, "attempts").select("url", F.explode("attempts").alias("a")).select("url", "a.*")


# ---- pages of a corpus ------------------------------------------------------------------------

PAGE = "title_key string, path string, run long"
EVENT = "group string, title_key string, filename string, path string, run long, gone boolean"
EVENT_COLUMNS = ["group", "title_key", "filename", "path", "run", "gone"]
EVENT_ROW = Row(*EVENT_COLUMNS)
GROUP = ("title_key string, run long, base_name string, base_path string, base_gone boolean, n_new long, "
         "new_name string, new_path string, archived long")
MEMBERS = "group string, members long"
MEMBERS_ROW = Row("group", "members")


class PageNames(StatefulProcessor):
    """One state a file name: the title and place of its last page. A page that is saved again takes the
    earlier one out of its title and goes into its own."""

    def init(self, handle) -> None:
        self.state = handle.getValueState("page", PAGE)

    def handleInputRows(self, key, rows, timerValues):
        pages = (t for part in rows for t in zip(part["run"].tolist(), part["path"], part["title_key"], strict=True))
        yield pd.DataFrame(self.events(key[0], pages), columns=EVENT_COLUMNS)

    def events(self, name: str, pages) -> list[tuple]:
        """What the pages (run, path, title) of a name do to titles; the name's state goes on to the last."""
        events, old = [], self.state.get()
        for run, path, title in sorted(set(pages), key=lambda p: p[:2]):
            if old is not None:
                events.append((_group(old[0], name), old[0], name, old[1], int(run), True))
            events.append((_group(title, name), title, name, path, int(run), False))
            old = (title, path, int(run))
        self.state.update(old)
        return events

    def close(self) -> None:
        pass


class PageNameRows(PageNames):
    """The same fed with rows: a data frame in and out for each name costs many times its state."""

    def handleInputRows(self, key, rows, timerValues):
        return iter([EVENT_ROW(*e) for e in self.events(key[0], ((r.run, r.path, r.title_key) for r in rows))])


def _group(title, name: str) -> str:
    """Pages without a usable title are never duplicates: each is a group of its own."""
    return f"n{name}" if title is None else f"t{title}"


class TitleGroups(StatefulProcessor):
    """One state a title, of fixed size: the page that was retained before the current run (``base``) and
    whether this run took it away, how many pages this run brought and the first of them. What is retained
    follows from these (:func:`retained_pages`), so a run may come in several micro-batches. With a newer run
    the outcome becomes the base."""

    def init(self, handle) -> None:
        self.state = handle.getValueState("title", GROUP)

    def handleInputRows(self, key, rows, timerValues):
        members = self.members([e for part in rows for e in part[["run", "gone", "filename", "path", "title_key"]].itertuples(index=False, name=None)])
        yield pd.DataFrame({"group": [key[0]], "members": [members]})

    def members(self, events: list[tuple]) -> int:
        """The title's state goes on by the events (run, gone, filename, path, title); the number of its pages."""
        events.sort(key=lambda e: (e[0], not e[1]))  # by run, what goes before what comes
        held = self.state.get()
        if held is not None:
            title, run, base, base_path, gone, n, new, new_path, archived = held
        else:
            title, run, base, base_path, gone, n, new, new_path, archived = events[0][4], None, None, None, False, 0, None, None, 0
        for at, leaves, name, path, _ in events:
            if run is None or at > run:
                members = (base is not None and not gone) + n
                if members == 1 and n == 1:
                    base, base_path = new, new_path
                elif members != 1:
                    base = base_path = None
                archived += members if members > 1 else 0
                run, gone, n, new, new_path = int(at), False, 0, None, None
            if leaves:
                if name == base and path == base_path:
                    gone = True
                elif n and name == new and path == new_path:  # twice in one run
                    n, new, new_path = n - 1, None, None
            else:
                n += 1
                if new is None:
                    new, new_path = name, path
        self.state.update((title, run, base, base_path, bool(gone), int(n), new, new_path, int(archived)))
        return int((base is not None and not gone) + n)

    def close(self) -> None:
        pass


class TitleGroupRows(TitleGroups):
    """The same fed with rows."""

    def handleInputRows(self, key, rows, timerValues):
        return iter([MEMBERS_ROW(key[0], self.members([(r.run, r.gone, r.filename, r.path, r.title_key) for r in rows]))])


def title_groups(pages: DataFrame) -> DataFrame:
    """The stream of a corpus: pages (filename, title_key, path, run) to their names' states and on to their
    titles' states."""
    named = pages.select("filename", "title_key", "path", F.col("run").cast("long").alias("run"))
    events = named.groupBy("filename").transformWithState(PageNameRows(), EVENT, "append", "none")
    return events.groupBy("group").transformWithState(TitleGroupRows(), MEMBERS, "append", "none")


def retained_pages(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(filename, title_key, path) of the pages that are retained: the only member of a title, be it the one
    from before or the one of this run."""
    s = state_rows(spark, checkpoint, "title")
    base = F.col("base_name").isNotNull() & ~F.col("base_gone")
    alone = (base & (F.col("n_new") == 0)) | (~base & (F.col("n_new") == 1))
    return s.filter(alone).select(F.when(base, F.col("base_name")).otherwise(F.col("new_name")).alias("filename"), "title_key",
                                  F.when(base, F.col("base_path")).otherwise(F.col("new_path")).alias("path"))
