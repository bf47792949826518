"""Streaming twins: live progress equals the batch summary; the corpus stream's state is
the same after a restart on the same checkpoint."""

import collections
import os
import random
import uuid

import pandas as pd
from pyspark.sql import functions as F

from conftest import SF_SMALL
from sitecorpus.operators.reports import crawl_summary
from sitecorpus.plans.catalog import table
from sitecorpus.plans.frontier import event_outcomes
from sitecorpus.session import shared_path
from sitecorpus.sources.corpus import read_markdown_corpus, read_markdown_stream
from sitecorpus.streaming.keyed import state_rows
from sitecorpus.streaming.live import corpus_index, corpus_view, run_to_table, stream_corpus, stream_progress


def test_progress_stream_equals_batch(spark):
    events = table(spark, SF_SMALL, "events")
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
              .parquet(SF_SMALL))
    now = run_to_table(spark, stream_progress(event_outcomes(stream)),
                        shared_path(spark, "streams", uuid.uuid4().hex))
    batch = crawl_summary(event_outcomes(events))
    got = {r.crawl_id: (r.processed, r.successful) for r in now.collect()}
    want = {r.crawl_id: (r.total_urls, r.successful) for r in batch.collect()}
    assert got == want


def _expected(batches):
    """Retained names and titles after runs of (filename, title) pages, as plain Python."""
    kept = {}
    for pages in batches:
        union = {**kept, **dict(pages)}
        counts = collections.Counter(union.values())
        kept = {f: t for f, t in union.items() if counts[t] == 1}
    return kept


def _save(src, run, pages):
    folder = src / f"run={run}"
    folder.mkdir(parents=True, exist_ok=True)
    for name, title in pages:
        (folder / name).write_text(f'---\ntitle: "{title}"\n---\n\nrun {run}' if title else f"---\ntitle:\n---\n\nrun {run}")


def test_corpus_stream_over_runs_micro_batches_and_restarts(spark, tmp_path):
    """After every run the same pages as full recomputation; runs in one and in several micro-batches, each
    start on the checkpoint of the one before."""
    rng, src = random.Random(4), tmp_path / "pages"
    state = os.path.join(shared_path(spark, "corpus-stream-test", uuid.uuid4().hex), "_checkpoint")
    batches, want = [], {}
    for run in range(4):
        pages = [(f"p{rng.randrange(30)}.md", f"T{rng.randrange(25)}" if rng.random() < 0.9 else "") for _ in range(14)]
        pages = list(dict(pages).items())
        _save(src, run, pages)
        batches.append([(f, t or f"null of {f}") for f, t in pages])
        last = stream_corpus(read_markdown_stream(spark, f"{src}/*", files_per_batch=1000 if run % 2 else 3), state)
        want = _expected(batches)
        got = {r.filename: r.title_key or f"null of {r.filename}" for r in corpus_index(spark, state).collect()}
        assert got == want, run
    view = {r.filename: r.raw for r in corpus_view(read_markdown_corpus(spark, f"{src}/*"), state).collect()}
    newest = {f: run for run, pages in enumerate(batches) for f, _ in pages}
    assert view.keys() == want.keys() and all(x.endswith(f"run {newest[f]}") for f, x in view.items())
    assert last >= 5  # several micro-batches a run
    assert stream_corpus(read_markdown_stream(spark, f"{src}/*"), state) is None  # nothing new


def test_title_states_run_by_run():
    """The states alone, without a stream: a run in any split gives the outcome of the whole run."""
    from sitecorpus.streaming.keyed import PageNames, TitleGroups

    class Value:
        def __init__(self):
            self.v = None

        def exists(self):
            return self.v is not None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    def feed(kind, states, key, frame):
        one = kind()
        one.state = states.setdefault(key, Value())
        return list(one.handleInputRows((key,), iter([frame]), None))

    rng = random.Random(9)
    for _ in range(150):
        names, titles, kept, n_archived = {}, {}, {}, 0
        for run in range(4):
            pages = {f"p{rng.randrange(8)}": f"T{rng.randrange(5)}" for _ in range(rng.randrange(1, 9))}
            union = {**kept, **pages}
            counts = collections.Counter(union.values())
            kept = {f: t for f, t in union.items() if counts[t] == 1}
            n_archived += len(union) - len(kept)
            rows = list(pages.items())
            rng.shuffle(rows)
            cut = rng.randrange(len(rows) + 1)
            for part in (rows[:cut], rows[cut:]):
                events = []
                for f, t in part:
                    frame = pd.DataFrame({"run": [run], "path": [f"{run}/{f}"], "title_key": [t]})
                    events += [e for out in feed(PageNames, names, f, frame) for e in out.to_dict("records")]
                for g in {e["group"] for e in events}:
                    feed(TitleGroups, titles, g, pd.DataFrame([e for e in events if e["group"] == g]))
            alone = {}
            for g, v in titles.items():
                title, _, base, _, gone, n, new, _, _ = v.get()
                members = (base is not None and not gone) + n
                if members == 1:
                    alone[new if n else base] = title
            assert alone == kept


def test_streams_leave_no_cached_blocks(spark, tmp_path):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    _save(tmp_path, 0, [("a.md", "T")])
    state = os.path.join(shared_path(spark, "corpus-stream-test", uuid.uuid4().hex), "_checkpoint")
    for _ in range(2):
        stream_corpus(read_markdown_stream(spark, f"{tmp_path}/*"), state)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
    assert [tuple(r) for r in corpus_index(spark, state).select("filename", "title_key").collect()] == [("a.md", "T")]


def test_stream_outcomes_equal_batch_in_any_order(spark, tmp_path):
    """Raw attempts (not numbered) in several micro-batches and two starts, ordered against time."""
    from sitecorpus.operators.responses import resolve_attempts
    from sitecorpus.plans.frontier import ATTEMPT_ORDER, event_attempts
    from sitecorpus.streaming.live import stream_outcomes

    att = event_attempts(table(spark, SF_SMALL, "events")).withColumn("late", -F.pmod("event_id", F.lit(5)))
    src, state = str(tmp_path / "attempts"), shared_path(spark, "streams", uuid.uuid4().hex)
    cols, place = ["url", "ok", "reason", "n_attempts", "decided_seq", "from_refetch"], list(ATTEMPT_ORDER)
    for part in (F.col("late") < -2, F.col("late") >= -2):
        att.filter(part).drop("late").repartition(3).write.mode("append").parquet(src)
        stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 2).parquet(src)
        now = stream_outcomes(stream, state, order=ATTEMPT_ORDER)
        batch = resolve_attempts(spark.read.parquet(src), with_body=False, order=ATTEMPT_ORDER)
        assert sorted(map(str, now.select(cols).collect())) == sorted(map(str, batch.select(cols).collect()))
    held = state_rows(spark, state, "attempts").select(F.size("attempts").alias("n")).collect()
    assert place and max(r.n for r in held) <= 6  # three of each kind, however many arrived


def _pages_of_stream(monkeypatch, files):
    """The pages that ``stream_corpus`` hands to the states, over files in batch."""
    from sitecorpus.streaming import live

    handed = []
    monkeypatch.setattr(live, "title_groups", handed.append)
    monkeypatch.setattr(live, "drain", lambda *_: None)
    live.stream_corpus(files, "unused")
    return handed[0].select("filename", "title_key", "path", "run")


def test_corpus_stream_parses_each_file_once(spark, tmp_path, monkeypatch):
    """Leaving out unreadable files costs no second parse and no decoding for each mention of the text."""
    folder = tmp_path / "run=3"
    folder.mkdir()
    files = {"a.md": '---\ntitle: "A"\n---\n\nx', "odd.md": "---\ntitle: [1, 2]\nother: yes\n---\n\nx", "none.md": "no block",
             "null.md": "---\ntitle:\n---\n\nx", "bad.md": "---\ntitle: [\n---\n\nx", "list.md": "---\n- a\n---\n\nx",
             "empty.md": "---\n# only a comment\n---\n\nx"}
    for name, text in files.items():
        (folder / name).write_text(text)
    (folder / "bytes.md").write_bytes(b"---\ntitle: \xff\n---\n")
    pages = _pages_of_stream(monkeypatch, read_markdown_corpus(spark, f"{tmp_path}/run=*"))
    got = {r.filename: (r.title_key, r.run, r.path.endswith(f"/run=3/{r.filename}")) for r in pages.collect()}
    assert got == {"a.md": ("A", 3, True), "odd.md": ("[1, 2]", 3, True), "none.md": ("none", 3, True), "null.md": (None, 3, True)}
    plan = pages._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("StringDecode") == 1


def test_corpus_stream_states_take_rows(spark, tmp_path):
    """No data frames for each name and title, and a handful of tasks look a micro-batch's files up."""
    from sitecorpus.streaming import keyed

    _save(tmp_path, 0, [(f"p{i}.md", f"T{i % 50}") for i in range(80)])
    state = os.path.join(shared_path(spark, "corpus-stream-test", uuid.uuid4().hex), "_checkpoint")
    limit, before = keyed.LISTING_TASKS, spark.conf.get(keyed.LISTING_TASKS)
    seen = []
    with keyed.few_listing_tasks(spark):
        seen.append(int(spark.conf.get(limit)))
    assert seen == [4 * spark.sparkContext.defaultParallelism] and spark.conf.get(limit) == before
    groups = keyed.title_groups(read_markdown_stream(spark, f"{tmp_path}/*").selectExpr("filename", "stem AS title_key", "path", "0 AS run"))
    plan = groups._jdf.queryExecution().analyzed().toString()
    assert plan.count("TransformWithStateInPySpark") == 2 and "InPandas" not in plan
    stream_corpus(read_markdown_stream(spark, f"{tmp_path}/*", files_per_batch=50), state)
    assert sorted(r.filename for r in corpus_index(spark, state).collect()) == sorted(f"p{i}.md" for i in range(30, 50))


def test_states_of_rows_are_those_of_frames():
    from sitecorpus.streaming.keyed import EVENT_COLUMNS, PageNameRows, PageNames, TitleGroupRows, TitleGroups

    class Value:
        v = None

        def get(self):
            return self.v

        def update(self, v):
            self.v = v

    def processors(*kinds):
        made = [k() for k in kinds]
        for p in made:
            p.state = Value()
        return made

    rng, row = random.Random(5), collections.namedtuple("row", EVENT_COLUMNS)
    for _ in range(100):
        names, titles = processors(PageNames, PageNameRows), processors(TitleGroups, TitleGroupRows)
        for run in range(3):
            pages = [row("", rng.choice(["T", "U", None]), "a.md", f"{run}/a.md", run, False) for _ in range(rng.randrange(1, 3))]
            frame = pd.DataFrame(pages)
            (events,) = names[0].handleInputRows(("a.md",), iter([frame]), None)
            assert [r.asDict() for r in names[1].handleInputRows(("a.md",), iter(pages), None)] == events.to_dict("records")
            assert names[0].state.v == names[1].state.v
            some = [row(*e) for e in events.itertuples(index=False, name=None)]
            some += [row("tT", "T", f"{i}.md", f"{run}/{i}.md", run, False) for i in range(rng.randrange(3))]
            (out,) = titles[0].handleInputRows(("tT",), iter([pd.DataFrame(some)]), None)
            assert [r.asDict() for r in titles[1].handleInputRows(("tT",), iter(some), None)] == out.to_dict("records")
            assert titles[0].state.v == titles[1].state.v


def test_listed_files_are_not_kept_by_the_driver(spark, tmp_path):
    _save(tmp_path, 0, [("a.md", "T")])
    index = read_markdown_corpus(spark, f"{tmp_path}/*")._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    (held,) = [f for f in index.getClass().getDeclaredFields() if f.getName().endswith("fileStatusCache")]
    held.setAccessible(True)
    assert held.get(index).getClass().getSimpleName() == "NoopCache$"
