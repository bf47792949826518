"""The pipeline's stages on a small fixture against plain Python, and on an empty table."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sitecorpus.llm.source_mixing import mix

FILL = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omikron pi rho sigma tau".split()
SECRET = "token = \"0123456789abcdef0123\""


def fixture():
    rng, docs, labels = random.Random(8), [], []
    for i in range(900):
        words = [rng.choice(FILL) + str(rng.randrange(40)) for _ in range(rng.randrange(20, 60))]
        toxic = i % 9 == 0
        if toxic:
            words[3:3] = rng.sample(["idiot", "moron", "scum"], 2)
        docs.append([i, " ".join(words), "en", f"s{i % 4}", 0])
        labels.append((i, 1, int(toxic)))
    for i in range(900, 960):  # near and exact copies of clean documents
        base = docs[(i - 900) * 9 + 1][1].split()
        if i % 2:
            base[-1] = "edited"
        docs.append([i, " ".join(base), "en", "s0", 0])
    for i in range(960, 970):
        docs.append([i, f"row {i} has {SECRET} é end {i * 7} of {i * 11} the {i * 13} line", "en", "s1", 0])
    docs += [[970, None, None, None, None], [971, "", "en", "s2", 0], [972, "same", "en", "s2", 4], [972, "same", "en", "s2", 4],
             [None, "a row without any key at all", None, "s3", 0]]
    for d in docs:
        d[4] = None if d[1] is None else len(d[1])
    return [tuple(d) for d in docs], labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs, labels = fixture()
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {"score": F.lit(1), "spans": F.lit("x"), "whole": F.lit("w"), "blob": F.lit(2), "row_key": F.lit(3), "copy": F.lit(4)}
    ).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, states = docs.columns, [docs]
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "secret_scans", "source_mixing", "sentencepiece_sampling"]
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, states[-1], folder).write.parquet(f"{folder}/out-{name}")
        states.append(spark.read.parquet(f"{folder}/out-{name}"))
        assert i == 4 or states[-1].columns == columns, name
    whole, clean, single, safe, mixed, pieces = [[r.asDict() for r in s.collect()] for s in states]
    toxic = {r["doc_id"] for r in whole if re.search(r"\b(idiot|moron|scum)\b", r["text"] or "")}
    assert not toxic & {r["doc_id"] for r in clean} and len(clean) == len(whole) - len(toxic)

    sets = []
    for r in clean:
        w = (r["text"] or "").lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(clean)))
    order = sorted(range(len(clean)), key=lambda i: (clean[i]["doc_id"] is None, clean[i]["doc_id"] or 0))
    inverted = collections.defaultdict(list)
    for i in order:
        for g in sets[i]:
            inverted[g].append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for members in inverted.values():
        for a in members:
            for b in members:
                both = len(sets[a] & sets[b])
                if order.index(a) < order.index(b) and 100 * both >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
                    x, y = sorted((find(a), find(b)), key=order.index)
                    root[y] = x
    want = collections.Counter((clean[i]["doc_id"], clean[i]["text"]) for i in range(len(clean)) if find(i) == i)
    assert collections.Counter((r["doc_id"], r["text"]) for r in single) == want
    assert not {r["doc_id"] for r in single} & set(range(900, 960))

    before = {(r["doc_id"], r["source"]): r["text"] for r in single}
    for r in safe:
        old = before[r["doc_id"], r["source"]]
        new = old if old is None else old.replace(SECRET, "[SECRET]" + SECRET[-1])  # the span ends before the closing quote
        assert r["text"] == new and r["n_chars"] == (None if new is None else len(new))

    copies = {(r.doc_id, r.source): r.copies for r in mix(states[3].drop("score")).collect()}
    taken = collections.Counter((r["doc_id"], r["source"]) for r in mixed)
    assert taken == collections.Counter({k: n for k, n in copies.items() if n})
    assert len(pieces) == len(mixed) and all(r["samples"] for r in pieces)


def test_run_is_the_stages(spark, folder):
    rows = corpus_pipeline.run(spark, folder)
    assert rows.count() == spark.read.parquet(f"{folder}/out-sentencepiece_sampling").count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0, name


def test_rows_without_words_stay(spark):
    """Rows without words are near nothing, also if key and text are those of another row."""
    from sitecorpus.llm.pipeline import one_per_group
    rows = [(None, None, "a"), (None, None, "b"), (1, " \t", "a"), (1, " \t", "a"), (2, "", "a"), (2, "", "c"),
            (3, "same words here", "a"), (3, "same words here", "a"), (4, "same words here", "b"), (5, " ", "a"), (5, " ", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted((tuple(r) for r in one_per_group(spark, df, "").collect()), key=str)
    assert got == sorted([*rows[:6], rows[6], rows[9]], key=str)


def test_stored_stages_hand_over_few_rows_at_once(spark):
    """And the session's own settings are as before."""
    import pyarrow as pa
    from sitecorpus.llm.stored import BATCH_ROWS, store
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    got = [r.n for r in store(spark.range(0, 5000, 1, 1).mapInArrow(sizes, "n long"), "batches").collect()]
    assert sum(got) == 5000 and max(got) <= BATCH_ROWS and spark.conf.get(name) == before
