"""Learned operators on held-out rows, tokenizers against their libraries, search against brute
force, and odd rows."""

import collections
import math
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sitecorpus.llm.ann import nearest
from sitecorpus.llm.folds import held_out
from sitecorpus.llm.language_id import fit, fit_fold, identify
from sitecorpus.llm.piece_sampling import MARK, Sampler, decode, encode
from sitecorpus.llm.token_counts import Counter, count_tokens
from sitecorpus.llm.toxicity import fit_fold as fit_toxic, score_toxicity

BPE = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "12 34 !?"), (None, "text without key"), (5, "twice"), (5, "twice"), (6, "漢字 é\n\t😀\u0000 x"),
       (7, "wort " * 5000), (8, "a" * 5000), (9, "<|endoftext|> a<|startoftext|>b")]


@pytest.fixture(scope="module")
def odd(spark):
    names = ("score", "predicted", "lang", "held_out", "samples", "ids", "found", "n_tokens", "label")
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumns({n: F.lit(n) for n in names})


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_toxicity_finds_held_out_rows(spark, odd):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    machine = fit_toxic(docs, labels)
    rows = (score_toxicity(docs, machine).join(labels, "doc_id").filter(held_out("doc_id")).select("score", "toxic").collect())
    toxic, clean = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    order = np.mean([a > b for a in toxic for b in clean])
    assert order > 0.93 and np.mean([s < 0.5 for s in clean]) > 0.99 and np.mean([s >= 0.5 for s in toxic]) > 0.85  # some labels are noise
    again = fit_toxic(docs.repartition(7), labels.repartition(3))
    assert np.allclose(again.w, machine.w) and np.allclose(again.v, machine.v)
    got = score_toxicity(odd, machine).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert score_toxicity(odd.limit(0), machine).count() == 0


def test_pairs_of_terms_count(spark):
    """Neither word alone is toxic; both together are."""
    rng, rows = random.Random(3), []
    for i in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        fill = " ".join(rng.choice(["uno", "due", "tre", "quattro"]) for _ in range(6))
        rows.append((i, f"{fill} {'fools' if a else 'trees'} {'neighbours' if b else 'rivers'}", int(a and b)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    machine = fit_toxic(df, df.drop("text"))
    got = {r.doc_id: r.predicted for r in score_toxicity(df, machine).filter(held_out("doc_id")).collect()}
    assert np.mean([got[i] == t for i, _, t in rows if i in got]) > 0.98


def test_pairs_of_balanced_words_count(spark):
    """Each word is as frequent in toxic as in clean texts; only the pair tells."""
    rng, rows = random.Random(5), []
    for i in range(5000):
        a, b = (i // 2) % 2, i % 2
        text = [f"{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{k}" for k in (rng.randrange(3000) for _ in range(60))]
        text += ["fools" if a else "trees", "neighbours" if b else "rivers"]
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(a == b)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    machine = fit_toxic(df, df.drop("text"))
    got = {r.doc_id: r.predicted for r in score_toxicity(df, machine).filter(held_out("doc_id")).collect()}
    assert np.mean([got[i] == t for i, _, t in rows if i in got]) > 0.98


def test_log_odds_are_the_sum_over_all_pairs():
    """The machine's closed form against an explicit double loop over the terms of each text."""
    from sitecorpus.llm.toxicity import Machine, slots
    rng, texts = np.random.default_rng(6), ["one two three", "two two nine", "", None, "x " * 50 + "y z", "unseen words only"]
    machine = Machine(np.unique(slots(texts[:5])[0]), 0.25)
    machine.w, machine.v = rng.normal(size=machine.w.shape), rng.normal(size=machine.v.shape)
    want = []
    for text in texts:
        at = machine.active(*slots([text], machine.place))[0].tolist()
        z = machine.w[0] + sum(machine.w[i] for i in at)
        pairs = sum(float(machine.v[i] @ machine.v[j]) for n, i in enumerate(at) for j in at[n + 1:])
        want.append(1 / (1 + math.exp(-(z + pairs / math.sqrt(max(len(at), 1)) + 0.25))))
    assert np.allclose(machine.score(texts), want)


def test_repeated_keys_give_one_text_to_the_fit(spark):
    rows = [(i, f"{'bad' if i % 2 else 'good'} text {i}", i % 2) for i in range(200)]
    one = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    many = one.unionByName(spark.createDataFrame([(7, f"zz later {k}", 1) for k in range(300)], one.schema))
    a, b = fit_toxic(one, one.drop("text")), fit_toxic(many, one.drop("text"))
    assert np.allclose(a.w, b.w) and np.allclose(a.v, b.v)


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in score_toxicity(odd, fit_toxic(odd, none)).collect()} == {0}
    one = spark.createDataFrame([(7, 0), (None, 1), (8, None)], "doc_id long, toxic int")
    assert {r.predicted for r in score_toxicity(odd, fit_toxic(odd, one)).collect()} == {0}


def test_language_of_held_out_rows(tables, odd):
    docs, _ = tables
    model = fit_fold(docs)
    rows = identify(docs.withColumn("want", F.col("lang")).withColumn("h", held_out("doc_id")), model, keep=["want", "h"]).filter("h").collect()
    assert np.mean([r.lang_pred == r.want for r in rows]) > 0.97
    got = {r.doc_id: r for r in identify(odd, model).collect()}
    assert {d for d, r in got.items() if r.lang_pred == "und"} == {1, 2, 3, 4}
    assert all((r.lang_pred == "und") == (r.score == 0) and 0 <= r.score <= 1 for r in got.values())
    assert identify(odd.limit(0), model).count() == 0


def test_paths_equal_plain_viterbi(spark, tables):
    """The vectorised search against a loop over words and languages, on mixed and odd texts."""
    from sitecorpus.llm.language_id import SWITCH
    from sitecorpus.llm.words import LETTERS, Batch
    model = fit_fold(tables[0])
    texts = [r.text[:400] for r in tables[0].orderBy("doc_id").limit(12).collect() if r.text]
    mixed = [" ".join(a.split()[:9] + b.split()[:7] + a.split()[9:14]) for a, b in zip(texts, texts[::-1])]
    batch = Batch([*texts, *mixed, "", None, "漢字 x", "one"], LETTERS)
    emitted, label = model.emissions(batch).astype(np.float64), model.paths(batch)
    for a, b in zip(batch.first, batch.first[1:]):
        score, steps = [0.0] * len(model.languages), []
        for t in range(a, b):
            top = max(range(len(score)), key=lambda k: (score[k], -k))
            steps.append([k if score[k] >= score[top] - SWITCH else top for k in range(len(score))])
            score = [max(score[k], score[top] - SWITCH) + float(emitted[t, k]) for k in range(len(score))]
        if a < b:
            k, want = max(range(len(score)), key=lambda k: (score[k], -k)), []
            for step in reversed(steps):
                want.append(k)
                k = step[k]
            assert label[a:b].tolist() == want[::-1]


def test_spans_of_mixed_text(spark):
    a, b = "the quick brown fox jumps over the lazy dog and runs away", "der schnelle braune fuchs springt über den faulen hund"
    c = "быстрая лиса прыгает через собаку"
    rows = [(x, lang) for x, lang in ((a, "en"), (b, "de"), (c, "ru")) for _ in range(20)]
    model = fit(spark.createDataFrame(rows, "text string, lang string"))
    df = spark.createDataFrame([(1, f"{a} {b} {c} {a}"), (2, c), (3, "ελληνικά")], "doc_id long, text string")
    got = {r.doc_id: r for r in identify(df, model).collect()}
    assert [s.lang for s in got[1].spans] == ["en", "de", "ru", "en"] and got[1].lang_pred == "en"
    assert [s.start for s in got[1].spans] == [0, 12, 21, 26] and got[2].lang_pred == "ru" and got[2].score == 1
    none = identify(df, fit(spark.createDataFrame([], "text string, lang string"))).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(BPE)


def test_token_counts_of_a_table(tables, odd, library):
    docs, _ = tables
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    want = {d: len(e.ids) for d, e in zip(texts, library.encode_batch(list(texts.values()), add_special_tokens=False))}
    rows = count_tokens(docs, BPE).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == want
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 2048) for r in rows)
    got = collections.Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in count_tokens(odd, BPE).collect())
    assert got == collections.Counter((d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in ODD)
    assert count_tokens(odd.limit(0), BPE).count() == 0


PARTS = st.sampled_from(["a", "B", "'s", "'LL", "d're", "1", "²", "é", "é", "İ", "Σ", "ß", "漢", "😀", " ", "\t", "\x1c", "\x85", "\xa0", "　", "...",
                         "<|endoftext|>", "<|startoftext|>", "<|", "K", "ﬁ", "the", "ing"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=12))
def test_token_counts_of_any_text(library, parts):
    text = "".join(parts)
    assert Counter.count(_COUNTER, text) == len(library.encode(text, add_special_tokens=False).ids)


_COUNTER = Counter(BPE)


def test_kept_counts_are_bounded(monkeypatch, library):
    from sitecorpus.llm import token_counts
    monkeypatch.setattr(token_counts, "KEEP_WORDS", 10)
    counter = Counter(BPE)
    text = " ".join(f"word{i}" for i in range(100))
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids) and len(counter) <= 10


def test_samples_decode_to_the_text(odd, tables):
    docs, _ = tables
    for df in (odd, docs.filter("doc_id < 60").drop("lang")):
        rows = encode(df, MODEL, 3, keep=["text"]).select("doc_id", "text", F.posexplode("samples").alias("i", "s")).select("doc_id", "text", "i", "s.*")
        got = decode(rows, MODEL, "ids", "back").collect()
        assert got and all(r.back == (r.text or "") for r in got)
        by = collections.defaultdict(list)
        for r in got:
            by[r.doc_id, r.text].append(r)
        for group in by.values():
            per = {}
            for r in group:
                per.setdefault(r.i, r)
            assert len({tuple(r.ids) for r in per.values()}) == len(per) <= 3
            values = [per[i].perturbed for i in sorted(per)]
            assert values == sorted(values, reverse=True) and all(0 <= r.inclusion <= 1 for r in group)
    assert encode(odd.limit(0), MODEL).count() == 0


def test_samples_follow_the_exact_distribution():
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    sampler = Sampler(MODEL, 1.0, 2, 1)
    v, text = sampler.vocabulary, "thin air"
    weight = {v.pieces[p]: v.weight[s] for s, p in enumerate(v.final) if p >= 0}
    norm, paths = MARK + text.replace(" ", MARK), {}

    def walk(i, ids, w):
        if i == len(norm):
            paths[tuple(ids)] = w
        for j in range(i + 1, len(norm) + 1):
            if norm[i:j] in weight:
                walk(j, [*ids, sp.piece_to_id(norm[i:j])], w + weight[norm[i:j]])

    walk(0, [], 0.0)
    total = math.log(sum(map(math.exp, paths.values())))
    p = {k: math.exp(w - total) for k, w in paths.items()}
    n, first, pairs, mass = 8000, collections.Counter(), collections.Counter(), collections.Counter()
    for sample in sampler.texts(np.arange(n), [text] * n):
        ids = [tuple(s["ids"].tolist()) for s in sample]
        assert all(abs(s["log_p"] - math.log(p[k])) < 1e-9 for s, k in zip(sample, ids))
        first[ids[0]] += 1
        pairs[tuple(ids)] += 1
        for s, k in zip(sample, ids):
            mass[k] += p[k] / s["inclusion"] / n
    for seen, want in ((first, p), (pairs, {(a, b): p[a] * p[b] / (1 - p[a]) for a in p for b in p if a != b})):
        often = {k: n * x for k, x in want.items() if n * x > 8}
        assert sum((seen[k] - x) ** 2 / x for k, x in often.items()) < 3 * len(often) + 20
    assert abs(sum(mass.values()) - 1) < 0.05  # inclusion scores weigh the samples back to the whole


def test_samples_do_not_depend_on_batches(spark, tables, monkeypatch):
    docs, _ = tables
    rows = docs.filter("doc_id < 40").select("doc_id", "text").collect()
    keys, texts = np.array([r.doc_id for r in rows]), [r.text for r in rows]
    whole = Sampler(MODEL, 1.0, 2, 9).texts(keys, texts)
    from sitecorpus.llm import piece_sampling
    monkeypatch.setattr(piece_sampling, "BATCH_CHARS", 3000)
    monkeypatch.setattr(piece_sampling, "KEEP_EDGES", 2000)
    parts = Sampler(MODEL, 1.0, 2, 9).texts(keys, texts)
    assert [[s["ids"].tolist() for s in x] for x in whole] == [[s["ids"].tolist() for s in x] for x in parts]


def test_words_share_the_lattices_of_their_segments():
    sampler = Sampler(MODEL, 1.0, 2, 9)
    words = [f"{w}{end}" for w in ("thereby", "naming", "later", "ouch", "ñandú", "漢字") for end in ("###", "&&&", "$$$\nThe", "***\nA", "\t\x07", "☃☃")]
    text = " ".join(words) + "  "
    found = sampler.texts(np.arange(1), [text])[0]
    assert len({tuple(s["ids"].tolist()) for s in found}) == 2
    assert sampler.lattices.nodes < len(text) * 0.75  # a lattice for each word had more nodes than the text has characters


def test_segments_of_equal_hashes_keep_apart(monkeypatch):
    from sitecorpus.llm import piece_sampling
    texts = ["the cat and the dog, the cat", "", "a\n\nb  漢字 ☃ ", "the", " "]
    whole = Sampler(MODEL, 1.0, 3, 9).texts(np.arange(5), texts)
    monkeypatch.setattr(piece_sampling, "_hashes", lambda code, place, start: np.zeros(len(start), np.uint64))
    same = Sampler(MODEL, 1.0, 3, 9).texts(np.arange(5), texts)
    assert [[s["ids"].tolist() for s in x] for x in whole] == [[s["ids"].tolist() for s in x] for x in same]


def test_places_behind_the_window_are_looked_at(monkeypatch):
    from sitecorpus.llm import piece_sampling
    texts = ["so " * 400, "all in one " * 60, "x", "ünï ☃ " * 90]
    whole = Sampler(MODEL, 1.0, 4, 9).texts(np.arange(4), texts)
    monkeypatch.setattr(piece_sampling, "WINDOW", 2)
    parts = Sampler(MODEL, 1.0, 4, 9).texts(np.arange(4), texts)
    assert [[(s["ids"].tolist(), round(s["inclusion"], 9)) for s in x] for x in whole] == [[(s["ids"].tolist(), round(s["inclusion"], 9)) for s in x] for x in parts]


def brute(rows, k):
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), i) for i, w in rows if i != q)
            out[q] = near[:k]
    return out


def test_search_is_exact_if_all_cells_are_visited(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(1500)]
    rows += [(i, rows[3][1]) for i in range(1500, 1560)] + [(1600, rows[3][1])]  # ties
    bad = [(5000, None), (5100, [0.0] * 8), (5200, [float("nan")] + [1.0] * 7), (5300, [float("inf")] * 8), (5400, [None] + [1.0] * 7),
           (5500, [1.0] * 3), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows + bad + [rows[7]], "vec_id long, embedding array<double>").withColumns(
        {"cell": F.lit("x"), "v": F.lit(1), "rank": F.lit(2)})
    got = collections.defaultdict(list)
    for r in nearest(df, F.col("vec_id") % 100 == 0, probe=1.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    want = brute(rows, 10)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]] and np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]])


def test_rows_of_one_id_count_as_one(spark):
    """With the least of their vectors, whether it asks or is found; no id comes twice."""
    rng = np.random.default_rng(8)
    rows = [(i % 300, [float(x) for x in rng.normal(size=6)]) for i in range(2400)]
    least = {}
    for i, v in rows:
        least[i] = min(v, least.get(i, v))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = collections.defaultdict(list)
    for r in nearest(df, F.col("vec_id") % 100 == 0, probe=1.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    assert {q: ids for q, ids in got.items()} == {q: [i for _, i in near] for q, near in brute(list(least.items()), 10).items()}


def test_search_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, 10)
    got = collections.defaultdict(set)
    for r in nearest(df, F.col("vec_id") % 100 == 0).collect():
        got[r.query_id].add(r.vec_id)
    assert np.mean([len(got[q] & {i for _, i in near}) / len(near) for q, near in want.items()]) >= 0.9


def test_search_of_few_or_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [3.0, 4.0])], schema)
    assert [(r.query_id, r["rank"], r.vec_id) for r in nearest(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert nearest(few.limit(0), F.lit(True)).count() == 0 and nearest(few, F.lit(False)).count() == 0
    one = spark.createDataFrame([(0, [1.0])], schema)
    assert nearest(one, F.lit(True)).count() == 0
