"""Packing, periodic runs and Merkle manifests against plain Python on odd rows."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from sitecorpus.llm import queries as Q
from sitecorpus.llm.merkle import folded, leaf, manifest, siblings
from sitecorpus.llm.packing import combinations, fullest, pack, sequences
from sitecorpus.llm.periodic_runs import collapse_runs, lyndon_array, runs
from sitecorpus.llm.token_ids import token_pieces, word_ids

PATH = public_tokenizers.path("word_bpe_49k.json")
CLASH = {"piece": 1, "length": 2, "part": 3, "place": 4, "n": 5, "at": 6, "group": 7, "runs": 8, "ids": 9, "_text": 10, "leaf": 11}
LONG = " ".join(f"word{i % 997} näher." for i in range(9000))
TEXTS = ["Hello, World! it's", None, "", " \t\n", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> <|x", "don't can't O'Neil's 'S", "ÀÉÎ İstanbul ΣΑΣ Σ",
         "é Å Å ẞ", "a.b..c,(d)\"e\" f", "x1y22 3.14 ½ ²", "漢字 かな   nbsp em \x1c\x85 z", LONG, LONG, "same row", "same row", "🙂🙃 ok", "ª º ß"]
ROWS = [(None if i in (3, 8) else min(i, 13), t, None if i % 4 == 3 else f"s{i % 3}", "xx", len(t or "")) for i, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string, lang string, n_chars long").repartition(3)
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()})


def ids_of(text, tokenizer=Tokenizer.from_file(PATH)):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def check_packed(rows, capacity):
    """Sequences are gapless, at most ``capacity`` long, and few."""
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values(), default=0) <= capacity
    return len(ends)


# ---- packing ---------------------------------------------------------------------------------

def test_pieces_have_the_librarys_ids(docs):
    got = token_pieces(docs, PATH, 100, with_ids=True).collect()
    want = []
    for key, text, *_ in ROWS:
        ids = ids_of(text)
        want += [(key, k // 100, k, len(ids[k:k + 100]), crc(ids[k:k + 100]), tuple(ids[k:k + 100])) for k in range(0, len(ids), 100)]
    order = lambda x: (x[0] is None, x)
    assert sorted([(*r[:5], tuple(r.ids)) for r in got], key=str) == sorted(want, key=str) and order
    assert token_pieces(docs.limit(0), PATH).collect() == []


def test_words_forgotten_and_learnt_again(monkeypatch):
    from sitecorpus.llm import token_ids
    monkeypatch.setattr(token_ids, "KEEP_WORDS", 5)
    keep = token_ids.WordIds(PATH)
    for part in (TEXTS[:3], TEXTS[4:8], TEXTS[4:8], TEXTS[8:], []):
        ids, stop = keep.texts(part, 0)
        assert ids.tolist() == [i for t in part for i in ids_of(t)] and len(stop) == len(part)
    assert word_ids(PATH) is word_ids(PATH)


def test_fullest_is_the_best_subset():
    rng = random.Random(5)
    for _ in range(300):
        counts = {rng.randint(1, 12): rng.randint(0, 4) for _ in range(rng.randint(1, 5))}
        room = rng.randint(0, 40)
        sums = {sum(k * n for k, n in zip(counts, c, strict=True)) for c in itertools.product(*[range(n + 1) for n in counts.values()])}
        picked = fullest(counts, room)
        assert sum(k * n for k, n in picked.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[k] for k, n in picked.items())


def test_combinations_use_every_row_once_and_each_bin_is_the_fullest_left():
    rng = random.Random(6)
    for _ in range(60):
        counts = {rng.randint(1, 50): rng.randint(1, 30) for _ in range(rng.randint(1, 12))}
        left = dict(counts)
        for bin_, times in combinations(counts, 50):
            for _ in range(times):
                longest = max(k for k, n in left.items() if n)
                assert bin_[0][0] == longest
                best = fullest({**left, longest: left[longest] - 1}, 50 - longest)
                assert sum(k * n for k, n in bin_) == longest + sum(k * n for k, n in best.items())
                for k, n in bin_:
                    left[k] -= n
        assert not any(left.values())
    assert combinations({}, 10) == []


def test_pack_odd_rows_hot_length_and_empty(spark):
    rows = spark.range(0, 700, 1, 5).select((F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 13)).alias("length"),
                                            F.lit("x").alias("offset_of"), "id")
    got = pack(rows, 10).collect()
    assert len(got) == 700
    odd = [r for r in got if r.length not in range(1, 11)]
    assert odd and all(r.sequence_id is None and r.offset is None for r in odd)
    fit = [r for r in got if r.sequence_id is not None]
    least = max(sum(r.length for r in fit) / 10, sum(r.length > 5 for r in fit))  # no two of these fit together
    assert check_packed(fit, 10) <= 1.05 * least + 1
    nulls = spark.createDataFrame([(None,), (3,), (3,)], "length int")
    assert sorted(str(r.sequence_id) for r in pack(nulls, 10).collect()) == ["0", "0", "None"]
    assert pack(rows.limit(0), 10).collect() == []


def test_sequences_hold_all_ids(docs):
    packed = pack(token_pieces(docs, PATH, 256, with_ids=True), 256)
    got = sequences(packed).collect()
    assert sum(len(r.ids) for r in got) == sum(len(ids_of(t)) for _, t, *_ in ROWS) and max(len(r.ids) for r in got) <= 256
    for r in got:
        for p in r.pieces:
            whole = {tuple(ids_of(t)[256 * p.piece:256 * p.piece + 256]) for k, t, *_ in ROWS if k == p.doc_id}
            assert tuple(r.ids[p.offset:p.offset + p.length]) in whole


def test_op11_on_the_whole_table(spark):
    got = Q.op11(spark, SF_SMALL).collect()
    want = set()
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = ids_of(r.text)
        want |= {(r.doc_id, k // 2048, k, len(ids[k:k + 2048]), crc(ids[k:k + 2048])) for k in range(0, len(ids), 2048)}
    assert {tuple(r[:5]) for r in got} == want and len(got) == len(want)
    assert check_packed(got, 2048) <= -(-sum(r.length for r in got) // 2048) + 1


# ---- periodic runs ---------------------------------------------------------------------------

def brute_runs(words, exponent, least):
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, exponent * q) and not any(a <= i and a + m >= i + size and q % p == 0 for a, m, p in out):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_lyndon_arrays_and_runs_of_short_sequences():
    rng = random.Random(7)
    for _ in range(1500):
        s = [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 30))]
        s = (s[:4] + s[:rng.randint(1, 6)] * 8)[:40] if rng.random() < 0.5 else s
        s = np.unique(s, return_inverse=True)[1].tolist()
        want = [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]
        assert lyndon_array(s) == want
        for exponent, least in ((4, 6), (3, 1)):
            assert runs(np.array(s), exponent, least) == brute_runs(s, exponent, least)
    assert lyndon_array([]) == []


def test_collapse_runs_of_texts(spark, docs):
    rng = random.Random(8)
    texts = [t for _, t, *_ in ROWS]
    for _ in range(60):
        some = [f"w{rng.randrange(6)}" for _ in range(rng.randint(0, 12))]
        texts.append(" ".join(some * rng.randint(1, 6) + [f"x{rng.randrange(90)}" for _ in range(40)] + some[:3] * rng.randint(1, 9)))
    texts.append("A a " * 40000)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({k: F.lit(v) for k, v in CLASH.items()})
    got = {r.doc_id: r for r in collapse_runs(df, keep=["piece"]).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        words = [w.decode() for w in (text or "").encode().split()]
        found = [(0, 80000, 2)] if i == len(texts) - 1 else brute_runs(words, 4, 6) if len(words) < 500 else None
        if found is not None:
            assert [tuple(r) for r in got[i].runs] == found and got[i].collapsed == collapsed(words, found)
    assert collapse_runs(docs).count() == len(ROWS) and collapse_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        collapse_runs(docs, exponent=2)


def test_op12_on_the_whole_table(spark):
    got = {r.doc_id: r for r in Q.op12(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        words = [w.decode() for w in (d.text or "").encode().split()]
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 700 and h % 10:
            continue  # the brute force is cubic at worst
        found = brute_runs(words, 4, 6)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        r = got[d.doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words, found).encode()).hexdigest()


# ---- manifest --------------------------------------------------------------------------------

def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(nodes, fanout):
    out = [nodes]
    while len(nodes) > 1:
        nodes = [H("".join(nodes[a:a + fanout])) for a in range(0, len(nodes), fanout)]
        out.append(nodes)
    return out


def plain_manifest(rows, fanout):
    """(group, order, leaf) to rows (order, leaf, subroot, root, siblings)."""
    groups = {}
    for g, k, d in rows:
        groups.setdefault(g, []).append((k, d))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {g: tree([d for _, d in groups[g]], fanout) for g in names}
    top, out = tree([trees[g][-1][0] for g in names], fanout), []
    for at, g in enumerate(names):
        for i, (k, d) in enumerate(groups[g]):
            proof = ""
            for levels, j in ((trees[g], i), (top, at)):
                for level in levels[:-1]:
                    a = j // fanout * fanout
                    proof += "".join(level[a:j] + level[j + 1:a + fanout])
                    j //= fanout
            out.append((k, d, trees[g][-1][0], top[-1][0], proof))
    return sorted(out, key=str)


@pytest.mark.parametrize("fanout, levels, sizes", [
    (2, 1, [1, 2, 3, 17, 33]), (3, 1, [28, 10, 82]), (2, 2, [70]), (16, 3, [40, 1]), (4, 1, [5] * 21), (3, 2, [0])])
def test_manifest_equals_plain_trees(spark, fanout, levels, sizes):
    rows = [(None if s == 0 else f"é{s}", None if i == 4 else i // 2 * 2, H(f"{s} {i // 2}")) for s, n in enumerate(sizes) for i in range(n)]
    random.Random(3).shuffle(rows)
    df = spark.createDataFrame(rows, "source string, doc_id long, leaf string").repartition(4).withColumn("at", F.lit(1))
    got = manifest(df, carry=["at"], fanout=fanout, levels=levels).select(
        "doc_id", "leaf", "subroot", "root", siblings(F.col("proof")).alias("s"), folded(F.col("leaf"), F.col("proof")).alias("f")).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == plain_manifest(rows, fanout)
    assert all(r.f == r.root for r in got)


def test_leaf_fields_and_odd_rows(spark, docs):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    names = ("doc_id", "source", "lang", "n_chars", "text")
    df = docs.drop("leaf").withColumn("leaf", leaf(*[F.col(c) for c in names])).withColumn("own", F.col("leaf"))
    got = manifest(df, carry=["own", "n"]).collect()
    want = sorted(H("".join(map(field, (k, s, lang, n, t)))) for k, t, s, lang, n in ROWS)
    assert sorted(r.leaf for r in got) == want and all(r.own == r.leaf and r.n == 5 for r in got)


def test_op13_finds_what_was_tampered_with(spark):
    got = Q.op13(spark, SF_SMALL).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in got:
        changed = zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and any("A" <= c <= "Z" for c in docs[r.doc_id] or "")
        assert r.verified == (not changed)
