"""What Python workers hold while they work on a task, and what they keep for the tasks after it."""

import random
import tracemalloc
import weakref

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from sitecorpus.llm import ngram_jaccard, words
from sitecorpus.llm.piece_sampling import Sampler
from sitecorpus.llm.words import LOWER, Batch, distinct_per_text, mix, word_hashes

MODEL = public_tokenizers.path("piece_bpe_32k.model")
M = (1 << 64) - 1


def texts(n, size, seed=3):
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(50_000)}" for _ in range(size)) for _ in range(n)]


def test_cleared_lattices_are_freed():
    sampler = Sampler(MODEL, 1.0, 2, 9)
    keys, some = np.arange(40), [*texts(39, 60), None]
    first = sampler.texts(keys, some)
    held = [weakref.ref(x) for x in sampler.lattices.held.values()]
    assert len(held) >= 5 and all(x() is not None for x in held)
    sampler.lattices.clear()
    assert not [x for x in held if x() is not None]
    for a, b in zip(first, sampler.texts(keys, some), strict=True):  # and are found again
        assert [(x["ids"].tolist(), x["log_p"], x["perturbed"], x["inclusion"]) for x in a] == [
            (x["ids"].tolist(), x["log_p"], x["perturbed"], x["inclusion"]) for x in b]


def test_tables_of_powers_stay_small():
    whole = texts(4, 120_000)
    long = "x" * 1_500_000 + " end"
    batch = Batch([*whole, long])
    for size in (5, 35):
        batch.windows(size, short=True)
    kept = sum(t.nbytes for p in (words._BYTES, words._WORDS) for t in (p.up, p.down))
    assert kept <= 8 << 20
    alone = Batch([long])  # a word longer than a block
    assert alone.n_words.tolist() == [2] and alone.hash.tolist() == batch.hash[-2:].tolist()


@pytest.mark.parametrize("block", [1, 4, 7, 1 << 16])
@pytest.mark.parametrize("size", [1, 3, 9])
def test_windows_across_blocks(monkeypatch, block, size):
    some = ["a b c d e f g h i j k", None, "", "one two", "a b c d e", " ", "x", *texts(5, 12), "last one here"]
    monkeypatch.setattr(words, "BLOCK", block)
    batch = Batch(some, LOWER)
    base, want, short = int(words.WINDOW_BASE), [], []
    for k in range(len(some)):
        a, b = int(batch.first[k]), int(batch.first[k + 1])
        h = [int(x) for x in batch.hash[a:b]]
        hashed = lambda part: mix(np.array([sum(x * pow(base, j, 1 << 64) for j, x in enumerate(part)) & M], np.uint64))
        want += [(int(hashed(h[i:i + size])[0]), a + i, k) for i in range(b - a - size + 1)]
        if 0 < b - a < size:
            short.append((int(mix(hashed(h) + np.uint64(b - a))[0]), a, k))
    assert [tuple(int(v) for v in x) for x in zip(*batch.windows(size))] == want
    assert [tuple(int(v) for v in x) for x in zip(*batch.windows(size, short=True))] == want + short
    assert word_hashes(batch.raw)[2].tolist() == batch.hash.tolist()


def test_chunks_are_cut_part_by_part(spark, monkeypatch):
    """A chunk's n-grams take little more than their own memory, and are those of all its texts at once."""
    cut = []

    def with_counts(chunks, size, hashes, *rest, **more):
        cut.append(hashes)
        raise InterruptedError

    monkeypatch.setattr(ngram_jaccard, "with_counts", with_counts)
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(InterruptedError):
        ngram_jaccard._sets(docs, 5, 80, 100, True, "doc_id", "text")
    part = pd.DataFrame({"text": [None, *texts(300, 2_000), "", "two words", " "]})
    tracemalloc.start()
    (h, owner), same = cut[0](part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    batch = Batch(part["text"], LOWER)
    all_h, _, all_owner = batch.windows(5, short=True)
    all_h, all_owner = distinct_per_text(all_h, all_owner)
    assert h.tolist() == all_h.tolist() == same.tolist() and owner.tolist() == all_owner.tolist()
    assert peak < 5 * (h.nbytes + owner.nbytes), (peak, h.nbytes)
