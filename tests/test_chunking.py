"""Child-chunk window counts (FIXTURES.md) and pre-processing."""

import pytest

from sitecorpus.operators.chunking import children, preprocess


@pytest.mark.parametrize("n,pieces", [(1, 1), (512, 1), (513, 2), (974, 2), (975, 3), (2000, 5)])
def test_window_counts(spark, n, pieces):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(n)))], "doc_id long, text string")
    out = children(df).orderBy("piece_no").collect()
    assert len(out) == pieces
    assert out[-1].token_start + out[-1].n_tokens == n
    assert all(r.n_tokens <= 512 for r in out)


def test_segments_and_blank(spark):
    df = spark.createDataFrame([(1, "a\n\n b"), (2, " \n\t")], "doc_id long, text string")
    assert children(df).filter("doc_id = 1").count() == 2
    assert children(df).filter("doc_id = 2").count() == 0


def test_overlap_must_be_smaller(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError):
        children(df, overlap=512)


def test_preprocess(spark):
    df = spark.createDataFrame([("a  b\t\tc\n\n\n\nd https://x.y/z e@x.org",)], "t string")
    assert df.select(preprocess("t")).first()[0] == "a b c\n\nd https://x.y/z e@x.org"
    assert df.select(preprocess("t", urls_emails=True)).first()[0] == "a b c\n\nd "


def _py_windows(n, max_tokens, overlap):
    """The rule in plain Python: windows of max_tokens stepping max_tokens - overlap, up to
    the first window that reaches the end of the segment."""
    out, start = [], 0
    while True:
        end = min(start + max_tokens, n)
        out.append((start, end - start))
        if end >= n:
            return out
        start += max_tokens - overlap


@pytest.mark.parametrize("max_tokens,overlap", [(512, 50), (7, 3), (5, 0), (2, 1)])
def test_windows_match_python_rule(spark, max_tokens, overlap):
    import random
    rng = random.Random(max_tokens * 31 + overlap)
    lengths = [rng.randint(1, 3 * max_tokens + 5) for _ in range(40)]
    df = spark.createDataFrame([(i, " ".join("t" for _ in range(n))) for i, n in enumerate(lengths)],
                               "doc_id long, text string")
    got = {}
    for r in children(df, max_tokens=max_tokens, overlap=overlap).collect():
        got.setdefault(r.doc_id, []).append((r.piece_no, r.token_start, r.n_tokens))
    for i, n in enumerate(lengths):
        assert [(s, c) for _, s, c in sorted(got[i])] == _py_windows(n, max_tokens, overlap), n
