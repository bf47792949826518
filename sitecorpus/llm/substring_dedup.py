"""Removal of token passages that occur more than once in the corpus.

Method: Rabin-Karp hashes of every window of ``window`` words, counted in Spark
(``hash_counts``); each word that a repeated window covers is removed, so overlapping repeated
windows merge into maximal intervals. Windows are judged on the input, not on what is left.

Windows are compared by 64-bit hashes: among n windows about n**2 / 2**65 unequal pairs agree by
chance (0.0005 at 135 million).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sitecorpus.llm.hash_counts import chunked, text_bytes, with_counts
from sitecorpus.llm.words import Batch

WINDOW = 35
SCHEMA = ("doc_id string, n_words long, n_removed long, "
          "removed array<struct<start:int,end:int>>, kept string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, ``removed`` (word intervals, end
    exclusive, maximal), ``kept`` (the remaining words joined by one space).

    A null or empty text has no words and keeps "". Fewer words than a window: nothing is
    removed. Repeated rows are documents of their own, so all their windows repeat. A null key
    is kept. Other columns are ignored."""
    size = text_bytes(docs, text)
    rows = chunked(docs, [F.col(key).cast("string").alias("doc_id"), F.col(text).alias("text")],
                   [key, text], size)

    def hashes(part: pd.DataFrame):
        batch = Batch(part["text"])
        h, at, _ = batch.windows(window)
        return (batch, h, at), h

    def receive(part, state, distinct, repeated, _):
        batch, h, at = state
        hit = at[repeated[np.searchsorted(distinct, h)]]
        n = len(batch.hash) + 1
        gone = np.cumsum(np.bincount(hit, minlength=n) - np.bincount(hit + window, minlength=n))[:-1] > 0
        out = []
        for i, (doc, raw) in enumerate(zip(part["doc_id"], batch.raws, strict=True)):
            own = gone[batch.first[i]:batch.first[i + 1]]
            words, cut = raw.split(), []
            removed = int(own.sum())
            if removed:
                edge = np.flatnonzero(np.diff(own, prepend=False, append=False))
                cut = [{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)]
                words = [w for w, x in zip(words, own.tolist(), strict=True) if not x]
            out.append((doc, len(own), removed, cut,
                        b" ".join(words).decode("utf-8", "surrogatepass")))
        return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "removed", "kept"])

    out = with_counts(rows, size, hashes, receive, SCHEMA)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType))
