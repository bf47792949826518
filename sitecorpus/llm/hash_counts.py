"""Counts of 64-bit hashes over a whole corpus, returned to the documents that hold them.

The hash space is cut into equal consecutive ranges (fragments). Documents are dealt into
chunks by a hash of their row; each chunk sends every fragment the sorted distinct hashes it
has there, packed as differences, and how often those occur that it holds more than once. A
fragment adds up the chunks and answers each with one bit per hash (does it occur more than
once anywhere?) and, if asked, the totals. The documents are shuffled once (Spark reuses the
exchange for sending and for receiving).

A chunk names a hash once however often it occurs, so a hash that a third of all rows hold
costs a fragment one entry per chunk. Chunks and fragments have bounded sizes and their number
follows the input; nothing depends on a partition number, so a lost task is simply run again.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

CHUNK_BYTES = 4 << 20        # text in a chunk, about
FRAGMENT_BYTES = 12 << 20    # text behind the hashes of a fragment, about


def pack(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as differences of so many whole bytes that few are longer; those
    are listed apart. Layout: width, first value, number of long ones, their places and values, the
    differences."""
    if not len(values):
        return b""
    steps = np.diff(values)
    width = 1
    while np.count_nonzero(steps >> np.uint64(8 * width)) * 32 > len(steps):
        width += 1
    long = np.flatnonzero(steps >> np.uint64(8 * width)) if width < 8 else np.empty(0, np.int64)
    low = np.ascontiguousarray(steps).view(np.uint8).reshape(-1, 8)[:, :width]
    return b"".join((bytes([width]), values[:1].tobytes(), np.uint64(len(long)).tobytes(),
                     long.astype(np.uint64).tobytes(), steps[long].tobytes(), low.tobytes()))


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.empty(0, np.uint64)
    width, first = data[0], np.frombuffer(data, np.uint64, 1, 1)
    n = int(np.frombuffer(data, np.uint64, 1, 9)[0])
    long, values = np.frombuffer(data, np.uint64, n, 17), np.frombuffer(data, np.uint64, n, 17 + 8 * n)
    low = np.frombuffer(data, np.uint8, offset=17 + 16 * n).reshape(-1, width)
    steps = np.zeros((len(low) + 1, 8), np.uint8)
    steps[1:, :width] = low
    steps = steps.view(np.uint64).ravel()
    steps[0] = first[0]
    steps[1:][long.astype(np.int64)] = values
    return np.cumsum(steps)


def _small(totals: np.ndarray) -> bytes:
    """Totals (1 to 2**32) in a byte each: eight steps from a power of two to the next, so that up to 16 all differ and a
    greater total never has a smaller byte."""
    return np.minimum((totals.astype(np.float32).view(np.uint32) >> np.uint32(20)) - np.uint32(127 << 3), 255).astype(np.uint8).tobytes()


def _large(data: bytes) -> np.ndarray:
    """The least totals that have these bytes."""
    return ((np.frombuffer(data, np.uint8).astype(np.uint32) + np.uint32(127 << 3)) << np.uint32(20)).view(np.float32).astype(np.int64)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0


def chunked(docs: DataFrame, columns: list, key: list[str], size: int) -> DataFrame:
    """The columns of each document and the chunk it is dealt to."""
    n = max(1, math.ceil(size / CHUNK_BYTES))
    return docs.select(*columns, F.pmod(F.xxhash64(*key), F.lit(n)).cast("int").alias("chunk"))


def with_counts(chunks: DataFrame, size: int, hashes: Callable, receive: Callable, schema: str,
                totals: bool = False, drop: int = 0) -> DataFrame:
    """``receive(rows, state, distinct, repeated, totals)`` for each chunk.

    ``hashes(rows)`` takes a chunk's rows and gives (state, hashes), one entry per occurrence;
    ``distinct`` are the chunk's distinct hashes ascending, ``repeated`` says of each whether it
    occurs twice or more in all chunks, ``totals`` how often, in steps of an eighth to a sixteenth (``_small``; None
    unless asked for). The answer is a data frame or an iterator of them.

    With ``drop``, hashes are counted, and are in ``distinct``, without their last ``drop`` bits: a hash that occurs
    once may then pass for repeated, never the other way round, and a chunk's differences take fewer bytes."""
    n = max(1, math.ceil(size / FRAGMENT_BYTES))

    def fragment_of(h):
        return ((h << np.uint64(drop) >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)

    def send(rows: pd.DataFrame) -> pd.DataFrame:
        h = hashes(rows)[1]
        h, count = np.unique(h >> np.uint64(drop), return_counts=True)
        bounds = np.searchsorted(fragment_of(h), np.arange(n + 1, dtype=np.uint64))
        out = []
        for k in np.flatnonzero(np.diff(bounds)):
            a, b = bounds[k], bounds[k + 1]
            more = np.flatnonzero(count[a:b] > 1).astype(np.uint32)
            out.append((int(k), int(rows["chunk"].iat[0]), int(b - a), pack(h[a:b]),
                        more.tobytes(), count[a:b][more].astype(np.uint32).tobytes()))
        return pd.DataFrame(out, columns=["fragment", "chunk", "n", "hashes", "more", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        ends = np.cumsum(rows["n"].to_numpy())
        count = np.ones(ends[-1], np.int64)
        for end, k, more, counts in zip(ends, rows["n"], rows["more"], rows["counts"], strict=True):
            count[end - k + np.frombuffer(more, np.uint32)] = np.frombuffer(counts, np.uint32)
        h = np.concatenate([unpack(x) for x in rows["hashes"]])
        order = np.argsort(h, kind="stable")
        h = h[order]
        new = np.ones(len(h), bool)
        new[1:] = h[1:] != h[:-1]
        total = np.empty(len(h), np.int64)
        total[order] = np.add.reduceat(count[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        out = []
        for end, k, chunk, fragment in zip(ends, rows["n"], rows["chunk"], rows["fragment"], strict=True):
            own = total[end - k:end]
            out.append((int(chunk), int(fragment), int(k), np.packbits(own > 1).tobytes(),
                        _small(own[own > 1]) if totals else b""))
        return pd.DataFrame(out, columns=["chunk", "fragment", "n", "bits", "totals"])

    def take(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        state, h = hashes(rows)
        h = np.unique(h >> np.uint64(drop))
        answers = answers.sort_values("fragment")
        repeated = np.concatenate([np.empty(0, np.uint8), *(
            np.unpackbits(np.frombuffer(b, np.uint8), count=k)
            for b, k in zip(answers["bits"], answers["n"], strict=True))]).astype(bool)
        if len(repeated) != len(h):
            raise ValueError("a chunk differs from the one that was counted")
        total = None
        if totals:
            total = np.ones(len(h), np.int64)
            total[repeated] = np.concatenate([np.empty(0, np.int64), *map(_large, answers["totals"])])
        return receive(rows, state, h, repeated, total)

    sent = chunks.groupBy("chunk").applyInPandas(
        send, "fragment int, chunk int, n int, hashes binary, more binary, counts binary")
    answers = sent.groupBy("fragment").applyInPandas(
        add, "chunk int, fragment int, n int, bits binary, totals binary")
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(take, schema)


def row_key(*names: str) -> Column:
    return F.xxhash64(*names)
