"""Runs (maximal periodic stretches) of words, and texts with their repetitions taken out.

A run is a stretch of words with smallest period q, at least ``exponent`` times as long as q and
``least`` words long, that no neighbouring word extends. Its first q words stay, the rest is
repetition.

Method (Baier grouping): phase one of the grouping suffix sorter takes groups of suffixes from the
highest down; each suffix hands its group's context to the nearest suffix before it that is in a
lower group, which thereby moves to a new group just above its old one. When a group's turn comes,
its context is the longest Lyndon word that begins at each of its suffixes: the Lyndon array, directly.
Every run has a root that is the longest Lyndon word at its place under one of two opposite orders of the
words; it begins in the run's first period, so in a run of three periods or more it occurs twice in a row. Such
roots are extended to both sides by comparing words at the root's distance (longest common
extensions), which gives all runs.

A word of a run of exponent e occurs e times in it. So texts are first cut at words that are rarer
than that in their stretch, again until nothing changes, and stretches too short are left: no run
is lost or cut, since a word that extends a run occurs as often.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sitecorpus.llm.words import Batch, in_parts, mix

BATCH_CHARS = 1 << 21  # text that is searched at once, about
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def lyndon_array(letters: list[int]) -> list[int]:
    """Length of the longest Lyndon word that begins at each place (phase one of the grouping
    sorter). ``letters`` are numbers from 0 without gaps."""
    n = len(letters)
    members: list[list[int]] = [[] for _ in range(max(letters, default=-1) + 1)]
    for i, c in enumerate(letters):
        members[c].append(i)
    group, size = list(letters), [1] * len(members)
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    above[-1:] = [-1]
    out, lower, done = [0] * n, [-1] * n, bytearray(n)
    g = len(members) - 1
    while g >= 0:
        own = sorted(i for i in members[g] if group[i] == g)
        context, heirs = size[g], {}
        for i in own:
            done[i] = 1
        for i in own:
            out[i] = context
            p = i - 1
            while p >= 0 and done[p]:
                p = lower[p]
            lower[i] = p
            if p >= 0:
                heirs[p] = heirs.get(p, 0) + 1
        new = {}
        for p, times in heirs.items():
            new.setdefault((group[p], times), []).append(p)
        for old, times in sorted(new, reverse=True):  # the most copies lie highest
            moved = new[old, times]
            number = len(members)
            # directly above the old group, so below those with more copies
            members.append(moved)
            size.append(size[old] + times * context)
            below.append(old)
            above.append(above[old])
            if above[old] >= 0:
                below[above[old]] = number
            above[old] = number
            for p in moved:
                group[p] = number
        g = below[g]
    return out


def _reach(word: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words agree from places i and j on (step 1) or back from them (step -1)."""
    most = len(word) - max(i, j) if step > 0 else min(i, j) + 1
    found, width = 0, 64
    while found < most:
        m = min(width, most - found)
        if step > 0:
            same = word[i + found:i + found + m] == word[j + found:j + found + m]
        else:
            same = (word[i - found - m + 1:i - found + 1] == word[j - found - m + 1:j - found + 1])[::-1]
        first = int(same.argmin())
        if not same[first]:
            return found + first
        found, width = found + m, 2 * width
    return found


def runs(word: np.ndarray, exponent: int, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of word numbers, in order."""
    word = np.unique(word, return_inverse=True)[1]
    n, found = len(word), set()
    for letters in (word, word.max(initial=0) - word):
        period = np.array(lyndon_array(letters.tolist()), np.int64)
        root = np.flatnonzero(np.arange(n) + 2 * period <= n)
        q = period[root]
        twice = (word[root] == word[root + q]) & (word[root + q - 1] == word[root + 2 * q - 1])
        until: dict[int, int] = {}  # by period, the end of the last run
        for i, q in zip(root[twice].tolist(), q[twice].tolist(), strict=True):
            if i + q <= until.get(q, 0):
                continue  # in that run
            right = _reach(word, i, i + q, 1)
            if right < q:
                continue  # the root does not occur twice
            start = i - _reach(word, i - 1, i + q - 1, -1)
            end = i + q + right
            until[q] = end
            if end - start >= max(least, exponent * q):
                found.add((start, end - start, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def stretches(word: np.ndarray, owner: np.ndarray, exponent: int, least: int) -> list[tuple[int, int]]:
    """First and end of the stretches of the words (hashes, by owner) that can hold runs."""
    at, part = np.arange(len(word)), owner.astype(np.uint64)
    while len(at):
        code = pd.factorize(word[at] ^ mix(part + np.uint64(1)))[0]
        kept = at[np.bincount(code)[code] >= exponent]
        # a new stretch begins where a word is left out or another stretch begins
        before = np.empty(len(word) + 1, np.uint64)
        before[at] = part
        new = np.ones(len(kept), bool)
        new[1:] = (kept[1:] != kept[:-1] + 1) | (before[kept[1:]] != before[kept[:-1]])
        number = np.cumsum(new) - 1
        long = np.bincount(number, minlength=1)[number] >= least if len(kept) else np.empty(0, bool)
        if long.all() and len(kept) == len(at):
            first = np.flatnonzero(new)
            return list(zip(at[first].tolist(), (at[np.append(first[1:], len(at)) - 1] + 1).tolist(), strict=True))
        at, part = kept[long], number[long].astype(np.uint64)
    return []


def _searched(texts: list, exponent: int, least: int) -> list[tuple[list, bytes]]:
    """Runs and what is left of each text."""
    batch = Batch(texts)
    found: list[list] = [[] for _ in texts]
    owner = np.repeat(np.arange(len(texts)), batch.n_words)
    for a, b in stretches(batch.hash, owner, exponent, least):
        text = int(owner[a])
        found[text] += [(a - int(batch.first[text]) + s, length, q) for s, length, q in runs(batch.hash[a:b], exponent, least)]
    out = []
    for raw, some in zip(batch.raws, found, strict=True):
        kept = raw.split()
        if some:
            gone = np.zeros(len(kept) + 1, np.int64)
            np.add.at(gone, [s + q for s, _, q in some], 1)
            np.add.at(gone, [s + length for s, length, _ in some], -1)
            stay = np.cumsum(gone) == 0
            kept = [w for w, x in zip(kept, stay.tolist()) if x]
        out.append((some, b" ".join(kept)))
    return out


def collapse_runs(docs: DataFrame, exponent: int = 4, least: int = 6, key: str = "doc_id", text: str = "text",
                  keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``keep`` columns, ``runs`` (start, length, period in words, by start and then
    period) and ``collapsed``, the words joined by one space without those that any run contains after its
    first period.

    Words are maximal runs of characters other than space and 0x09-0x0D. A null or empty text has no words, no
    runs and an empty collapsed text. Two runs may overlap; a word goes if either drops it. Repeated rows and null keys
    stay as they are, other columns are ignored, an empty table gives an empty result. Words are compared by
    64-bit hashes, which two unequal words of one text share with a probability of 10⁻⁹ at 10⁵ words."""
    if exponent < 3:
        raise ValueError("a root occurs twice in a row only in runs of three periods or more")
    rows = docs.select(F.col(text).alias("_text"), F.col(key).alias("doc_id"), *(keep or []))
    schema = T.StructType(list(rows.schema.fields[1:])).add("runs", T._parse_datatype_string(RUNS)).add("collapsed", "string")
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def search(batches):
        for batch in batches:
            for at, part in in_parts(batch.column(0).to_pylist(), BATCH_CHARS):
                found = _searched(part, exponent, least)
                each = pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in some] for some, _ in found], kind)
                left = pa.array([x for _, x in found], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*batch.slice(at, len(part)).columns[1:], each, left], names=schema.names)

    return rows.mapInArrow(search, schema)
