"""Packing of rows with lengths into sequences of a fixed capacity by minimum bin slack.

Method: a bin takes the longest row that is left; a bitset of reachable sums, built up over the
available lengths (long ones first), finds the fullest feasible combination for the room beside
it, which is then removed. Which rows of a length are taken does not matter, so bins are found on the counts
per length alone, ``capacity`` numbers however many rows there are, and a combination that stays
feasible is the fullest for the next bins too: it is repeated as often as the counts allow. Every
combination uses up a length, so there are a few thousand of them at most.

The rows of a length are numbered without a sort: within the task that made them, plus the counts
of the tasks before. A row's number gives its bin and place.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sitecorpus.llm.stored import store

RANKS = 1 << 42  # rows of one length at most


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """How many rows of each length make the largest sum of at most ``room``; among equal sums the
    one found with long rows first."""
    reach, mask, steps = 1, (2 << room) - 1, []
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        left, many = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            taken = min(many, left)
            more = (reach | reach << taken * length) & mask
            if more != reach:
                steps.append((length, taken, reach))
                reach = more
            left, many = left - taken, 2 * many
        if reach >> room & 1:
            break
    total, picked = reach.bit_length() - 1, {}
    for length, taken, before in reversed(steps):
        if not before >> total & 1:
            total -= taken * length
            picked[length] = picked.get(length, 0) + taken
    return picked


def combinations(counts: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """(rows of each length in a bin, longest first; number of such bins), until no row is left."""
    counts, out = {k: n for k, n in counts.items() if n}, []
    while counts:
        longest = max(counts)
        rest = {**counts, longest: counts[longest] - 1}
        bin_ = fullest(rest, capacity - longest)
        bin_[longest] = bin_.get(longest, 0) + 1
        times = min(counts[x] // n for x, n in bin_.items())
        for x, n in bin_.items():
            counts[x] -= times * n
            if not counts[x]:
                del counts[x]
        out.append((sorted(bin_.items(), reverse=True), times))
    return out


def slots(bins: list) -> dict[str, np.ndarray]:
    """For each length, the row numbers that a combination takes: ``key`` (length and first row
    number), rows per bin, first bin, place of the first row in the bin."""
    used, out, sequence = {}, [], 0
    for bin_, times in bins:
        offset = 0
        for length, n in bin_:
            out.append((length * RANKS + used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    out.sort()
    return dict(zip(("key", "rows", "sequence", "offset"), np.array(out, np.int64).reshape(-1, 4).T, strict=True))


def numbered_lengths(rows: DataFrame, length: str, capacity: int) -> DataFrame:
    """``rows`` with ``part`` and ``place``, the task that holds a row and how many rows of its length
    the task had before. Only for rows whose order within a task stays the same until written."""
    schema = T.StructType(list(rows.schema.fields)).add("part", "long").add("place", "long")
    at = rows.columns.index(length)

    def number(batches):
        part, made = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = pd.Series(batch.column(at).to_numpy(zero_copy_only=False)).fillna(0).astype("int64")
            sizes = sizes.where((sizes > 0) & (sizes <= capacity), 0)
            place = sizes.groupby(sizes).cumcount().to_numpy() + made[sizes.to_numpy()]
            made += np.bincount(sizes, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(place), part, np.int64)),
                                              pa.array(place.astype(np.int64))], names=schema.names)
    return rows.mapInArrow(number, schema)


def pack(rows: DataFrame, capacity: int = 2048, length: str = "length") -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``: rows of one sequence lie gapless from 0 and their
    lengths sum to at most ``capacity``. Columns ``part`` and ``place`` (see ``numbered_lengths``) are
    taken from the rows if they have both, and never returned.

    Ties: rows of one length are alike, the task that holds them decides. A row whose length is null,
    below 1 or above the capacity gets null for both. Repeated rows are packed each; an empty table
    gives an empty result."""
    keep = [c for c in rows.columns if c not in ("part", "place")]
    if not {"part", "place"} <= set(rows.columns):
        rows = numbered_lengths(rows.select(keep), length, capacity)
    rows = store(rows, "pieces")  # part and place are fixed from here on
    fits = F.col(length).between(1, capacity)
    each = (rows.filter(fits).groupBy("part", F.col(length).cast("long").alias("_length"))
            .agg(F.count(F.lit(1)).alias("n")))
    each = store(each, "lengths")
    counts = {r[0]: r[1] for r in each.groupBy("_length").agg(F.sum("n")).collect()}  # capacity rows at most
    table = slots(combinations(counts, capacity))
    before = Window.partitionBy("_length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = each.select(F.col("part").alias("_part"), "_length",
                        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))

    @F.pandas_udf("struct<sequence:long,offset:long>")
    def place(size: pd.Series, number: pd.Series) -> pd.DataFrame:
        size, number = size.to_numpy(), number.to_numpy()
        key = size.astype(np.int64) * RANKS + number
        slot = np.searchsorted(table["key"], key, "right") - 1
        number = key - table["key"][slot]
        n = table["rows"][slot]
        return pd.DataFrame({"sequence": table["sequence"][slot] + number // n,
                             "offset": table["offset"][slot] + number % n * size})

    placed = (rows.filter(fits).join(first, (F.col("part") == F.col("_part")) & (F.col(length) == F.col("_length")))
              .withColumn("_at", place(F.col("_length"), F.col("place") + F.col("_first"))))
    out = placed.select(*keep, F.col("_at.sequence").alias("sequence_id"), F.col("_at.offset").alias("offset"))
    odd = rows.filter(~F.coalesce(fits, F.lit(False)))
    return out.union(odd.select(*keep, F.lit(None).cast("long"), F.lit(None).cast("long")))


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (all ids in order) and pieces (doc_id, piece,
    offset, length), from packed pieces with their ``ids``. A sequence is one row of at most the
    capacity."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "length", "piece", "doc_id", "ids")))
    return packed.filter("sequence_id IS NOT NULL").groupBy("sequence_id").agg(rows.alias("p")).select(
        "sequence_id", F.flatten("p.ids").alias("ids"),
        F.transform("p", lambda p: F.struct(p["doc_id"], p["piece"], p["offset"], p["length"])).alias("pieces"))
