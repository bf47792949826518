"""Folds and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def held_out(key: str) -> Column:
    """Whether crc32 of the key as text leaves 0 modulo 5 (a null key counts as empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def by_value(rows: DataFrame, column: str, per_value: int, key: str) -> DataFrame:
    """About ``per_value`` rows of each value of ``column`` (all, if there are fewer), chosen by a
    hash of the key; twice as many at most. The values are few (labels)."""
    counts = {r[0]: r[1] for r in rows.groupBy(column).count().collect()}
    if not counts:
        return rows
    share = F.element_at(F.create_map(*[F.lit(x) for v, n in counts.items()
                                        for x in (v, min(1.0, per_value / n))]), F.col(column))
    picked = rows.filter(F.pmod(F.xxhash64(F.col(key), F.lit("sample")), F.lit(1 << 30)) < share * (1 << 30))
    return picked.limit(2 * per_value * len(counts))
