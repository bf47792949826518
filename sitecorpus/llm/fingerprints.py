"""Fingerprints of documents by closed syncmers, in DataFrame operations only.

Method: the symbols are words. A window of ``K`` words is a closed syncmer if the smallest hash of
its ``K`` inner one-word substrings is that of its first or last word; whether it is chosen depends
on the window alone, so equal passages choose equal anchors wherever they stand. The fingerprint
is all anchors of the text, (place, hash) in order of place, whatever its length.

Two texts are matched by position: of the anchors of one hash, the first of one text belongs to the
first of the other, and so on. The likeness of two texts is the share of the words inside anchors
that lie inside matched ones, over both texts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitecorpus.llm.hash_counts import text_bytes
from sitecorpus.llm.stored import store

RANGE_BYTES = 8 << 20  # text in a range of keys, about
MOST_CUTS = 1_000
K = 3
FEW = 32  # hashes common to two texts that are looked up one by one, at most


def _no_pairs() -> Column:
    return F.array().cast("array<struct<a:int,b:int>>")


def _words(text: Column) -> Column:
    parts = F.split(text, r"[\x20\x09-\x0D]+", -1)
    return F.filter(parts, lambda w: w != "")


def _hashes(text: Column) -> Column:
    return F.transform(_words(text), lambda w: F.xxhash64(w))


def _starts(h: Column, k: int) -> Column:
    """Places (from 1) of the chosen windows in an array of word hashes."""
    def chosen(i):
        inner = [F.element_at(h, (i + j).cast("int")) for j in range(1, k - 1)]
        edge = F.least(F.element_at(h, i.cast("int")), F.element_at(h, (i + (k - 1)).cast("int")))
        return edge <= (F.least(*inner) if len(inner) > 1 else inner[0])
    return F.filter(F.sequence(F.lit(1), F.size(h) - (k - 1)), chosen)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once for a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column, k: int = K) -> Column:
    """(at, hash) of the chosen windows in order; ``at`` counts words from 0. A text of fewer than
    ``k`` words, or without a chosen window, has one anchor, of its whole sequence; one without
    words (or null) has none."""
    def of(h):
        found = F.transform(_starts(h, k), lambda i: F.struct((i - 1).cast("int").alias("at"), F.xxhash64(
            *[F.element_at(h, (i + j).cast("int")) for j in range(k)]).alias("hash")))
        whole = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(h).alias("hash")))
        none = F.array().cast("array<struct<at:int,hash:bigint>>")
        long = _let(found, lambda x: F.when(F.size(x) > 0, x).otherwise(whole))
        return F.when(F.size(h) >= k, long).when(F.size(h) > 0, whole).otherwise(none)
    return _let(_hashes(F.coalesce(text, F.lit(""))), of)


def fingerprint(found: Column) -> Column:
    """The anchors as text: 8 hexadecimal digits of the place and 16 of the hash for each."""
    return F.lower(F.array_join(F.transform(found, lambda x: F.concat(
        F.lpad(F.hex(x["at"]), 8, "0"), F.lpad(F.hex(x["hash"]), 16, "0"))), ""))


def _leading(a: Column, b: Column) -> Column:
    """The number of leading anchors of one hash, place by place of the arrays."""
    same = F.zip_with(a["hash"], b["hash"], lambda x, y: x.eqNullSafe(y))
    return _let(F.array_position(same, False), lambda n: F.when(n > 0, (n - 1).cast("int")).otherwise(F.size(a)))


def _after(found: Column, n: Column) -> Column:
    return F.slice(found, n + 1, F.size(found))


def matches(a: Column, b: Column) -> Column:
    """(a, b): the places of the matched anchors. Anchors that both texts begin with belong to each other.
    Of the rest, only hashes of both texts can match; if these are ``FEW``, other anchors are left out
    before the sort."""
    def of_rest(n):
        pair = F.struct(_after(a, n).alias("a"), _after(b, n).alias("b"))

        def shared(x):
            common = F.array_intersect(x["a"]["hash"], x["b"]["hash"])

            def of_common(c):
                def some(found):
                    return F.filter(found, lambda y: F.array_contains(c, y["hash"]))
                return F.when(F.size(c) == 0, _no_pairs()).when(
                    F.size(c) <= FEW, _sorted_matches(some(x["a"]), some(x["b"]))).otherwise(
                    _sorted_matches(x["a"], x["b"]))
            return _let(common, of_common)
        head = F.zip_with(F.slice(a["at"], F.lit(1), n), F.slice(b["at"], F.lit(1), n),
                          lambda x, y: F.struct(x.alias("a"), y.alias("b")))
        return F.concat(head, _let(pair, shared))
    return _let(_leading(a, b), of_rest)


def _sorted_matches(a: Column, b: Column) -> Column:
    """(a, b): the places of the matched anchors. The anchors of both texts are sorted by hash, text
    and place; a run is those of one hash in one text, and two runs of a hash are paired in order."""
    def tagged(found, side):
        return F.transform(found, lambda x: F.struct(
            x["hash"].alias("hash"), F.lit(side).alias("side"), x["at"].alias("at")))

    def of_sorted(s):
        def at(i):
            return F.element_at(s, i.cast("int"))

        def first(i):
            return (i == 1) | (at(F.greatest(i - 1, F.lit(1)))["hash"] != at(i)["hash"]) | (
                at(F.greatest(i - 1, F.lit(1)))["side"] != at(i)["side"])

        def of_runs(runs):  # starts of the runs, and the place after the last
            def paired(j):
                one, two = F.element_at(runs, j), F.element_at(runs, j + 1)
                n = F.least(two - one, F.element_at(runs, j + 2) - two)
                return F.when((at(one)["side"] == 0) & (at(one)["hash"] == at(two)["hash"]), F.transform(
                    F.sequence(F.lit(0), n - 1),
                    lambda q: F.struct(at(one + q)["at"].alias("a"), at(two + q)["at"].alias("b"))))
            pairs = F.transform(F.sequence(F.lit(1), F.size(runs) - 2), paired)
            return F.when(F.size(runs) >= 3, F.flatten(F.filter(pairs, lambda p: p.isNotNull()))).otherwise(_no_pairs())

        starts = F.filter(F.sequence(F.lit(1), F.size(s)), first)
        return F.when(F.size(s) > 0, _let(F.concat(starts, F.array(F.size(s) + 1)), of_runs))
    found = _let(F.sort_array(F.concat(tagged(a, 0), tagged(b, 1))), of_sorted)
    return F.coalesce(found, _no_pairs())


def _covered(places: Column, k: int) -> Column:
    """The number of words in windows of ``k`` at the ascending places."""
    def of(p):
        new = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda x, y: F.least(F.lit(k), y - x))  # the last has no y
        return F.aggregate(new, F.lit(0), lambda n, x: n + x)
    return _let(places, of)


def _share(a: Column, b: Column, whole: Column, k: int) -> Column:
    """The likeness of two texts; ``whole`` is the number of words in windows of both."""
    common = _let(matches(a, b), lambda m: _covered(F.sort_array(m["a"]), k) + _covered(F.sort_array(m["b"]), k))
    return _let(whole, lambda n: F.when(n == 0, 1.0).otherwise(common / n))


def likeness(a: Column, b: Column, k: int = K) -> Column:
    """0 to 1, from the anchors of two texts; two texts without words are alike. A text shorter than
    a window has one anchor, which counts as a whole window."""
    return _share(a, b, _covered(a["at"], k) + _covered(b["at"], k), k)


def _range_of(docs: DataFrame, key: str, size: int) -> Column:
    """The number of the range that a key falls in, ascending with the key. The ranges lie between
    up to MOST_CUTS approximate quantiles of the keys; a larger table also cuts each interval into
    equal parts."""
    n = max(1, math.ceil(size / RANGE_BYTES))
    parts = math.ceil(n / MOST_CUTS)
    n = min(n, MOST_CUTS)
    cuts = docs.select(F.percentile_approx(key, [i / n for i in range(n + 1)], 10_000)).first()[0]
    if not cuts:
        return F.lit(0).cast("long")
    cuts = sorted(set(cuts))
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts])
    i = F.greatest(F.lit(1), F.size(F.filter(bounds, lambda c: c <= F.col(key))))
    low, high = F.element_at(bounds, i), F.coalesce(F.get(bounds, i), F.element_at(bounds, -1) + 1)
    inner = F.floor((F.col(key) - low) * float(parts) / (high - low))
    inner = F.least(F.greatest(inner, F.lit(0)), F.lit(parts - 1))
    return F.when(F.col(key).isNull(), -1).otherwise(i * parts + inner).cast("long")


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, next_text): each row with the one of the next greater
    key; after the last comes the first.

    Rows are dealt by ranges of the key, each sorted by a window. The last row of a range needs the
    first row of the next range that has rows: those rows (one for each range, so few that they
    are broadcast) are also sent to the range before. Null keys come first; rows of one key are
    ordered by a hash of the text. The key is an integer."""
    size = text_bytes(docs, text)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("place", _range_of(rows, "doc_id", size)).withColumn("order", F.struct(
        F.coalesce("doc_id", F.lit(-(1 << 63))).alias("id"), F.xxhash64("text").alias("h")))
    heads = rows.groupBy("place").agg(F.min("order").alias("order"))
    by_place = Window.orderBy("place")
    last = Window.orderBy(F.col("place").desc())
    heads = store(heads.select("order", F.coalesce(
        F.lag("place").over(by_place), F.first("place").over(last)).alias("before")), "range-heads")
    sent = rows.join(F.broadcast(heads), "order", "left").select(
        "doc_id", "text", F.explode(F.filter(F.array(
            F.struct(F.col("place"), F.lit(False).alias("extra"), F.col("order")),
            F.struct(F.col("before").alias("place"), F.lit(True).alias("extra"), F.col("order"))),
            lambda x: x["place"].isNotNull())).alias("at"))
    dealt = sent.select("doc_id", "text", "at.place", "at.extra", F.col("at.order").alias("order")).repartition("place")
    window = Window.partitionBy("place").orderBy("extra", "order")
    return (dealt.select("doc_id", "text", "extra", F.lead("text").over(window).alias("next_text"))
            .filter("not extra").drop("extra"))


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars (code points), edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next. The edited text has the last floor(n_chars / 2) code
    points replaced by the first as many (or all) of the next document.

    A null text is empty: its fingerprint is "", like another empty one's with likeness 1. A single
    row is its own next. Repeated rows stay (each is next to the other); other columns are ignored;
    an empty table gives an empty result."""
    rows = with_next(docs, key, text).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half),
                      F.substring(F.col("next_text"), F.lit(1), half))

    def compared(x):
        def near(own):
            return F.struct(
                F.sha2(x["edited"], 256).alias("edited_sha256"),
                fingerprint(x["own"]).alias("fingerprint"), fingerprint(x["new"]).alias("edited_fingerprint"),
                _share(x["own"], x["new"], own + _covered(x["new"]["at"], k), k).alias("near_edited"),
                _share(x["own"], x["next"], own + _covered(x["next"]["at"], k), k).alias("near_next"))
        return _let(_covered(x["own"]["at"], k), near)

    found = _let(edited, lambda e: _let(F.struct(
        e.alias("edited"), anchors(F.col("text"), k).alias("own"), anchors(e, k).alias("new"),
        anchors(F.col("next_text"), k).alias("next")), compared))
    return rows.select("doc_id", "n_chars", found.alias("found")).select("doc_id", "n_chars", "found.*")
