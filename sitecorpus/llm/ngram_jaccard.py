"""Similarity join of documents on word n-grams (Jaccard), and its connected classes.

Method: vertical partitioning. The order of all n-gram hashes is cut into fragments.

1. Each fragment counts its n-grams over the corpus (``hash_counts``). An n-gram of one document
   alone adds to no overlap, so a document goes on only if enough of its n-grams are shared. Counted are
   the first 40 bits of a hash: some n-grams of one document pass for shared, which changes no overlap.
2. Equal sets collapse into one representative. Each representative posts its rarest shared
   n-grams (prefix filter: two sets over the threshold share one of them).
3. Within an n-gram's postings, ordered by size, each set is paired with the next one. For
   each pair the overlap is counted in every fragment separately and summed, then compared with
   the threshold exactly; pairs that numbers of n-grams in bins rule out end before. Links give
   connected components; then the next ``NEAR`` are paired, as far as they are in different
   components. So a group of near copies is not paired over and over.
4. What is left are pairs further apart in a posting, of sets in different components. In postings
   of up to ``SHORT`` sets they are listed and verified like the near ones. In longer ones they
   are compared in blocks (the smaller components against everything), again fragment by
   fragment; each block returns one link per set and component. So the pairs listed stay in
   proportion to the postings, and no pair that could join two components is left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sitecorpus.llm.components import components, extended
from sitecorpus.llm.hash_counts import chunked, text_bytes, with_counts
from sitecorpus.llm.stored import store
from sitecorpus.llm.words import LOWER, Batch, distinct_per_text, give_back, in_parts, mix, numbered

NEAR = 4              # following sets that a posting pairs with
SHORT = 64            # sets of a posting whose open pairs are listed, at most
POSTING_BLOCK = 512   # postings that are ordered together, about
BLOCK_GRAMS = 1 << 17  # n-grams of the sets in a block, about
N_FRAGMENTS = 8
PART_CHARS = 1 << 19  # text of a chunk that is cut into n-grams at once, about
DROP = 24             # last bits of a hash that are left out where n-grams are counted
BIN_BITS = 6          # first bits of an n-gram that name its bin
NODES = ("row long, doc_id string, row_key long, n_shingles long, set_id string, rare int, grams array<long>, "
         "bins array<int>")


def _sets(docs: DataFrame, n: int, num: int, den: int, lower: bool, key: str, text: str) -> DataFrame:
    """A row per document; ``grams`` (shared n-grams, rarest first), ``rare`` (how many of them
    the prefix has) and ``bins`` (how many of them begin with the same bits) only where a link to
    another document is possible."""
    size = text_bytes(docs, text)
    chunks = chunked(docs, [F.col(key).cast("string").alias("doc_id"), F.col(text).alias("text"),
                            F.xxhash64(key, text).alias("row_key")], [key, text], size)
    salt = numbered(2, 77)

    def hashes(part: pd.DataFrame):
        found = []
        for at, texts in in_parts(part["text"], PART_CHARS):  # memory does not follow the chunk
            h, _, owner = Batch(texts, LOWER if lower else None).windows(n, short=True)
            h, owner = distinct_per_text(h, owner)
            found.append((h, owner.astype(np.int32) + np.int32(at)))
        h, owner = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        give_back()
        return (h, owner), h

    def receive(part, state, distinct, repeated, totals):
        h, owner = state
        at = np.searchsorted(distinct, h >> np.uint64(DROP))
        docs_n = len(part)
        size_of = np.bincount(owner, minlength=docs_n)
        first = np.concatenate(([0], np.cumsum(size_of)))
        shared = np.bincount(owner[repeated[at]], minlength=docs_n)
        need = -(-num * size_of // den)
        out = []
        for i, (doc, tk) in enumerate(zip(part["doc_id"], part["row_key"], strict=True)):
            a, b = first[i], first[i + 1]
            grams, rare, set_id, bins = None, None, None, None
            if size_of[i] and shared[i] >= need[i]:
                own, common = h[a:b], repeated[at[a:b]]
                set_id = "".join(f"{int(mix(own ^ s).sum(dtype=np.uint64)):016x}" for s in salt)
                t = totals[at[a:b]][common]
                own = own[common]
                grams = own[np.lexsort((own, t))].view(np.int64)
                rare = int(shared[i] - need[i] + 1)
                bins = np.bincount((own >> np.uint64(64 - BIN_BITS)).astype(np.int64), minlength=1 << BIN_BITS).astype(np.int32)
            out.append((int(part["chunk"].iat[0]) << 32 | i, doc, tk, int(size_of[i]), set_id, rare, grams, bins))
        give_back()
        return pd.DataFrame(out, columns=["row", "doc_id", "row_key", "n_shingles", "set_id", "rare", "grams", "bins"]
                            ).astype({"rare": "Int32"})

    sets = with_counts(chunks, size, hashes, receive, NODES, totals=True, drop=DROP)
    return store(sets.withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType)), "ngram-sets")


def _fragment(gram: Column) -> Column:
    """Equal consecutive ranges of the n-gram order."""
    return F.pmod(F.shiftright(gram, 61), F.lit(N_FRAGMENTS))


def _blocks(postings: DataFrame, per_block: str) -> DataFrame:
    """postings with ``block``, dealing each n-gram's postings into ``per_block`` blocks."""
    return postings.withColumn("block", F.pmod(F.xxhash64("node", "gram"), F.col(per_block)).cast("int"))


def _near_pairs(postings: DataFrame, sizes: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (a < b) of sets close by in an n-gram's postings; ``step`` is how far apart, at least."""
    dealt = _blocks(postings.join(sizes, "gram").withColumn(
        "k", F.ceil(F.col("m") / F.lit(POSTING_BLOCK))), "k")
    w = Window.partitionBy("gram", "block").orderBy("n", "node").rowsBetween(1, NEAR)
    pairs = (dealt.withColumn("next", F.collect_list(F.struct("node", "n")).over(w))
             .select("node", "n", F.posexplode("next").alias("step", "o"))
             .filter(F.col("n") * den >= F.col("o.n") * num))
    return pairs.groupBy(F.least("node", "o.node").alias("a"), F.greatest("node", "o.node").alias("b")).agg(
        F.min(F.col("step") + 1).alias("step"))


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets of different components."""
    one = roots.select(F.col("row").alias("a"), F.col("root").alias("ra"))
    two = roots.select(F.col("row").alias("b"), F.col("root").alias("rb"))
    placed = pairs.join(one, "a", "left").join(two, "b", "left")
    return placed.filter(F.coalesce("ra", "a") != F.coalesce("rb", "b")).select("a", "b")


def _open_pairs(postings: DataFrame, sizes: DataFrame, roots: DataFrame, near: DataFrame, num: int, den: int) -> DataFrame:
    """Distinct pairs (a < b) of sets of different components that share a short posting; those of ``near`` are settled."""
    short = postings.join(sizes.filter(f"m > {NEAR + 1} AND m <= {SHORT}").select("gram"), "gram")
    placed = short.join(roots.withColumnRenamed("row", "node"), "node", "left").select(
        "gram", F.struct("node", "n", F.coalesce("root", "node").alias("root")).alias("s"))
    sets = placed.groupBy("gram").agg(F.collect_list("s").alias("s")).filter(
        F.size(F.array_distinct(F.col("s.root"))) > 1)
    pairs = sets.select("s", F.explode("s").alias("a")).select("a", F.explode(F.filter(
        "s", lambda b: (b["node"] > F.col("a.node")) & (b["root"] != F.col("a.root"))
        & (b["n"] * den >= F.col("a.n") * num) & (F.col("a.n") * den >= b["n"] * num))).alias("b"))
    found = pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    return found.join(near.select("a", "b"), ["a", "b"], "left_anti")


def _possible(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs whose bins leave room for enough common n-grams: of two sets' n-grams in a bin, at most the
    smaller number is common. No link is lost, and most other pairs end here, before whole sets are dealt."""
    one = nodes.select(F.col("row").alias("a"), F.col("n_shingles").alias("na"), F.col("bins").alias("xa"))
    two = nodes.select(F.col("row").alias("b"), F.col("n_shingles").alias("nb"), F.col("bins").alias("xb"))
    most = F.aggregate(F.zip_with("xa", "xb", lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x)
    found = pairs.select("a", "b").join(one, "a").join(two, "b").withColumn("o", most.cast("long"))
    return found.filter(F.col("o") * (num + den) >= (F.col("na") + F.col("nb")) * num).select("a", "b")


def _links(pairs: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs over the threshold: overlaps per fragment, summed. Only sets of some pair are cut and dealt."""
    pairs = store(_possible(pairs, nodes, num, den), "ngram-pairs")
    if not pairs.head(1):
        return pairs
    some = store(pairs.select(F.explode(F.array("a", "b")).alias("row")).distinct(), "ngram-paired")
    held = store(nodes.join(some, "row", "left_semi"), "ngram-paired-sets")
    cut = held.select(F.col("row").alias("node"), F.col("n_shingles").alias("n"), F.posexplode(F.transform(
        F.sequence(F.lit(0), F.lit(N_FRAGMENTS - 1)),
        lambda f: F.filter("grams", lambda g: _fragment(g) == f))).alias("fragment", "part"))
    one = cut.select(F.col("node").alias("a"), F.col("n").alias("na"), "fragment", F.col("part").alias("pa"))
    two = cut.select(F.col("node").alias("b"), F.col("n").alias("nb"), "fragment", F.col("part").alias("pb"))
    partial = (pairs.join(one, "a").join(two, ["b", "fragment"])
               .select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).alias("o")))
    total = partial.groupBy("a", "b").agg(F.sum("o").alias("o"), F.first("na").alias("na"), F.first("nb").alias("nb"))
    return total.filter(F.col("o") * den >= (F.col("na") + F.col("nb") - F.col("o")) * num).select("a", "b")


def _overlaps(left: list, right: list) -> np.ndarray:
    """Common n-grams of each left and right set, summed over fragments of the order (each with
    a bounded number of distinct n-grams)."""
    x, y = np.concatenate(left), np.concatenate(right)
    order = np.intersect1d(x, y)
    i = np.repeat(np.arange(len(left)), [len(v) for v in left])
    j = np.repeat(np.arange(len(right)), [len(v) for v in right])
    out = np.zeros((len(left), len(right)), np.float32)
    step = max(256, (1 << 22) // (len(left) + len(right)))
    for at in range(0, len(order), step):
        part = order[at:at + step]
        sides = []
        for values, owner, m in ((x, i, len(left)), (y, j, len(right))):
            k = np.searchsorted(part, values)
            k[k == len(part)] = 0
            here = part[k] == values
            one = np.zeros((m, len(part)), np.float32)
            one[owner[here], k[here]] = 1
            sides.append(one)
        out += sides[0] @ sides[1].T
    return out


def _far_links(postings: DataFrame, sizes: DataFrame, nodes: DataFrame, roots: DataFrame,
               num: int, den: int) -> DataFrame:
    """Links between sets of different components in postings longer than SHORT."""
    long = postings.join(sizes.filter(F.col("m") > SHORT), "gram").drop("m")
    placed = store(long.join(roots.withColumnRenamed("row", "node"), "node", "left")
                   .withColumn("root", F.coalesce("root", "node")), "ngram-long")
    parts = placed.groupBy("gram", "root").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    per = parts.groupBy("gram").agg(F.max(F.struct("c", "root")).alias("top"), F.count("*").alias("parts"),
                                    F.sum("w").alias("w"), F.sum("c").alias("m")).filter("parts > 1")
    per = store(per.select("gram", F.col("top.root").alias("main"),
                           F.ceil(F.greatest(F.col("w") / F.lit(BLOCK_GRAMS), F.col("m") / F.lit(256))).alias("k")),
                "ngram-open")
    open_ = store(placed.join(per, "gram"), "ngram-open-places")  # its size is known before the sets are joined
    if not open_.head(1):
        return open_.select(F.col("node").alias("a"), F.col("root").alias("b"))
    open_ = _blocks(open_.join(nodes.select(F.col("row").alias("node"), "grams"), "node"), "k")
    cols = ["gram", "node", "n", "root", "grams"]
    every = F.explode(F.sequence(F.lit(0), (F.col("k") - 1).cast("int")))
    left = open_.filter("root <> main").select(*cols, F.col("block").alias("i"), every.alias("j"))
    has = left.select("gram", "i").distinct()
    right = open_.withColumnRenamed("block", "j").join(has, "gram").select(*cols, "i", "j")
    right = right.toDF(*right.columns)  # columns of its own for the cogroup

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"a": np.empty(0, np.int64), "b": np.empty(0, np.int64)})
        if a.empty or b.empty:
            return empty
        o = _overlaps(list(a["grams"]), list(b["grams"]))
        total = a["n"].to_numpy()[:, None] + b["n"].to_numpy()[None, :] - o
        linked = (o * den >= total * num) & (a["root"].to_numpy()[:, None] != b["root"].to_numpy()[None, :])
        i, j = np.nonzero(linked)
        found = pd.DataFrame({"a": a["node"].to_numpy()[i], "b": b["node"].to_numpy()[j],
                              "root": b["root"].to_numpy()[j]})
        return found.drop_duplicates(["a", "root"])[["a", "b"]] if len(found) else empty

    return (left.groupBy("gram", "i", "j").cogroup(right.groupBy("gram", "i", "j"))
            .applyInPandas(compare, "a long, b long").distinct())


def _link_counts(placed: DataFrame, nodes: DataFrame, num: int, den: int) -> DataFrame:
    """(row, links): how many rows each representative's set links with that have another set. Linked sets
    are of one component, so the sets of a component are compared in blocks, each pair of blocks once, their
    overlaps summed over the fragments of the order; a pair of blocks gives a number per set, not pairs.
    ``placed`` has (row, root, copies)."""
    per = (placed.join(nodes.select("row", F.size("grams").alias("w")), "row").groupBy("root")
           .agg(F.sum("w").alias("w"), F.count("*").alias("m")).filter("m > 1")
           .select("root", F.ceil(F.greatest(F.col("w") / F.lit(BLOCK_GRAMS), F.col("m") / F.lit(1024))).cast("int").alias("k")))
    members = store(placed.select("row", "root", "copies").join(per, "root"), "ngram-places")  # of more than one set
    sets = nodes.select("row", F.col("n_shingles").alias("n"), "grams").join(members, "row")
    dealt = store(sets.withColumn("block", F.pmod(F.xxhash64("row"), F.col("k")).cast("int")), "ngram-members")
    cols = ["root", "row", "n", "copies", "grams"]
    left = dealt.select(*cols, F.col("block").alias("i"), F.explode(F.sequence("block", F.col("k") - 1)).alias("j"))
    right = dealt.select(*cols, F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"), F.col("block").alias("j"))
    right = right.toDF(*right.columns)  # columns of its own for the cogroup

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"row": np.empty(0, np.int64), "links": np.empty(0, np.int64)})
        o = _overlaps(list(a["grams"]), list(b["grams"]))
        total = a["n"].to_numpy()[:, None] + b["n"].to_numpy()[None, :] - o
        linked = (o * den >= total * num) & (a["row"].to_numpy()[:, None] != b["row"].to_numpy()[None, :])
        rows, links = [a["row"].to_numpy()], [linked.astype(np.int64) @ b["copies"].to_numpy(np.int64)]
        if a["i"].iat[0] != a["j"].iat[0]:  # else both sides are the same sets
            rows.append(b["row"].to_numpy())
            links.append(linked.T.astype(np.int64) @ a["copies"].to_numpy(np.int64))
        return pd.DataFrame({"row": np.concatenate(rows), "links": np.concatenate(links)})

    found = left.groupBy("root", "i", "j").cogroup(right.groupBy("root", "i", "j")).applyInPandas(compare, "row long, links long")
    return found.groupBy("row").agg(F.sum("links").alias("links"))


def jaccard_classes(docs: DataFrame, n: int = 5, threshold: float = 0.8, lower: bool = True,
                    key: str = "doc_id", text: str = "text", count_links: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles (size of its set of ``n``-word shingles;
    a shorter text is one shingle), component_id (smallest doc_id reachable by links), ``kept``
    (true for one row of each component) and ``row_key`` (a hash of key and text, the
    same for repeated rows only); with ``count_links`` also ``n_links``, the number of other rows that the row
    links with. Two documents link when the Jaccard similarity of their sets is ``threshold`` (two
    decimals) or more.

    A text without words (or null) has an empty set, links with nothing and is kept. Rows with a
    null key take part; a component's id is null only if all its keys are. Repeated rows link
    with each other. An empty table gives an empty result; other columns are ignored."""
    num, den = round(threshold * 100), 100
    sets = _sets(docs, n, num, den, lower, key, text)
    groups = store(sets.filter("set_id is not null").groupBy("set_id").agg(
        F.min("row").alias("row"), F.min("doc_id").alias("low"), F.count("*").alias("copies"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("best")), "ngram-groups")
    heads = sets.filter("grams is not null").select("row", "n_shingles", F.slice("grams", F.lit(1), F.col("rare")).alias("head"))
    postings = store(heads.join(groups.select("row"), "row", "left_semi").select(
        F.col("row").alias("node"), F.col("n_shingles").alias("n"), F.explode("head").alias("gram")), "ngram-postings")
    sizes = store(postings.groupBy("gram").agg(F.count("*").alias("m")).filter("m > 1"), "ngram-sizes")
    met = store(postings.join(sizes, "gram", "left_semi").select(F.col("node").alias("row")).distinct(), "ngram-met")
    # only sets that meet another one are read again with all their n-grams
    nodes = store(sets.select("row", "n_shingles", "grams", "bins").join(met, "row", "left_semi"), "ngram-nodes")
    near = store(_near_pairs(postings, sizes, num, den), "ngram-near")
    links = store(_links(near.filter("step = 1").select("a", "b"), nodes, num, den), "ngram-links")
    roots = components(links).withColumnRenamed("node", "row")
    for rest in (lambda: _links(_apart(near.filter("step > 1"), roots), nodes, num, den),
                 lambda: _links(_open_pairs(postings, sizes, roots, near, num, den), nodes, num, den),
                 lambda: _far_links(postings, sizes, nodes, roots, num, den)):
        more = store(rest(), "ngram-more")
        if more.head(1):
            roots = extended(roots.withColumnRenamed("row", "node"), more).withColumnRenamed("node", "row")
    placed = store(groups.join(roots, "row", "left").withColumn("root", F.coalesce("root", "row")), "ngram-placed")
    whole = placed.groupBy("root").agg(F.min("low").alias("component_id"), F.min("best").alias("best"))
    links = F.lit(None).cast("long")
    if count_links:
        counted = store(_link_counts(placed, nodes, num, den), "ngram-link-counts")
        placed = placed.join(counted, "row", "left")
        links = F.col("copies") - 1 + F.coalesce("links", F.lit(0))
    classes = placed.select("set_id", "root", links.alias("n_links")).join(whole, "root").select(
        "set_id", "component_id", F.col("best.row").alias("best"), "n_links")
    out = sets.drop("grams", "bins").join(classes, "set_id", "left")
    number = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if count_links else []
    return out.select("doc_id", "n_shingles", *number,
                      F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (F.col("set_id").isNull() | (F.col("best") == F.col("row"))).alias("kept"), "row_key")
