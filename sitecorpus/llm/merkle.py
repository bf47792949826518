"""Merkle manifest of a table: one tree per group of rows, one tree over the groups' roots.

Every row is a leaf, the sha256 of its columns. Leaves lie in order; runs of ``FANOUT`` consecutive nodes
are hashed into the next level until one is left. Leaves are numbered by a range sort (numbers
within a task plus the counts of the tasks before) and dealt to blocks of FANOUT ** LEVELS
consecutive leaves, so that a block is a whole subtree.

Method (butterfly exchange): in round r the blocks that agree in all digits of their number (to
the base FANOUT) but digit r form a group of at most FANOUT. They swap the roots of the subtrees of
FANOUT^r blocks that each of them knows; every member hashes the parent itself and keeps the others
as siblings. After the last round each block knows the root and the whole upper proof of its leaves, and
nothing is passed down. Where the last subtree is not full, empty blocks stand in for the missing
ones (fewer than there are blocks): they swap and hash like the rest but own no leaves.

A block's leaves and its upper proof meet once, and every leaf's proof is read off them.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from sitecorpus.llm.stored import store

FANOUT = 16
LEVELS = 3  # of a block's own subtree
EMIT = 512  # leaves whose proofs leave a worker at once
PROOF = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the concatenated parts."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """A row's leaf: the digest of its columns' fields."""
    return digest(*[field(c) for c in columns])


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (group, ...) with ``n``, the rows of its group, and ``at``, the row's place in it."""
    ranged = rows.repartitionByRange("group", *order).sortWithinPartitions("group", *order)
    schema = T.StructType(list(ranged.schema.fields)).add("_part", "long").add("_nth", "long")
    names = [f.name for f in schema.fields]
    group_at = names.index("group")

    def number(batches):
        part, group, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            nth = []
            for g in batch.column(group_at).to_pylist():
                group, seen = g, seen + 1 if g == group else 0
                nth.append(seen)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(nth), pa.int64()),
                                              pa.array(nth, pa.int64())], names=names)

    placed = store(ranged.mapInArrow(number, schema), "merkle-leaves")
    counts = placed.groupBy("_part", "group").agg(F.count(F.lit(1)).alias("c"))
    whole = Window.partitionBy("group")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_part", "group", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_before"),
                           F.sum("c").over(whole).alias("n"))
    return placed.join(counts, ["_part", "group"]).withColumn("at", F.col("_before") + F.col("_nth")).drop(
        "_part", "_nth", "_before")


def _level(nodes: Column, fanout: int) -> Column:
    """The nodes above: digests of runs of ``fanout``."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / fanout).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * fanout + 1, fanout), ""), 256))


def _blocks(leaves: DataFrame, fanout: int, levels: int) -> DataFrame:
    """group, block, n (blocks of the group) and ``node``, the root of the block's subtree."""
    size = fanout ** levels
    rows = leaves.groupBy("group", F.floor(F.col("at") / size).alias("block"), "n").agg(
        F.array_sort(F.collect_list(F.struct("at", "leaf"))).alias("rows"))
    nodes = rows.select("group", "block", "n", F.col("rows.leaf").alias("nodes"))
    for k in range(levels):
        nodes = nodes.withColumn("nodes", F.when(F.col("n") > fanout ** k, _level(F.col("nodes"), fanout)).otherwise(F.col("nodes")))
    return nodes.select("group", "block", F.ceil(F.col("n") / size).alias("n"), F.col("nodes")[0].alias("node"))


def butterfly(blocks: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """group, block, ``proof`` (each round's siblings to the left and to the right, concatenated)
    and ``node``, now the group's root, for blocks (group, block, n, node) numbered from 0 to n - 1."""
    deepest = blocks.agg(F.max("n")).first()[0] or 1
    powers = F.array(*[F.lit(fanout ** k).cast("long") for k in range(64) if fanout ** k < 1 << 60])
    below = F.array_max(F.filter(powers, lambda p: p < F.col("n")))  # null for a lone block
    full = F.ceil(F.col("n") / below) * below
    ghost = F.col("n") + F.col("block")
    state = blocks.select("group", "n", "node", "block", F.explode(F.when(
        ghost < full, F.array("block", ghost)).otherwise(F.array("block"))).alias("member"))
    state = state.select("group", "n", F.col("member").alias("block"),
                         F.when(F.col("member") == F.col("block"), F.col("node")).alias("node"),
                         F.array().cast(PROOF).alias("proof"))
    step = 1
    while step < deepest:
        at = F.floor(F.col("block") / step)
        groups = state.filter(F.col("n") > step).groupBy(
            "group", "n", F.floor(at / fanout).alias("high"), (F.col("block") % step).alias("low")).agg(
            F.array_sort(F.collect_list(F.struct("block", "node", "proof"))).alias("members"))
        known = groups.withColumn("known", F.filter("members", lambda m: m["node"].isNotNull()))
        parent = F.when(F.size("known") > 0, F.sha2(F.array_join("known.node", ""), 256))
        each = known.select("group", "n", "known", parent.alias("parent"), F.explode("members").alias("m"))

        def side(keep):
            return F.array_join(F.transform(F.filter("known", keep), lambda m: m["node"]), "")
        swapped = each.select("group", "n", F.col("m.block").alias("block"), F.col("parent").alias("node"), F.concat(
            "m.proof", F.array(F.struct(side(lambda m: m["block"] < F.col("m.block")).alias("left"),
                                        side(lambda m: m["block"] > F.col("m.block")).alias("right")))).alias("proof"))
        state = swapped.union(state.filter(F.col("n") <= step).select(swapped.columns))
        step *= fanout
    return state.filter(F.col("block") < F.col("n")).select("group", "block", "proof", "node")


def _sides(nodes: list[str], fanout: int) -> list[tuple[str, str]]:
    """What is left and right of each node in its run."""
    out = []
    for a in range(0, len(nodes), fanout):
        run = nodes[a:a + fanout]
        out += [("".join(run[:j]), "".join(run[j + 1:])) for j in range(len(run))]
    return out


def _proofs(nodes: list[str], n: int, upper: list, fanout: int, levels: int) -> list[list[tuple[str, str]]]:
    """The proof of each leaf of a block of a group of ``n`` leaves."""
    count, sides = len(nodes), []
    for k in range(levels):
        if n > fanout ** k:
            sides.append(_sides(nodes, fanout))
            nodes = [sha256("".join(nodes[a:a + fanout]).encode()).hexdigest() for a in range(0, len(nodes), fanout)]
    return [[side[i // fanout ** k] for k, side in enumerate(sides)] + upper for i in range(count)]


def _unfold(leaves: DataFrame, tops: DataFrame, carry: list[str], fanout: int, levels: int) -> DataFrame:
    """``carry``, leaf, proof, subroot and root of every leaf. ``tops`` has (group, block, proof, subroot,
    root); a top row goes ahead of its block's leaves, which arrive together and in order."""
    none = [F.lit(None).cast(leaves.schema[c].dataType).alias(c) for c in carry]
    up = tops.select("group", "block", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("long").alias("n"),
                     F.lit(None).cast("string").alias("leaf"), "proof", "subroot", "root", *none)
    rows = leaves.select("group", F.floor(F.col("at") / fanout ** levels).alias("block"), "at", "n", "leaf",
                         F.lit(None).cast(PROOF).alias("proof"), F.lit(None).cast("string").alias("subroot"),
                         F.lit(None).cast("string").alias("root"), *carry)
    both = rows.unionByName(up).repartition("group", "block").sortWithinPartitions("group", "block", "at")
    schema = T.StructType([both.schema[c] for c in carry]).add("leaf", "string").add(
        "proof", T._parse_datatype_string(PROOF)).add("subroot", "string").add("root", "string")
    kept = [both.columns.index(c) for c in carry]

    def emit(top, held):
        """The rows of one block, EMIT at a time."""
        if not sum(b.num_rows for b in held):
            return
        table = pa.Table.from_batches(held).combine_chunks()
        nodes = table.column("leaf").to_pylist()
        upper = [(s["left"], s["right"]) for s in top["proof"]]
        proofs = _proofs(nodes, table.column("n")[0].as_py(), upper, fanout, levels)
        kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
        for a in range(0, len(nodes), EMIT):
            part, some = table.slice(a, EMIT).combine_chunks(), proofs[a:a + EMIT]
            proof = pa.array([[{"left": x, "right": y} for x, y in p] for p in some], kind)
            count = len(some)
            yield pa.RecordBatch.from_arrays(
                [*[_one(part.column(i)) for i in kept], _one(part.column("leaf")), proof,
                 pa.array([top["subroot"]] * count, pa.string()), pa.array([top["root"]] * count, pa.string())],
                names=[f.name for f in schema.fields])

    def unfold(batches):
        top, held = None, []
        for batch in batches:
            heads = [i for i, at in enumerate(batch.column("at").to_pylist()) if at < 0]
            edges = [*heads, batch.num_rows]
            held.append(batch.slice(0, edges[0]))  # of the block that the batch before began
            for a, b in zip(edges, edges[1:]):
                yield from emit(top, held)
                top = {c: batch.column(c)[a].as_py() for c in ("proof", "subroot", "root")}
                held = [batch.slice(a + 1, b - a - 1)]
        yield from emit(top, held)

    return both.mapInArrow(unfold, schema)


def _one(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _tagged(group: Column) -> Column:
    """A group's key as a string that sorts null first, then bytewise."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def manifest(leaves: DataFrame, group: str = "source", order: str = "doc_id", carry: list[str] | None = None,
             fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """One row per leaf: ``order``, the ``carry`` columns, leaf, subroot (the root of the leaf's group),
    root (of all groups' subroots in order, null first and then bytewise) and ``proof``: for each level from the leaf up
    to the root the siblings in its run, those to the left and those to the right, concatenated.

    ``leaves`` has ``group``, ``order``, ``leaf`` (hex digests, not null) and ``carry``. Leaves of a group lie by
    ``order`` (null first), ties by leaf; equal leaves are told apart by the place they are read from, which
    changes no digest. A group of one leaf has it as its subroot. An empty table gives an empty result."""
    carry = list(carry or [])
    rows = leaves.select(_tagged(F.col(group)).alias("group"), F.col(order).alias("_order"), "leaf",
                         *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.monotonically_increasing_id().alias("_tie"))
    own = ["_order", *[f"_c{i}" for i in range(len(carry))]]
    placed = store(_numbered(store(rows, "merkle-rows"), ["_order", "leaf", "_tie"]).drop("_tie"), "merkle-placed")
    lifted = store(butterfly(store(_blocks(placed, fanout, levels), "merkle-blocks"), fanout), "merkle-lifted")

    # the same over the groups' roots, as leaves of one group
    roots = lifted.filter("block = 0").select(F.lit("").alias("group"), F.col("group").alias("_order"), F.col("node").alias("leaf"))
    roots = store(_numbered(roots, ["_order"]), "merkle-roots")
    top = butterfly(store(_blocks(roots, fanout, levels), "merkle-blocks"), fanout).select(
        "group", "block", "proof", F.lit("").alias("subroot"), F.col("node").alias("root"))
    above = _unfold(roots, top, ["_order"], fanout, levels).select(F.col("_order").alias("group"), F.col("proof").alias("above"), "root")
    tops = lifted.join(store(above, "merkle-above"), "group").select(
        "group", "block", F.concat("proof", "above").alias("proof"), F.col("node").alias("subroot"), "root")
    out = _unfold(placed, tops, own, fanout, levels)
    return out.select(F.col("_order").alias(order), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
                      "leaf", "subroot", "root", "proof")


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, start, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def siblings(proof: Column) -> Column:
    """The proof's digests in order, concatenated."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")
