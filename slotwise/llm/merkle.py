"""Merkle manifest of a data set by slot pivot.

Every row is a leaf, the leaves of a source in id order form a tree of fixed fanout, and the sources' roots form
the tree above them.  A level is folded by spreading the children of a node into one column per slot with
conditional aggregates: all columns concatenated are what the node's digest is taken of, and all but a child's
own column are that child's siblings.

Levels are folded several at a time.  A block is a node with all leaves ``HEIGHT`` levels below it; rows are dealt
out by block once, and every level inside it is a window over rows that lie together already.  Only one row per
block goes on to the next levels, so a hot source is spread over as many tasks as it has blocks and the shuffled
rows shrink by the block's size.  Positions come from a range partitioning by source and id, whose partitions are
counted and numbered apart, never from a window over a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotwise.llm.common import stored
from slotwise.operators.sizing import broadcast_if_small

FANOUT = 3
# Levels folded after one exchange: a block has FANOUT ** HEIGHT leaves.
HEIGHT = 6
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<before:string,after:string>>"
# Where monotonically_increasing_id() keeps the partition.
PARTITION_BITS = 33


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the texts one after another."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, ``-`` for null: no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return digest(*[field(v) for v in values])


def tree_key(source: Column) -> Column:
    """A text that orders sources by their bytes with null first, and is null for none."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit(""))


def _placed(rows: DataFrame, order: list[str], purpose: str) -> DataFrame:
    """``rows`` with ``pos``, their place among those of their ``tree`` by ``order``, and ``n``, how many it has.

    Rows equal in tree and order are told apart by where they are stored, so they never share a partition
    for lack of a boundary.
    """
    told = rows.withColumn("_tie", F.monotonically_increasing_id())
    keys = ["tree", *order, "_tie"]
    ranged = told.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie")
    at = F.monotonically_increasing_id()
    numbered = stored(
        ranged.withColumn("_part", F.shiftright(at, PARTITION_BITS)).withColumn(
            "_at", at.bitwiseAND(F.lit((1 << PARTITION_BITS) - 1))
        ),
        purpose,
    )
    # One row per partition and tree: as many as there are partitions and trees together.
    runs = numbered.groupBy("tree", "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("_rows").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(
        "tree", "_part", (before - F.col("_first")).alias("_shift"), F.sum("_rows").over(tree).alias("n")
    )
    joined = numbered.join(broadcast_if_small(stored(runs, f"{purpose}-runs")), ["tree", "_part"])
    return joined.withColumn("pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def _climbed(nodes: DataFrame, fanout: int, height: int) -> DataFrame:
    """``nodes`` (tree, pos, n, node, …) with ``block``, ``up``, the node ``height`` levels above or the tree's
    root if that is lower, and ``steps``, the siblings on the way there."""
    rows = nodes.withColumn("block", F.expr(f"pos div {fanout**height}")).repartition("tree", "block")
    # The slot at each level, lowest first; windows from the lowest level up need one sort by all of them.
    slots = {f"_d{k}": F.expr(f"cast(pos div {fanout**k} % {fanout} as int)") for k in range(height)}
    rows = rows.withColumns({**slots, "up": F.col("node")})
    steps = []
    for k in range(height):
        slot = F.col(f"_d{k}")
        family = Window.partitionBy("tree", "block", *[f"_d{j}" for j in range(height - 1, k, -1)])
        # Pivot: one column per slot.
        children = [F.max(F.when(slot == s, F.col("up"))).over(family) for s in range(fanout)]
        rows = rows.withColumns({f"_c{k}_{s}": child for s, child in enumerate(children)})
        columns = [F.coalesce(F.col(f"_c{k}_{s}"), F.lit("")) for s in range(fanout)]
        # A tree of at most fanout ** k leaves has its root at level k already.
        open_ = F.col("n") > F.lit(fanout**k)
        sides = {
            name: F.concat(*[F.when(meets(s), c).otherwise(F.lit("")) for s, c in enumerate(columns)])
            for name, meets in (("before", lambda s, d=slot: d > s), ("after", lambda s, d=slot: d < s))
        }
        steps.append(F.when(open_, F.struct(sides["before"].alias("before"), sides["after"].alias("after"))))
        rows = rows.withColumn("up", F.when(open_, digest(*columns)).otherwise(F.col("up")))
    return rows.select(*nodes.columns, "block", "up", F.array_compact(F.array(*steps)).cast(STEPS).alias("steps"))


def _trees(leaves: DataFrame, fanout: int, height: int, purpose: str) -> tuple[DataFrame, list[tuple[DataFrame, int]]]:
    """(tree, node) with the root of every tree, and from the leaves up what was folded, with how many levels."""
    folded, nodes = [], leaves
    while True:
        most, levels = nodes.agg(F.max("n")).first()[0] or 1, 0
        if most == 1:
            return nodes.select("tree", "node"), folded
        while levels < height and fanout**levels < most:
            levels += 1
        folded.append((nodes, levels))
        size = F.lit(fanout**levels)
        up = _climbed(nodes, fanout, levels).where(F.col("pos") % size == 0)
        n = F.ceil(F.col("n") / size).cast("long")
        nodes = stored(up.select("tree", F.col("block").alias("pos"), n.alias("n"), F.col("up").alias("node")), purpose)


def _paths(folded: list[tuple[DataFrame, int]], top: DataFrame, fanout: int) -> DataFrame:
    """The leaves with the ``steps`` from them to the top, ``top`` (tree, steps) holding those above each tree."""
    above = top.select("tree", F.lit(0).cast("long").alias("block"), F.col("steps").alias("above"))
    for nodes, levels in reversed(folded):
        climbed = _climbed(nodes, fanout, levels).join(above.hint("merge"), ["tree", "block"])
        rows = climbed.withColumn("steps", F.concat("steps", "above")).drop("above", "block", "up")
        above = rows.select("tree", F.col("pos").alias("block"), F.col("steps").alias("above"))
    return rows


def fold(node: Column, steps: Column) -> Column:
    """The root that a leaf and the siblings on its way give."""
    return F.aggregate(steps, node, lambda n, s: F.sha2(F.concat(s["before"], n, s["after"]).cast("binary"), 256))


def manifest(docs: DataFrame, carry: dict[str, Column] | None = None, fanout: int = FANOUT, height: int = HEIGHT) -> DataFrame:
    """(doc_id, source, leaf, subroot, root, steps) of every row: ``steps`` lists from the leaf to the root what
    stands before and after the own digest in its run, so ``fold(leaf, steps)`` is the root.

    ``carry`` names further columns, computed from the rows of ``docs``, that go along.

    Defined for: nulls in any column (written as ``-``; a null source is a tree of its own before all others, null
    ids come before the rest), empty and very long texts (hashed where they are read, never moved), equal ids
    (in the order of their digests) and repeated rows (equal leaves), a source of one row (its leaf is the subroot) and
    a single source (its subroot is the root; siblings may be none), empty tables (no rows), other columns
    (no part of the leaf).
    """
    carry = carry or {}
    rows = docs.select(
        "doc_id",
        "source",
        tree_key(F.col("source")).alias("tree"),
        leaf(*[F.col(c) for c in COLUMNS]).alias("node"),
        *[c.alias(f"_carry_{name}") for name, c in carry.items()],
    )
    leaves = _placed(stored(rows, "merkle-leaves"), ["doc_id", "node"], "merkle-placed")
    leaves = stored(leaves, "merkle-numbered")
    subroots, folded = _trees(leaves, fanout, height, "merkle-levels")
    subroots = stored(subroots, "merkle-subroots")
    # The sources' roots are the leaves of one more tree.
    sources = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("below"), "node")
    sources = stored(_placed(sources, ["below"], "merkle-sources"), "merkle-sources-numbered")
    root, top = _trees(sources, fanout, height, "merkle-top")
    root = root.first()
    none = F.array().cast(STEPS)
    if top:
        whole = docs.sparkSession.createDataFrame([("",)], "tree string").withColumn("steps", none)
        sources = _paths(top, whole, fanout)
    else:
        sources = sources.withColumn("steps", none)
    upper = stored(sources.select(F.col("below").alias("tree"), F.col("node").alias("subroot"), "steps"), "merkle-upper")
    tops = upper.select("tree", "steps")
    paths = _paths(folded, tops, fanout) if folded else leaves.join(tops.hint("merge"), "tree")
    named = paths.join(broadcast_if_small(upper.select("tree", "subroot")), "tree")
    return named.select(
        "doc_id",
        "source",
        F.col("node").alias("leaf"),
        "subroot",
        F.lit(root["node"] if root else None).cast("string").alias("root"),
        "steps",
        *[F.col(f"_carry_{name}").alias(name) for name in carry],
    )


def tampered(doc_id: Column, text: Column) -> Column:
    """The text without its line feeds where 2 divides the checksum of the id, as it is elsewhere."""
    hit = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(hit, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def proven(docs: DataFrame) -> DataFrame:
    """Every row's proof, folded from its tampered text: verified where the root is the manifest's.

    Rows without an id are not tampered with.
    """
    text = tampered(F.col("doc_id"), F.col("text"))
    forged = leaf(*[text if c == "text" else F.col(c) for c in COLUMNS])
    rows = manifest(docs, {"forged": forged})
    proof = F.array_join(F.transform("steps", lambda s: F.concat(s["before"], s["after"])), "")
    folded = rows.select(
        "doc_id", "leaf", "subroot", "root", digest(proof).alias("proof_sha256"), fold(F.col("forged"), F.col("steps")).alias("folded_root")
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
