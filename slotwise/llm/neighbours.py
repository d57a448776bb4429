"""Approximate nearest neighbours by a forest of random-projection trees.

Nearness is the inner product.  One more coordinate gives all vectors the same length, so the largest product
belongs to the smallest distance.  Every tree cuts the space along random directions at medians of a bounded sample,
and every vector is a member of one leaf per tree.  A query walks all trees with one priority queue: the nearest
branch of any tree comes next, until it has opened the number of leaves that found the wanted share of true
neighbours in the sample.  Members of opened leaves are compared exactly, in cells of many leaves, and only the best of a
cell go on.

Equal vectors are one node with their smallest ids: more copies than are asked for can't all be among the nearest.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotwise.llm.common import stored

NEAREST = 20
# Queries are the rows whose id this divides.
EVERY = 20
TREES = 4
# Members of a leaf aimed at; a sample gives every leaf so many of its own at least.
LEAF, LEAST_LEAF = 64, 16
# Members of a cell aimed at, and queries compared with a cell in one task.
CELL, VISITS = 16_384, 65_536
# Vectors the trees are cut by, and those that the number of opened leaves is found with.
SAMPLE, TRIAL, TRIAL_QUERIES = 131_072, 4_096, 128
# Share of the true neighbours that the opened leaves hold in the trial.
RECALL = 0.95
# Rows of a cell compared at once.
SLAB = 256
SEED = 11


def usable(values: list[float] | None) -> np.ndarray | None:
    """The vector; None for null, empty, zero, or not wholly finite ones."""
    if not values or any(v is None for v in values):
        return None
    x = np.array(values, np.float64) + 0.0
    return x if np.isfinite(x).all() and x.any() else None


def _usable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(vec_id, node, length, x): node names the vector, length is its own."""
    for batch in batches:
        kept = [(i, x) for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if (x := usable(v)) is not None]
        peaks = [float(np.abs(x).max()) for _, x in kept]
        lengths = [min(p * math.sqrt(float(((x / p) ** 2).sum())), np.finfo(float).max) for p, (_, x) in zip(peaks, kept, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in kept], pa.int64()),
                pa.array([hashlib.sha256(x.tobytes()).digest()[:16] for _, x in kept], pa.binary()),
                pa.array(lengths, pa.float64()),
                pa.array([x for _, x in kept], pa.list_(pa.float64())),
            ],
            names=["vec_id", "node", "length", "x"],
        )


def matrix(column: pa.Array | pa.ChunkedArray, dimensions: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def levelled(x: np.ndarray, longest: float) -> np.ndarray:
    """Vectors of length one that are as near to a query as the inner product is large."""
    x = x / longest
    return np.c_[x, np.sqrt(np.maximum(1 - (x**2).sum(1), 0))]


def directed(q: np.ndarray) -> np.ndarray:
    """Queries among levelled vectors: their length does not change the order."""
    q = q / np.abs(q).max(axis=1, keepdims=True)
    return np.c_[q / np.sqrt((q**2).sum(1, keepdims=True)), np.zeros(len(q))]


class Forest:
    """Trees of one number of dimensions: ``cuts[t]`` holds the medians of tree t, node 1 being its root."""

    def __init__(self, dimensions: int, depth: int, longest: float, trees: int):
        self.dimensions, self.depth, self.longest = dimensions, depth, longest
        self.cuts: list[np.ndarray] = [np.zeros(1 << depth)] * trees
        self.opened = 1

    def directions(self, tree: int) -> np.ndarray:
        """A random direction per level; as long as the dimensions suffice they are at right angles."""
        rng, d, made = np.random.default_rng([SEED, self.dimensions, tree]), self.dimensions + 1, []
        while sum(m.shape[1] for m in made) < self.depth:
            made.append(np.linalg.qr(rng.normal(size=(d, d)))[0])
        return np.hstack(made)[:, : self.depth] if made else np.zeros((d, 0))

    def cut(self, sample: np.ndarray, tree: int) -> np.ndarray:
        """Medians of the sample at every node of a tree."""
        along, node, cuts = levelled(sample, self.longest) @ self.directions(tree), np.ones(len(sample), np.int64), np.zeros(1 << self.depth)
        for level in range(self.depth):
            order = np.lexsort((along[:, level], node))
            sizes = np.bincount(node, minlength=2 << level)[1 << level :]
            lows = np.cumsum(sizes) - sizes
            middle = order[np.minimum(lows + sizes // 2, len(order) - 1)]
            cuts[1 << level : 2 << level] = along[middle, level]
            node = 2 * node + (along[:, level] >= cuts[node])
        return cuts

    def leaves(self, x: np.ndarray, tree: int) -> np.ndarray:
        along, node = levelled(x, self.longest) @ self.directions(tree), np.ones(len(x), np.int64)
        for level in range(self.depth):
            node = 2 * node + (along[:, level] >= self.cuts[tree][node])
        return node - (1 << self.depth)

    def open(self, along: list[np.ndarray], most: int) -> list[tuple[int, int]]:
        """The (tree, leaf) a query opens, nearest first; ``along`` has its places along each tree's directions."""
        queue = [(0.0, tree, 1, 0) for tree in range(len(self.cuts))]
        found, last = [], 1 << self.depth
        while queue and len(found) < most:
            far, tree, node, level = heapq.heappop(queue)
            # Down to the query's own side; the other sides wait at their distance.
            while node < last:
                margin = along[tree][level] - self.cuts[tree][node]
                own = 2 * node + (margin >= 0)
                heapq.heappush(queue, (far + margin * margin, tree, own ^ 1, level + 1))
                node, level = own, level + 1
            found.append((tree, node - last))
        return found

    def places(self, queries: np.ndarray) -> list[list[np.ndarray]]:
        turned = [directed(queries) @ self.directions(t) for t in range(len(self.cuts))]
        return [[turned[t][i] for t in range(len(self.cuts))] for i in range(len(queries))]

    def try_out(self, sample: np.ndarray, queries: int, nearest: int, recall: float) -> int:
        """How many leaves must be opened for ``recall`` of the true neighbours, by brute force on a sample."""
        homes = [self.leaves(sample, t) for t in range(len(self.cuts))]
        needed = []
        for i, place in enumerate(self.places(sample[:queries])):
            with np.errstate(all="ignore"):
                near = sample @ sample[i]
            near[i] = -np.inf
            best = np.argsort(-near, kind="stable")[: min(nearest, len(sample) - 1)]
            turn = np.zeros((len(self.cuts), 1 << self.depth), np.int64)
            for n, (tree, leaf) in enumerate(self.open(place, len(self.cuts) << self.depth)):
                turn[tree, leaf] = n
            needed += np.min([turn[t][homes[t][best]] for t in range(len(self.cuts))], axis=0).tolist()
        needed.sort()
        return needed[math.ceil(recall * len(needed)) - 1] + 1 if needed else 1


def _members(forests: dict[int, Forest], cells: dict[int, int]):
    """(dimensions, tree, cell, leaf, node, first, x): every vector in its cell of every tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(2).value_lengths().to_numpy()
            for d in np.unique(widths).tolist():
                part, forest = batch.filter(pa.array(widths == d)), forests[d]
                x, shift = matrix(part.column(2), d), forest.depth - cells[d]
                for tree in range(len(forest.cuts)):
                    leaf = forest.leaves(x, tree)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(x), d), pa.int32()),
                            pa.array(np.full(len(x), tree), pa.int32()),
                            pa.array(leaf >> shift, pa.int32()),
                            pa.array(leaf & ((1 << shift) - 1), pa.int32()),
                            *[part.column(i) for i in range(3)],
                        ],
                        names=["dimensions", "tree", "cell", "leaf", "node", "first", "x"],
                    )

    return run


def _visits(forests: dict[int, Forest], cells: dict[int, int]):
    """(dimensions, tree, cell, opened, node, x): every query in the cells with a leaf it opens, as a bit map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(1).value_lengths().to_numpy()
            for d in np.unique(widths).tolist():
                if d not in forests:
                    continue
                part, forest = batch.filter(pa.array(widths == d)), forests[d]
                shift, keys, maps, who = forest.depth - cells[d], [], [], []
                for i, place in enumerate(forest.places(matrix(part.column(1), d))):
                    opened: dict[tuple[int, int], list[int]] = {}
                    for tree, leaf in forest.open(place, forest.opened):
                        opened.setdefault((tree, leaf >> shift), []).append(leaf & ((1 << shift) - 1))
                    for key, leaves in opened.items():
                        bits = np.zeros(1 << shift, np.uint8)
                        bits[leaves] = 1
                        keys.append(key)
                        maps.append(np.packbits(bits).tobytes())
                        who.append(i)
                rows = part.take(pa.array(who, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(who), d), pa.int32()),
                        pa.array([k[0] for k in keys], pa.int32()),
                        pa.array([k[1] for k in keys], pa.int32()),
                        pa.array(maps, pa.binary()),
                        rows.column(0),
                        rows.column(1),
                    ],
                    names=["dimensions", "tree", "cell", "opened", "node", "x"],
                )

    return run


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row; unlike those of whole matrices they do not depend on what else is compared."""
    return (q * x).sum(axis=1)


def _compare(most: int):
    """(query, node, score): the ``most`` nearest members of opened leaves, of every query of a cell."""

    def run(tile: pa.Table) -> pa.Table:
        d, asking = tile["dimensions"][0].as_py(), tile["opened"].is_valid().to_numpy()
        queries, members = tile.filter(pa.array(asking)), tile.filter(pa.array(~asking))
        leaf, first = members["leaf"].to_numpy(), members["first"].to_numpy()
        q, x = matrix(queries["x"], d), matrix(members["x"], d)
        who, what, scores = [], [], []
        for low in range(0, len(q) if len(x) else 0, SLAB):
            some = q[low : low + SLAB]
            maps = np.stack([np.frombuffer(m, np.uint8) for m in queries["opened"].slice(low, SLAB).to_pylist()])
            open_ = np.unpackbits(maps, axis=1)[:, leaf] == 1
            with np.errstate(all="ignore"):
                near = some @ x.T
            near[~open_] = -np.inf
            if near.shape[1] > most:
                # What rounding could bring among the best stays for the exact comparison.
                edge = np.partition(near, near.shape[1] - most, axis=1)[:, near.shape[1] - most]
                slack = 1e-12 * np.abs(some).sum(1) * np.abs(x).max()
                open_ &= ~(near < (edge - slack)[:, None])
            i, j = np.nonzero(open_)
            with np.errstate(all="ignore"):
                exact = products(some[i], x[j])
            exact = np.where(np.isnan(exact), -np.inf, exact)
            order = np.lexsort((first[j], -exact, i))
            i, j, exact = i[order], j[order], exact[order]
            starts = np.flatnonzero(np.r_[True, i[1:] != i[:-1]][: len(i)])
            rank = np.arange(len(i)) - np.repeat(starts, np.diff(np.r_[starts, len(i)]))
            best = rank < most
            who.append(low + i[best])
            what.append(j[best])
            scores.append(exact[best])
        joined = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table(
            {
                "query": queries["node"].combine_chunks().take(pa.array(joined(who, np.int64))),
                "node": members["node"].combine_chunks().take(pa.array(joined(what, np.int64))),
                "score": pa.array(joined(scores, np.float64)),
            }
        )

    return run


def _planted(nodes: DataFrame, trees: int, nearest: int, recall: float) -> tuple[dict[int, Forest], dict[int, int]]:
    """A forest for every number of dimensions, and the levels above its cells."""
    counts = nodes.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"), F.max("length").alias("longest")).collect()
    forests, cells, rows = {}, {}, {}
    for d, n, longest in counts:
        depth = max(0, min(math.ceil(math.log2(n / LEAF)), int(math.log2(min(n, SAMPLE) / LEAST_LEAF)))) if n > LEAF else 0
        forests[d], rows[d] = Forest(d, depth, longest, trees), n
        cells[d] = min(depth, max(0, math.ceil(math.log2(n / CELL))))

    def drawn(most: int) -> DataFrame:
        """About ``most`` nodes of each number of dimensions, by hash."""
        share = F.create_map(*[F.lit(v) for d, n in rows.items() for v in (d, float(most) / n)])[F.size("x")]
        return nodes.where(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < share * float(1 << 30))

    def fit(group: pa.Table) -> pa.Table:
        d, tree = group["d"][0].as_py(), group["tree"][0].as_py()
        cuts = forests[d].cut(matrix(group["x"], d), tree)
        return pa.table({"d": pa.array([d], pa.int32()), "tree": pa.array([tree], pa.int32()), "cuts": pa.array([cuts.tolist()], pa.list_(pa.float64()))})

    if forests:
        # Every tree is cut in a task of its own, by a sample of bounded size.
        per_tree = drawn(SAMPLE).select(F.size("x").alias("d"), "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
        for r in per_tree.groupBy("d", "tree").applyInArrow(fit, "d int, tree int, cuts array<double>").collect():
            forests[r["d"]].cuts = [np.array(r["cuts"]) if t == r["tree"] else c for t, c in enumerate(forests[r["d"]].cuts)]
        trial: dict[int, list] = {}
        for r in drawn(TRIAL).select(F.size("x").alias("d"), "x", "node").orderBy("node").collect():
            trial.setdefault(r["d"], []).append(r["x"])
        for d, sample in trial.items():
            forests[d].opened = forests[d].try_out(np.array(sample), TRIAL_QUERIES, nearest, recall)
    return forests, cells


def nearest(
    vectors: DataFrame, k: int = NEAREST, every: int = EVERY, trees: int = TREES, recall: float = RECALL
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of ``vectors`` (vec_id, embedding) whose id ``every`` divides
    the ``k`` other rows found with the largest inner products, ties to the smaller id.

    Vectors of different lengths are not compared.  Defined for: vectors that are null, empty, zero or hold null or
    non-finite components and rows without an id (no part), products beyond doubles (infinite, or last where they
    are no number), repeated rows (one), an id with several vectors (each is a row and a query of its own), equal vectors (copies of one node), a query without others (no row), empty tables (no rows), other
    columns (ignored).
    """
    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    rows = stored(
        given.where(F.col("vec_id").isNotNull()).mapInArrow(_usable, "vec_id long, node binary, length double, x array<double>"),
        "neighbours-rows",
    )
    nodes = stored(
        rows.groupBy("node").agg(F.min("vec_id").alias("first"), F.first("length").alias("length"), F.first("x").alias("x")),
        "neighbours-nodes",
    )
    forests, cells = _planted(nodes, trees, k, recall)
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    kind = "dimensions int, tree int, cell int, leaf int, node binary, first long, x array<double>"
    members = nodes.select("node", "first", "x").mapInArrow(_members(forests, cells), kind)
    kind = "dimensions int, tree int, cell int, opened binary, node binary, x array<double>"
    visits = stored(
        asked.groupBy("node").agg(F.first("x").alias("x")).mapInArrow(_visits(forests, cells), kind), "neighbours-visits"
    )
    # Cells are few; a cell with many members or many queries is dealt out over tiles.
    cell = ["dimensions", "tree", "cell"]
    sizes = (
        members.select(*cell, F.lit(1).alias("m"), F.lit(0).alias("v"))
        .unionByName(visits.select(*cell, F.lit(0).alias("m"), F.lit(1).alias("v")))
        .groupBy(*cell)
        .agg(F.ceil(F.sum("m") / (2 * CELL)).cast("int").alias("m"), F.ceil(F.sum("v") / VISITS).cast("int").alias("v"))
        .where("m > 0 AND v > 0")
    )
    sizes = F.broadcast(stored(sizes, "neighbours-cells"))
    mine = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    tiles = (
        members.join(sizes, cell).withColumn("i", mine("m")).withColumn("j", all_of("v")).withColumn("opened", F.lit(None).cast("binary"))
    ).unionByName(
        visits.join(sizes, cell).withColumn("j", mine("v")).withColumn("i", all_of("m")), allowMissingColumns=True
    )
    found = tiles.drop("m", "v").groupBy(*cell, "i", "j").applyInArrow(_compare(k + 1), "query binary, node binary, score double")
    # Every tree may find the same node; its score is the same.
    once = found.groupBy("query", "node").agg(F.max("score").alias("score")).join(nodes.select("node", "first").hint("merge"), "node")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    best = once.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r", "first")
    copies = rows.select("node", "vec_id").distinct()
    smallest = Window.partitionBy("node").orderBy("vec_id")
    copies = copies.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1).drop("r")
    # At most (k + 1) ** 2 candidates a query; they are one row, for all copies of the query.
    near = F.struct((-F.col("score")).alias("far"), "vec_id", "node")
    named = best.join(copies.hint("merge"), "node").groupBy("query").agg(F.sort_array(F.collect_list(near)).alias("near"))
    answers = asked.select(F.col("vec_id").alias("query_id"), F.col("node").alias("query")).distinct()
    answers = answers.join(named.hint("merge"), "query")
    others = F.filter("near", lambda c: (c["vec_id"] != F.col("query_id")) | (c["node"] != F.col("query")))
    return answers.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "c")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.col("c.vec_id").alias("vec_id"), (-F.col("c.far")).alias("score")
    )
