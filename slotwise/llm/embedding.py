"""Embedding near-duplicates by a join of packed cells that copies no vector.

Distinct directions go to the cell of their nearest pivot and are packed, in chunks of bounded size, into the rows of
one stored table.  Tasks read two parts of that table each and compare the chunks of one with those of the other, so
a vector is shuffled and stored once, however many chunks it is compared with.

Two unit vectors with cosine c are sqrt(2 - 2c) apart.  The plane between two pivots lies between their cells, so two
chunks whose least distances to it add up to more hold no near pair, nor do vectors that lie too far from it.  Pairs
left are compared in the leading blocks of a basis by variance, in single precision with room for its rounding, and
verified on the whole vectors in double precision.

A task returns a count and a connected member per vector that has a link, never its pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import components, stored

COSINE = 0.9
# Dimensions of a block, about, and one of how many blocks is compared first.
BLOCK, LEADING = 32, 5
# Vectors per cell aimed at, and the most pivots (a bounded sample of the vectors).
CELL = 6_000
PIVOTS = 1024
# Vectors and bytes of doubles of a chunk, about, and bytes of chunks that a task reads from either side, about.
TILE, TILE_BYTES, PART_BYTES = 6_000, 1 << 22, 1 << 25
# Bytes of the pairs of chunks handed to Python at once: Spark keeps several copies of them off its heap.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 22
# Rows of a chunk compared at once, pairs verified at once, and the share of pairs left that makes one product cheaper.
SLAB, PAIRS, DENSE = 256, 100_000, 0.02
SLACK = 1e-9
# Room for the rounding of single precision, a factor of the product.
ROUGH = 1e-6
# Room for the rounding of a bound.
LOOSE = 1e-5
SEED = 5


def blocks_of(dimensions: int) -> list[slice]:
    """Blocks of nearly equal width."""
    n = max(1, round(dimensions / BLOCK))
    edges = np.linspace(0, dimensions, n + 1).round().astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def shares(dimensions: int, cosine: float) -> list[float]:
    """The squared distance each block may hold in proportion to its width; together they may hold all of it."""
    return [(2 - 2 * cosine) * (b.stop - b.start) / dimensions + SLACK for b in blocks_of(dimensions)]


@lru_cache(maxsize=4)
def rotation(dimensions: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + dimensions).normal(size=(dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def _leading(sample: np.ndarray) -> np.ndarray:
    """The directions compared first: those of most variance in the sample, out of an orthogonal basis."""
    blocks, basis = blocks_of(sample.shape[1]), rotation(sample.shape[1])
    if len(sample) > 1:
        turned = (sample - sample.mean(0)) @ basis
        basis = basis @ np.linalg.eigh(turned.T @ turned)[1][:, ::-1]
    return basis[:, : blocks[(len(blocks) - 1) // LEADING].stop]


def _directions(column: pa.Array, kind: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The rows of a column of lists that link with anything, with their vectors: scaled by a power of two, so without
    rounding, to a largest component from a half to one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    starts, values = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    lengths = np.where(column.is_valid().to_numpy(zero_copy_only=False), np.diff(starts), 0)
    for dimensions in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == dimensions)
        x = values[starts[rows][:, None] + np.arange(dimensions)].astype(kind)
        largest = np.abs(x).max(axis=1)
        fit = np.isfinite(largest) & (largest > 0)
        x = np.ldexp(x[fit], -np.frexp(largest[fit])[1][:, None])
        if len(x):
            yield rows[fit], x


def _digests(x: np.ndarray) -> list[bytes]:
    data, step = x.tobytes(), x.itemsize * x.shape[1]
    return [hashlib.sha256(data[at : at + step]).digest()[:16] for at in range(0, len(data), step)]


def units(vectors: np.ndarray) -> np.ndarray:
    """The vectors at length one."""
    x = vectors.astype(np.float64)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def matrix(data: bytes | pa.Buffer, dimensions: int, kind: str) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(-1, dimensions)


def _named(kind: str, rate: float):
    """(vec_id, node, sample): node names the direction, null for vectors that link with nothing; sample holds the vector
    for that share of the directions."""
    below = math.ceil(rate * 2**64)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, samples = [None] * batch.num_rows, [None] * batch.num_rows
            for rows, x in _directions(batch.column(1), kind):
                for row, node, vector in zip(rows.tolist(), _digests(x), x, strict=True):
                    nodes[row] = node
                    if int.from_bytes(node[:8]) < below:
                        samples[row] = vector.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nodes, pa.binary()), pa.array(samples, pa.binary())], names=["vec_id", "node", "sample"]
            )

    return name


def _pivots(pivots: dict[int, np.ndarray], dimensions: int) -> np.ndarray:
    """Any unit vector will do where there are few vectors."""
    return pivots.get(dimensions, np.eye(1, dimensions))


def _apart(pivots: np.ndarray, one: int | np.ndarray) -> np.ndarray:
    """Distances of the pivots from some of them, at least enough to divide by."""
    return np.sqrt(np.maximum(2 - 2 * pivots[one] @ pivots.T, 1e-12))


def _placed(kind: str, pivots: dict[int, np.ndarray]):
    """(dimensions, cell, node, copies, first, vector): the directions of a batch, each once."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _directions(batch.column(1), kind):
                named = pa.table({"node": pa.array(_digests(x), pa.binary()), "id": batch.column(0).take(pa.array(rows)), "at": np.arange(len(x))})
                named = named.group_by("node", use_threads=False).aggregate([("id", "count"), ("id", "min"), ("at", "min")])
                x = x[named["at_min"].to_numpy()]
                centres = _pivots(pivots, x.shape[1])
                cells = [(units(x[low : low + SLAB]) @ centres.T).argmax(1) for low in range(0, len(x), SLAB)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(x), x.shape[1], np.int32)),
                        pa.array(np.concatenate(cells).astype(np.int32)),
                        named["node"].combine_chunks(),
                        named["id_count"].combine_chunks(),
                        named["id_min"].combine_chunks(),
                        pa.array([v.tobytes() for v in x], pa.binary()),
                    ],
                    names=["dimensions", "cell", "node", "copies", "first", "vector"],
                )

    return place


PACKED = "dimensions int, cell int, number int, nodes binary, copies binary, firsts binary, vectors binary, bounds array<float>"


def _packed(kind: str, pivots: dict[int, np.ndarray]):
    """One row per chunk; bounds has the least distance of its vectors to the plane between its pivot and each other."""

    def pack(chunk: pa.Table) -> pa.Table:
        dimensions, cell, number = (chunk[c][0].as_py() for c in ("dimensions", "cell", "number"))
        vectors = b"".join(chunk["vector"].to_pylist())
        near, centres = units(matrix(vectors, dimensions, kind)), _pivots(pivots, dimensions)
        least = [(near[at : at + SLAB] @ (centres[cell] - centres).T).min(0) for at in range(0, len(near), SLAB)]
        bounds = np.min(least, axis=0) / _apart(centres, cell)
        columns = {
            "dimensions": [dimensions], "cell": [cell], "number": [number],
            "nodes": [b"".join(chunk["node"].to_pylist())],
            "copies": [chunk["copies"].to_numpy().astype(np.int64).tobytes()],
            "firsts": [chunk["first"].to_numpy().astype(np.int64).tobytes()],
            "vectors": [vectors],
            "bounds": [bounds.astype(np.float32)],
        }
        kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.list_(pa.float32())]
        return pa.table([pa.array(v, t) for v, t in zip(columns.values(), kinds, strict=True)], names=list(columns))

    return pack


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, copies, first) of the vectors of chunks."""
    for batch in batches:
        for nodes, copies, firsts in zip(*(batch.column(c).to_pylist() for c in ("nodes", "copies", "firsts")), strict=True):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([nodes[at : at + 16] for at in range(0, len(nodes), 16)], pa.binary()),
                    pa.array(np.frombuffer(copies, np.int64)),
                    pa.array(np.frombuffer(firsts, np.int64)),
                ],
                names=["node", "copies", "first"],
            )


def merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Brings ``label``, the smallest member known to be connected with each, up to date with links a - b."""
    while True:
        u, v = label[a], label[b]
        differ = u != v
        if not differ.any():
            return
        a, b, u, v = a[differ], b[differ], u[differ], v[differ]
        np.minimum.at(label, np.maximum(u, v), np.minimum(u, v))
        while ((up := label[label]) != label).any():
            label[:] = up


def _lifted(block: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Two forms of a block's vectors in single precision: the product of one's first with another's second is half of
    what their squared distance leaves of ``share``."""
    half, one = (block**2).sum(1, keepdims=True) / 2, np.ones((len(block), 1))
    return np.hstack([block, share / 2 - half, one]).astype(np.float32), np.hstack([block, one, -half]).astype(np.float32)


class Chunk:
    """The vectors of a chunk, and the forms that are compared."""

    def __init__(self, data: pa.Buffer, kind: str, basis: np.ndarray, cosine: float) -> None:
        self.units = units(matrix(data, len(basis), kind))
        self.forms = _lifted(self.units @ basis, sum(shares(len(basis), cosine)))
        self.plain = self.units.astype(np.float32)


def _where(true: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.nonzero``, which takes much longer over two dimensions than over one."""
    return np.divmod(np.flatnonzero(true), true.shape[1])


def linked(one: Chunk, two: Chunk, cosine: float, plane: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The linked pairs of two chunks, by row.  ``plane`` is the unit vector from the second's pivot to the first's."""
    left, right = np.arange(len(one.units)), np.arange(len(two.units))
    if plane is not None:
        reach = math.sqrt(max(0.0, 2 - 2 * cosine)) + LOOSE
        mine, other = one.units @ plane, -two.units @ plane
        left, right = np.flatnonzero(mine + other.min() <= reach), np.flatnonzero(mine.min() + other <= reach)
    if not len(right):
        return
    second = np.ascontiguousarray(two.forms[1][right].T)
    rough = ROUGH * (one.units.shape[1] + 2)
    for low in range(0, len(left), SLAB):
        rows = left[low : low + SLAB]
        i, j = _where(one.forms[0][rows] @ second >= -ROUGH * len(second))
        sure = np.zeros(len(i), bool)
        if len(i) > DENSE * len(rows) * len(right):
            product = one.plain[rows] @ two.plain[right].T
            i, j = _where(product >= cosine - rough)
            sure = product[i, j] >= cosine + rough
        i, j = rows[i], right[j]
        for at in range(0, len(i), PAIRS):
            a, b, known = i[at : at + PAIRS], j[at : at + PAIRS], sure[at : at + PAIRS]
            ask = np.flatnonzero(~known)
            known[ask] = np.einsum("ij,ij->i", one.units[a[ask]], two.units[b[ask]]) >= cosine
            if one is two:
                known &= a != b
            yield a[known], b[known]


LINKED = "id long, node binary, copies long, first long, links long, root long"


def _compared(kind: str, cosine: float, pivots: dict[int, np.ndarray], bases: dict[int, np.ndarray]):
    """(id, node, copies, first, links, root) of the vectors that have a link in the pairs of chunks of a task; root is
    the id of one of those connected with it."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts: dict[int, int] = {}
        weights: dict[int, np.ndarray] = {}
        held: list[list[np.ndarray]] = [[], [], [], []]
        links, label = np.zeros(0, np.int64), np.zeros(0, np.int64)
        basis = lru_cache(maxsize=4)(lambda d: bases[d] if d in bases else _leading(np.eye(1, d)))
        before: tuple[int, Chunk] | None = None
        for batch in batches:
            for row in range(batch.num_rows):
                of = lambda name: batch.column(name)[row]  # noqa: B023, E731
                dimensions, cells, numbers = of("a_dimensions").as_py(), [], []
                for side in "ab":
                    cells.append(of(f"{side}_cell").as_py())
                    numbers.append(number := of(f"{side}_number").as_py())
                    if number not in starts:
                        starts[number] = len(label)
                        nodes = np.frombuffer(of(f"{side}_nodes").as_buffer(), "V16").copy()
                        held[0].append((np.int64(number) << 32) + np.arange(len(nodes)))
                        held[1].append(nodes)
                        for k, name in ((2, "copies"), (3, "firsts")):
                            held[k].append(np.frombuffer(of(f"{side}_{name}").as_buffer(), np.int64).copy())
                        weights[number] = held[2][-1]
                        label = np.r_[label, len(label) + np.arange(len(nodes))]
                        links = np.r_[links, np.zeros(len(nodes), np.int64)]
                made = lambda side: Chunk(of(f"{side}_vectors").as_buffer(), kind, basis(dimensions), cosine)  # noqa: B023, E731
                if before is None or before[0] != numbers[0]:
                    before = numbers[0], made("a")
                one = before[1]
                two = one if numbers[0] == numbers[1] else made("b")
                plane = None
                if cells[0] != cells[1]:
                    centres = _pivots(pivots, dimensions)
                    plane = (centres[cells[0]] - centres[cells[1]]) / _apart(centres, cells[0])[cells[1]]
                spans = [slice(starts[n], starts[n] + len(c.units)) for n, c in zip(numbers, (one, two), strict=True)]
                for a, b in linked(one, two, cosine, plane):
                    links[spans[0]] += np.bincount(a, weights[numbers[1]][b], len(one.units)).astype(np.int64)
                    if one is not two:
                        links[spans[1]] += np.bincount(b, weights[numbers[0]][a], len(two.units)).astype(np.int64)
                    merged(label, spans[0].start + a, spans[1].start + b)
        hit = np.flatnonzero(links)
        if len(hit):
            ids, nodes, copies, firsts = (np.concatenate(x) for x in held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[hit]),
                    pa.array([n.tobytes() for n in nodes[hit]], pa.binary()),
                    pa.array(copies[hit]),
                    pa.array(firsts[hit]),
                    pa.array(links[hit]),
                    pa.array(ids[label[hit]]),
                ],
                names=["id", "node", "copies", "first", "links", "root"],
            )

    return compare


def near(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding).

    Vectors of different lengths do not link.  Defined for: null vectors, zero ones, empty ones and those
    with null or non-finite components (link with nothing, not even with equals), repeated rows and equal
    directions (linked copies), null ids (never linked, their component_id is null, kept), empty tables (no
    rows), other columns (ignored).
    """
    kind = "<f4" if vectors.select("embedding").dtypes[0][1] == "array<float>" else "<f8"
    listed = "array<float>" if kind == "<f4" else "array<double>"
    given = vectors.select(
        F.col("vec_id").cast("long"), F.when(F.col("vec_id").isNotNull(), F.col("embedding").cast(listed)).alias("embedding")
    )
    total = vectors.count()
    rate = min(1.0, min(4 * PIVOTS, max(1_000, 4 * total // CELL)) / max(1, total))
    rows = stored(given.mapInArrow(_named(kind, rate), "vec_id long, node binary, sample binary"), "embedding-rows")
    chunks, parts, made = _chunks(given, rows.where("sample is not null").select("node", "sample"), kind, rate)
    results = ["vec_id", "n_links", "component_id"]
    alone = rows.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = _named_components(_links(chunks, parts, kind, cosine, *made))
    everyone = chunks.select("nodes", "copies", "firsts").mapInArrow(_members, "node binary, copies long, first long")
    everyone = everyone.join(found.hint("merge"), "node", "left").select(
        "node",
        F.coalesce("n_links", F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "first").alias("component_id"),
    )
    joined = rows.where("node is not null").select("vec_id", "node").join(everyone.hint("merge"), "node")
    return joined.select(*results).unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _chunks(given: DataFrame, samples: DataFrame, kind: str, rate: float) -> tuple[DataFrame, int, tuple[dict, dict]]:
    """The stored chunks, in how many parts to read them, and the pivots and leading directions by number of dimensions."""
    spark = given.sparkSession
    drawn: dict[int, list[bytes]] = {}
    for r in samples.groupBy("node").agg(F.first("sample").alias("sample")).orderBy("node").limit(8 * PIVOTS).collect():
        drawn.setdefault(len(r["sample"]) // np.dtype(kind).itemsize, []).append(bytes(r["sample"]))
    pivots, bases = {}, {}
    for dimensions, found in drawn.items():
        if (most := min(PIVOTS, int(len(found) / rate) // CELL, TILE_BYTES // (8 * dimensions))) > 0:
            x = units(matrix(b"".join(found), dimensions, kind))
            pivots[dimensions], bases[dimensions] = x[:most], _leading(x)
    shape = "dimensions int, cell int, node binary, copies long, first long, vector binary"
    placed = given.mapInArrow(_placed(kind, pivots), shape)
    # One row per cell: at most PIVOTS of them for each number of dimensions.
    counts, numbered, total = [], 0, 0
    sizes = placed.groupBy("dimensions", "cell").agg(F.approx_count_distinct("node", 0.05).alias("n"))
    for r in sizes.orderBy("dimensions", "cell").collect():
        homes = max(1, math.ceil(r["n"] / max(1, min(TILE, TILE_BYTES // (8 * r["dimensions"])))))
        counts.append((r["dimensions"], r["cell"], numbered, homes))
        numbered += homes
        total += r["n"] * r["dimensions"] * np.dtype(kind).itemsize
    cells = spark.createDataFrame(counts, "dimensions int, cell int, base int, homes int")
    number = (F.col("base") + F.pmod(F.xxhash64("node"), F.col("homes"))).cast("int")
    keys = ["dimensions", "cell", "number"]
    # Dealt by chunk once: the directions that several batches hold meet there, and need not be dealt again to be packed.
    dealt = placed.join(F.broadcast(cells), ["dimensions", "cell"]).withColumn("number", number).drop("base", "homes").repartition(*keys)
    merged_copies = dealt.groupBy(*keys, "node").agg(
        F.sum("copies").alias("copies"), F.min("first").alias("first"), F.first("vector").alias("vector")
    )
    chunks = stored(merged_copies.groupBy(*keys).applyInArrow(_packed(kind, pivots), PACKED), "embedding-chunks")
    # Pairs of parts are tasks.
    parts = max(math.ceil(total / PART_BYTES), math.ceil(math.sqrt(4 * spark.sparkContext.defaultParallelism)))
    return chunks, parts, (pivots, bases)


def _links(chunks: DataFrame, parts: int, kind: str, cosine: float, pivots: dict, bases: dict) -> DataFrame:
    """(id, node, copies, first, links, root) by task, for vectors that have a link."""
    sides = [chunks.coalesce(parts).select(*[F.col(c).alias(f"{side}_{c}") for c in chunks.columns]) for side in "ab"]

    def bound(one: str, two: str) -> Column:
        return F.get(F.col(f"{one}_bounds"), F.col(f"{two}_cell"))

    reach = math.sqrt(max(0.0, 2 - 2 * cosine)) + LOOSE
    # No equality between the sides, by which Spark would deal out the chunks.
    met = F.col("a_dimensions").between(F.col("b_dimensions"), F.col("b_dimensions")) & (F.col("a_number") <= F.col("b_number"))
    pairs = sides[0].join(sides[1].hint("shuffle_replicate_nl"), met & (bound("a", "b") + bound("b", "a") <= reach))
    wanted = ["a_dimensions", *[f"{s}_{c}" for s in "ab" for c in ("cell", "number", "nodes", "copies", "firsts", "vectors")]]
    conf = chunks.sparkSession.conf
    before = conf.get(BATCH)
    conf.set(BATCH, str(BATCH_BYTES))
    try:
        return stored(pairs.select(*wanted).mapInArrow(_compared(kind, cosine, pivots, bases), LINKED), "embedding-links")
    finally:
        conf.set(BATCH, before)


def _named_components(links: DataFrame) -> DataFrame:
    """(node, n_links, component_id) of the vectors that have a link."""
    counts = links.groupBy("id").agg(
        F.sum("links").alias("links"), F.min("copies").alias("copies"), F.min("first").alias("first"), F.first("node").alias("node")
    )
    roots = components(links.select(F.col("id").alias("a"), F.col("root").alias("b")), "embedding-parts")
    found = counts.join(roots.select(F.col("node").alias("id"), "component").hint("merge"), "id")
    least = found.groupBy("component").agg(F.min("first").alias("component_id"))
    return found.join(least.hint("merge"), "component").select(
        "node", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
