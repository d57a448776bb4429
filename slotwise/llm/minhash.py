"""Near-duplicate documents by BagMinHash signatures over multisets of word shingles.

A document is the multiset of its five-word shingles.  Every shingle has, for each of m signature components,
a Poisson process over its weight axis; a component keeps the least point below the shingle's weight.  Two
documents agree in a component with a probability equal to their weighted Jaccard similarity.  The weight
axis is cut into the levels [0,1), [1,2), [2,4), [4,8), …, each a process of its own, so the work grows with
the logarithm of a weight; points come in ascending order and stop as soon as none can enter the signature.

Signatures are cut into bands; documents that share a band meet in a bucket.  Buckets are worked off in tiles of
bounded size, which name for each member the members of other classes that agree with it in most components.
Every pair so named is verified on the multisets of the whole texts; what is connected by then names no more pairs.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import components, stored
from slotwise.operators.sizing import broadcast_if_small

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
COMPONENTS = BANDS * ROWS
# Tokens that are turned into signatures together; a longer document is a group of its own.
GROUP_TOKENS = 60_000
# Words remembered per task.
MEMO = 500_000
# A member names one partner per tile in the first round, and FAN times as many in each later one.
FAN = 16
# Members of either side of a tile, about, rows of it compared at once, and rows of the tiles that share a task call.
TILE, SLAB, CALL = 2_000, 128, 20_000
# Chance that a pair of just the wanted similarity agrees in too few components to be named.
MISSED = 4e-6
# Bits of the map that bounds a pair's overlap from above.
MAP = 2_048

WORD = re.compile(r"\w+")
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # fixed values: splitmix64
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)  # fixed value: an odd multiplier


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs give equal outputs that look random."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Texts to hashed shingles; remembers word hashes."""

    def __init__(self, words: int = WORDS) -> None:
        self.words, self.memo = words, {}

    def word_hashes(self, text: str | None) -> np.ndarray:
        found = WORD.findall((text or "").lower())
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in set(found).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))

    def shingles(self, text: str | None) -> np.ndarray:
        """One hash per position; a text of fewer words is one shingle, a text of none has none."""
        words = self.word_hashes(text)
        if not len(words):
            return words
        size = min(self.words, len(words))
        n = len(words) - size + 1
        out = words[:n].copy()
        for i in range(1, size):
            out = out * _BASE + words[i : n + i]
        return mixed(out)

    def bag(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """The shingles of the text in ascending order, and how often each occurs."""
        return np.unique(self.shingles(text), return_counts=True)


Bag = tuple[np.ndarray, np.ndarray]


def signatures(bags: list[Bag], m: int = COMPONENTS) -> np.ndarray:
    """BagMinHash: the identity of the least point per (bag, component); every bag holds a shingle."""
    n = len(bags)
    owner = np.repeat(np.arange(n), [len(b[0]) for b in bags])
    flat = np.concatenate([b[0] for b in bags])
    weight = np.concatenate([b[1] for b in bags])
    # One stream of points per (bag, shingle, level): level 0 is [0,1), level j is [2^(j-1), 2^j).
    streams = [(owner, flat, np.zeros(len(flat)), np.ones(len(flat)), weight)]
    low = 1
    while (inside := weight > low).any():
        k = int(inside.sum())
        seed = mixed(flat[inside] ^ mixed(np.full(k, low, np.uint64)))
        streams.append((owner[inside], seed, np.full(k, low), np.full(k, low), weight[inside]))
        low *= 2
    owner, seed, base, span, weight = (np.concatenate(x) for x in zip(*streams, strict=True))
    best = np.full((n, m), np.inf)
    who = np.zeros((n, m), np.uint64)
    for at in range(0, len(owner), GROUP_TOKENS):
        part = slice(at, at + GROUP_TOKENS)
        _place_points(best, who, owner[part], seed[part], base[part], span[part], weight[part])
    return who


def _place_points(
    best: np.ndarray, who: np.ndarray, owner: np.ndarray, state: np.ndarray, base: np.ndarray, span: np.ndarray,
    weight: np.ndarray,
) -> None:
    """Draws the next point of every stream until none can be below its document's largest component."""
    n, m = best.shape
    time = np.zeros(len(owner))
    while len(owner):
        state = state + _STEP
        draw = mixed(state)
        # 53 bits for the waiting time; the rate of a level is its span in each of m components.
        u = ((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        time = time - np.log(u) / (span * m)
        place = mixed(draw + _STEP)
        slot = owner * m + (place % np.uint64(m)).astype(np.int64)
        height = base + span * ((mixed(place) >> np.uint64(11)).astype(np.float64) / 2.0**53)
        flat = best.reshape(-1)
        good = (height < weight) & (time < flat[slot])
        if good.any():
            s, t = slot[good], time[good]
            np.minimum.at(flat, s, t)
            lead = t == flat[s]
            who.reshape(-1)[s[lead]] = mixed(state[good][lead] ^ place[good][lead])
        if len(owner) > n:
            live = time < best.max(axis=1)[owner]
        else:
            docs, inverse = np.unique(owner, return_inverse=True)
            live = time < best[docs].max(axis=1)[inverse]
        owner, state, base, span, weight, time = (x[live] for x in (owner, state, base, span, weight, time))


NODE = "binary"
PLACES = "array<struct<i:int,j:int,left:boolean,right:boolean>>"


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, node, bands, signature) of (doc_id, text).

    node names the text, bands are hashes of ROWS components each, signature holds a byte of every component.
    """
    shingler = Shingler()
    held: list[tuple[int | None, bytes, Bag]] = []

    def done() -> pa.RecordBatch:
        full = [i for i, x in enumerate(held) if len(x[2][0])]
        lists: list[list[int]] = [[]] * len(held)
        short: list[bytes] = [b""] * len(held)
        if full:
            signed = signatures([held[i][2] for i in full]).reshape(len(full), BANDS, ROWS)
            keys = np.zeros((len(full), BANDS), np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for r in range(ROWS):
                keys = mixed(keys + signed[:, :, r] + _STEP)
            last = (signed.reshape(len(full), -1) & np.uint64(0xFF)).astype(np.uint8)
            for i, row, low in zip(full, keys.view(np.int64).tolist(), last, strict=True):
                lists[i], short[i] = row, low.tobytes()
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([x[0] for x in held], pa.int64()),
                "node": pa.array([x[1] for x in held], pa.binary()),
                "bands": pa.array(lists, pa.list_(pa.int64())),
                "signature": pa.array(short, pa.binary()),
            }
        )

    tokens = 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            text = text.as_py() or ""
            bag = shingler.bag(text)
            held.append((doc_id.as_py(), hashlib.sha256(text.encode()).digest()[:16], bag))
            tokens += len(bag[0]) + COMPONENTS
            if tokens >= GROUP_TOKENS:
                yield done()
                held, tokens = [], 0
    if held:
        yield done()


def node_of(text: Column) -> Column:
    """The name of a text: half of its SHA-256, null as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32))


def overlap(a: Bag, b: Bag) -> float:
    """Weighted Jaccard similarity of two multisets; two empty ones are equal."""
    at = np.searchsorted(b[0], a[0])
    at[at == len(b[0])] = 0
    same = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    shared = int(np.minimum(a[1][same], b[1][at[same]]).sum())
    joined = int(a[1].sum() + b[1].sum()) - shared
    return shared / joined if joined else 1.0


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, bag, map, size) of (node, text).

    bag holds the shingles as a sorted set, the k-th occurrence of one being its own member; map has a bit for
    each member, at the place that its hash gives.
    """
    shingler = Shingler()
    for batch in batches:
        bags, maps, sizes = [], [], []
        for text in batch.column(1):
            found, times = shingler.bag(text.as_py())
            first = np.cumsum(times) - times
            nth = (np.arange(int(times.sum())) - np.repeat(first, times)).astype(np.uint64)
            bag = np.sort(mixed(np.repeat(found, times) + nth * _STEP))
            bits = np.zeros(MAP, bool)
            bits[(bag % np.uint64(MAP)).astype(np.int64)] = True
            bags.append(bag.tobytes())
            maps.append(np.packbits(bits).tobytes())
            sizes.append(len(bag))
        columns = [batch.column(0), pa.array(bags, pa.binary()), pa.array(maps, pa.binary()), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "bag", "map", "size"])


def most_overlap(one: np.ndarray, two: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """An upper bound of the similarity of sets of sizes m and n by their maps: a bit that only one map has
    stands for a member or more that only one set has."""
    shared = np.minimum(m - np.bitwise_count(one & ~two).sum(1), n - np.bitwise_count(two & ~one).sum(1))
    return shared / (m + n - shared)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, similarity) of (a, b, bag_a, bag_b)."""
    for batch in batches:
        out = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            out.append(overlap((one, np.ones(len(one), np.int64)), (two, np.ones(len(two), np.int64))))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "similarity"]
        )


def _similar(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The exact similarity of pairs (a, b); only bags that are in a pair travel."""
    left = pairs.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")).hint("merge"), "a")
    both = left.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b")).hint("merge"), "b")
    return both.select("a", "b", "bag_a", "bag_b").mapInArrow(_verify, f"a {NODE}, b {NODE}, similarity double")


def least_agreement(similarity: float, m: int = COMPONENTS) -> int:
    """Components a pair of that similarity agrees in, but for a chance of MISSED."""
    below = 0.0
    for k in range(m + 1):
        below += math.comb(m, k) * similarity**k * (1 - similarity) ** (m - k)
        if below > MISSED:
            return k
    return m


def _true_bytes(equal: np.ndarray) -> np.ndarray:
    """How many of each row's at most 255 booleans, a multiple of eight, are true: eight are added at once."""
    eights = equal.view(np.uint64).sum(axis=1, dtype=np.uint64)
    return ((eights * np.uint64(0x0101010101010101)) >> np.uint64(56)).astype(np.int16)


def _named(similarity: float, most: int):
    """(a, b, more) of the members of some tiles; more tells that a had further partners than ``most``."""
    agreement = least_agreement(similarity)

    def name(tiles: pa.Table) -> pa.Table:
        tiles = tiles.combine_chunks()
        node = tiles["node"].combine_chunks()
        signature = np.frombuffer(b"".join(tiles["signature"].to_pylist()), np.uint8).reshape(-1, COMPONENTS)
        size = tiles["size"].to_numpy()
        maps = np.frombuffer(b"".join(tiles["map"].to_pylist()), np.uint64).reshape(-1, MAP // 64)
        component = tiles["component"].combine_chunks().dictionary_encode().indices.to_numpy()
        left, right = (tiles[c].to_numpy() for c in ("left", "right"))
        keys = [tiles[c].to_numpy() for c in ("band", "i", "j")]
        order = np.lexsort(keys)
        change = np.zeros(len(order) - 1, bool)
        for k in keys:
            change |= np.diff(k[order]) != 0
        rows, partners, more = [], [], []
        for members in np.split(order, np.flatnonzero(change) + 1):
            others = members[right[members]]
            wanted = members[left[members]]
            for low in range(0, len(wanted), SLAB):
                mine = wanted[low : low + SLAB]
                near = component[mine][:, None] != component[others][None, :]
                small, large = (f(size[mine][:, None], size[others][None, :]) for f in (np.minimum, np.maximum))
                near &= small >= similarity * large - 1e-9
                agree = np.zeros(near.shape, np.int16)
                at, to = np.nonzero(near)
                for cut in range(0, len(at), TILE * SLAB // 4):
                    x, y = at[cut : cut + TILE * SLAB // 4], to[cut : cut + TILE * SLAB // 4]
                    same = _true_bytes(signature[mine[x]] == signature[others[y]])
                    x, y, same = (v[same >= agreement] for v in (x, y, same))
                    bound = most_overlap(maps[mine[x]], maps[others[y]], size[mine[x]], size[others[y]])
                    x, y, same = (v[bound >= similarity - 1e-9] for v in (x, y, same))
                    agree[x, y] = same
                near = agree > 0
                count = near.sum(1)
                for k in np.flatnonzero(count):
                    found = np.flatnonzero(near[k])
                    if len(found) > most:
                        found = found[np.argsort(-agree[k, found], kind="stable")[:most]]
                    rows.append(np.full(len(found), mine[k]))
                    partners.append(others[found])
                    more.append(np.full(len(found), count[k] > most))
        none = [np.zeros(0, np.int64)]
        return pa.table(
            {
                "a": node.take(pa.array(np.concatenate(rows or none))),
                "b": node.take(pa.array(np.concatenate(partners or none))),
                "more": pa.array(np.concatenate(more or none).astype(bool)),
            }
        )

    return name


def _tiles(members: DataFrame, first: bool) -> DataFrame:
    """Members dealt to tiles (band, i, j): those outside the main component on the left, all on the right.

    In the first round, when every text is its own component, only the tiles (i, i) and the least member of
    the bucket meet, which ties near copies together in linear work.
    """
    chunk = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    place = lambda i, j, left, right: F.struct(
        i.cast("int").alias("i"), j.cast("int").alias("j"), left.alias("left"), right.alias("right")
    )
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0)
    to = lambda n: F.sequence(zero, F.col(n) - 1)
    sized = members.withColumn("all", F.ceil(F.col("n") / TILE).cast("int")).withColumn(
        "outers", F.ceil(F.col("m") / TILE).cast("int")
    )
    if first:
        whole = F.array(place(chunk("all"), chunk("all"), yes, yes))
        head = F.transform(F.when(F.col("all") > 1, to("all")).otherwise(F.array().cast("array<int>")), lambda i: place(i, i, no, yes))
        heads = members.where("n > %d" % TILE).groupBy("band").agg(F.min("node").alias("node"))
        ties = sized.join(heads.hint("merge"), ["band", "node"], "left_semi").withColumn("t", F.explode(head))
        dealt = sized.withColumn("t", F.explode(whole)).unionByName(ties)
    else:
        as_left = F.when(F.col("outer"), F.transform(to("all"), lambda j: place(chunk("outers"), j, yes, no)))
        as_right = F.transform(to("outers"), lambda i: place(i, chunk("all"), no, yes))
        apart = F.concat(F.coalesce(as_left, F.array().cast(PLACES)), as_right)
        alone = F.array(place(zero, zero, F.col("outer"), yes))
        dealt = sized.withColumn("t", F.explode(F.when((F.col("all") == 1) & (F.col("outers") == 1), alone).otherwise(apart)))
    return dealt.select("band", "t.*", "node", "component")


def _links(members: DataFrame, facts: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """Verified pairs (a, b, similarity) that connect all texts which links inside the buckets connect.

    Each round every member outside its bucket's largest component names the members of other components
    that agree with it best; pairs are verified and components formed anew.  When no member had more to name,
    all links between different components are known.
    """
    known, roots, most = None, None, 1
    while True:
        tiles = stored(_tiles(members if roots is None else _placed(members, roots), roots is None), "minhash-tiles")
        rows = tiles.count()
        if not rows and known is not None:
            return known.where(F.col("similarity") >= similarity)
        call = F.pmod(F.xxhash64("band", "i", "j"), F.lit(max(1, -(-rows // CALL)))).alias("call")
        pairs = stored(
            tiles.join(facts.hint("merge"), "node").withColumn("call", call).groupBy("call").applyInArrow(_named(similarity, most), f"a {NODE}, b {NODE}, more boolean"),
            "minhash-pairs",
        )
        fresh = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        if known is not None:
            fresh = fresh.join(known.select("a", "b").hint("merge"), ["a", "b"], "left_anti")
        measured = stored(_similar(fresh, bags), "minhash-measured")
        known = measured if known is None else known.unionByName(measured)
        if roots is not None and pairs.where("more").isEmpty():
            return known.where(F.col("similarity") >= similarity)
        roots = stored(components(known.where(F.col("similarity") >= similarity)), "minhash-roots")
        most *= FAN


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets that hold several components; ``outer`` marks those outside the largest one."""
    placed = members.drop("n", "m", "component").join(roots.hint("merge"), "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    sizes = placed.groupBy("band", "component").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("band").agg(
        F.max(F.struct("n", "component")).alias("top"), F.count("*").alias("parts"), F.sum("n").alias("n")
    )
    largest = largest.where("parts > 1").select(
        "band", F.col("top.component").alias("main"), "n", (F.col("n") - F.col("top.n")).alias("m")
    )
    return placed.join(largest.hint("merge"), "band").withColumn("outer", F.col("component") != F.col("main"))


def _crowded(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one, each a component and outside any other."""
    many = members.groupBy("band").agg(F.count("*").alias("n")).where("n > 1").select("band", "n")
    joined = members.join(many.hint("merge"), "band")
    return joined.withColumn("m", F.col("n")).withColumn("component", F.col("node"))


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: (doc_id, class_id, copies, kept).

    class_id is the least doc_id of the class: texts are of one class if a chain of links joins them, a link
    being equal texts or a weighted Jaccard similarity of ``similarity`` or more.  copies counts the rows of
    equal text; kept marks the rows with the least doc_id of their class, of which ``keep_one`` keeps one.

    Defined for: null texts (as empty), texts without a word (linked with equal texts only), very long texts
    (whole), repeated rows (copies), null ids (a class of null ids alone has the class_id null and is kept),
    empty tables (no rows), other columns (ignored).
    """
    rows = _classified(docs, similarity)
    return rows.select("doc_id", "class_id", "copies", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def _classified(docs: DataFrame, similarity: float) -> DataFrame:
    """(doc_id, node, class_id, copies, head): head is the node that stands for the class."""
    rows = stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
            _signed, f"doc_id long, node {NODE}, bands array<long>, signature binary"
        ),
        "minhash-rows",
    )
    # Equal texts have equal bands, so either row of a node gives the same members.
    members = rows.select(F.explode("bands").alias("band"), "node").distinct()
    members = stored(_crowded(members), "minhash-members")
    wanted = broadcast_if_small(stored(members.select("node").distinct(), "minhash-wanted"))
    texts = docs.select(node_of(F.col("text")).alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(wanted, "node", "left_semi").dropDuplicates(["node"])
    bags = stored(texts.mapInArrow(_bags, f"node {NODE}, bag binary, map binary, size long"), "minhash-bags")
    signed = rows.select("node", "signature").join(wanted, "node", "left_semi").dropDuplicates(["node"])
    facts = stored(signed.join(bags.drop("bag").hint("merge"), "node"), "minhash-facts")
    roots = components(_links(members, facts, bags, similarity))
    nodes = rows.groupBy("node").agg(F.count("*").alias("copies"), F.min("doc_id").alias("first"))
    placed = stored(
        nodes.join(roots.hint("merge"), "node", "left").withColumn("component", F.coalesce("component", "node")),
        "minhash-placed",
    )
    best = F.min(F.struct(F.col("first").isNull(), F.col("first").alias("id"), "node"))
    heads = placed.groupBy("component").agg(best.alias("best"))
    named = placed.join(heads.hint("merge"), "component").select(
        "node", "copies", F.col("best.id").alias("class_id"), F.col("best.node").alias("head")
    )
    return rows.select("doc_id", "node").join(named.hint("merge"), "node")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class of ``classes``: the least doc_id; columns stay as they are."""
    rows = _classified(docs, similarity)
    stays = (F.col("node") == F.col("head")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    fate = rows.groupBy("doc_id", "node").agg(F.max(stays).alias("stays"), F.count("*").alias("times"))
    # Most rows stay, so only the others and the repeated ones are looked up.
    changed = stored(
        fate.where("not stays or times > 1").select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"), "stays"),
        "minhash-changed",
    ).withColumnRenamed("stays", "__stays")
    given = docs.withColumn("__text", node_of(F.col("text")))
    found = given.join(
        broadcast_if_small(changed),
        F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__node")),
        "left",
    )
    alone = found.where("__stays is null").select(*docs.columns)
    repeated = found.where("__stays").dropDuplicates(["__id", "__node"]).select(*docs.columns)
    return alone.unionByName(repeated)
