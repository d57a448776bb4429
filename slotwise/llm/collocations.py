"""Phrase collocations by mergeable Misra-Gries summaries.

A first pass counts words exactly.  Further passes look for phrases of two words, then of more: every task counts
the phrases that can be frequent, their parts being so, in summaries by hash partition, a cell of hashes and
counts per partition.  Cells of a partition are merged into one Misra-Gries summary whose capacity exceeds the
partition's mass divided by the threshold, so the counts it takes off never reach the threshold and every
frequent phrase survives.  Survivors become a bit map of bounded size, and a last pass counts the phrases that pass
it exactly, by their words, in cells of the same partitions; hashes that meet only let a rare phrase through to that
count.  There are as many partitions as the corpus fills, so a cell and what a task merges stay of one size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slotwise.llm.common import stored

LEAST = 100
LONGEST = 5
FIRST = 2000
# A candidate goes if a longer one has this many hundredths of its count.
SHARE = 100
# Bytes of text split at once, and counters that a task gathers before it hands its cells on.
SLICE, FLUSH = 16_000_000, 4_000_000
# Counters merged at once, beside four times the capacity.
MERGE = 500_000
# Words of the corpus per hash partition.
PART = 2_000_000
# A bit map has so many bits per survivor expected, and 2 ** BITS (32 MB) at most.
BITS, PER_SURVIVOR = 28, 16
# Partitions in which the first ranks of a language are found before the last ranking.
LOTS = 64

PIECE_ENDS, BLANKS = ".,;:!?\n\x0b\f\r", " \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS.encode())] = 1
_KIND[list(PIECE_ENDS.encode())] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Odd multipliers of the phrase hash.
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def mixed(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The hash of a phrase from that of its start and its last word."""
    h = h * _M1 + w
    h ^= h >> np.uint64(32)
    h *= _M2
    h ^= h >> np.uint64(29)
    return h * _M1


def word_hashes(words: pa.Array, lang: str) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    found = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words.cast(pa.binary()).to_pylist()), np.uint64, len(words))
    return mixed(np.full(len(found), seed, np.uint64), found)


def split(texts: pa.StringArray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of all texts in order as indices of the distinct ones, those, and the piece each lies in."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    kind = _KIND[data]
    inside = kind == 0
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets - offsets[0]] = True
    fresh = fresh[:-1]
    starts = inside & fresh
    starts[1:] |= inside[1:] & ~inside[:-1]
    piece = np.cumsum((kind == 2) | fresh, dtype=np.int32)[starts]
    letters = _LOWER[data[inside]]
    edges = np.append(np.flatnonzero(starts[inside]), len(letters)).astype(np.int32)
    words = pa.StringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges), pa.py_buffer(letters)).dictionary_encode()
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary, piece


def slices(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.StringArray]]:
    """The texts of a batch by language, a bounded number of bytes at a time or one text."""
    texts = batch.column(1).cast(pa.string())
    named = batch.column(0)
    for lang in pc.unique(named).to_pylist():
        mine = texts.filter(pc.equal(named, lang)).drop_null()
        ends = np.cumsum(pc.binary_length(mine).to_numpy(zero_copy_only=False), dtype=np.int64)
        low = 0
        while low < len(mine):
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + SLICE, "right")))
            yield lang, mine.slice(low, high - low)
            low = high


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, texts in slices(batch):
            ids, words, _ = split(texts)
            if len(ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(words)), words, pa.array(np.bincount(ids, minlength=len(words)))],
                    names=["lang", "phrase", "f"],
                )


class Bits:
    """A set of hashes that holds too much rather than too little: a map of 2 ** n bits by their upper n."""

    def __init__(self, n: int, packed: bytes):
        self.n, self.packed = n, np.frombuffer(packed, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.n)
        return (self.packed[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def packed_bits(hashes: np.ndarray, n: int, part_bits: int) -> bytes:
    """The bits of a map of 2 ** n that belong to the hashes' common upper ``part_bits`` bits."""
    width = n - part_bits
    bits = np.zeros(1 << width, np.uint8)
    bits[(hashes >> np.uint64(64 - n)) & np.uint64((1 << width) - 1)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def phrases(ids: np.ndarray, hashes: np.ndarray, piece: np.ndarray, frequent: Bits, pairs: Bits | None, longest: int):
    """(n, starts, hashes) of the phrases of n words that can be frequent: of two frequent words, and with
    ``pairs`` of only such pairs of words."""
    good = frequent.has(hashes)[ids]
    at = np.flatnonzero(good[:-1] & good[1:] & (piece[:-1] == piece[1:]))
    h = mixed(hashes[ids[at]], hashes[ids[at + 1]])
    if pairs is not None:
        kept = pairs.has(h)
        at, h = at[kept], h[kept]
    yield 2, at, h
    chained = np.zeros(len(ids) + 1, bool)
    chained[at] = True
    for n in range(3, longest + 1):
        kept = chained[at + n - 2]
        at = at[kept]
        h = mixed(h[kept], hashes[ids[at + n - 1]])
        yield n, at, h


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, with the sum of their counts."""
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
    return hashes[first], np.add.reduceat(counts, first) if len(first) else counts


def planes(values: np.ndarray) -> bytes:
    """Numbers of 64 bits byte by byte, all lowest bytes first: the upper bytes of small ones compress to nothing."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def of_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _summaries(frequent, pairs, longest: int, part_bits: int):
    """(part, hashes, counts): the cells of a task's summaries.  Without ``pairs`` they count phrases of two words,
    with it longer ones."""

    def cells(hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = (hashes >> np.uint64(64 - part_bits)).astype(np.int64)
        lows = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
        highs = np.r_[lows[1:], len(part)]
        for i in range(0, len(lows), 256):
            runs = list(zip(lows[i : i + 256].tolist(), highs[i : i + 256].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(part[a]) for a, _ in runs], pa.int64()),
                    pa.array([planes(np.diff(hashes[a:b], prepend=np.uint64(0))) for a, b in runs], pa.binary()),
                    pa.array([planes(counts[a:b]) for a, b in runs], pa.binary()),
                ],
                names=["part", "hashes", "counts"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, two = frequent.value, None if pairs is None else pairs.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for lang, texts in slices(batch):
                ids, dictionary, piece = split(texts)
                found = phrases(ids, word_hashes(dictionary, lang), piece, words, two, 2 if two is None else longest)
                new = [h for n, _, h in found if (n == 2) == (two is None)]
                new = np.concatenate(new) if new else np.zeros(0, np.uint64)
                held.append(summed(new, np.ones(len(new), np.int64)))
                if sum(len(h) for h, _ in held) > FLUSH:
                    held = [summed(np.concatenate([h for h, _ in held]), np.concatenate([c for _, c in held]))]
                    if len(held[0][0]) > FLUSH // 2:
                        yield from cells(*held.pop())
        if held:
            yield from cells(*summed(np.concatenate([h for h, _ in held]), np.concatenate([c for _, c in held])))

    return run


def merge(hashes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """A Misra-Gries summary of at most ``capacity`` counters from several, and what each counter lost."""
    hashes, counts = summed(hashes, counts)
    if len(hashes) <= capacity:
        return hashes, counts, 0
    taken = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    left = counts > taken
    return hashes[left], counts[left] - taken, taken


def _merged(least: int, n: int, part_bits: int):
    """(part, bits) of one partition's survivors."""

    def run(cells: pa.Table) -> pa.Table:
        # A partition holds about PART occurrences, whatever the size of the corpus.
        held = [(np.cumsum(of_planes(h), dtype=np.uint64), of_planes(c).view(np.int64)) for h, c in zip(cells["hashes"].to_pylist(), cells["counts"].to_pylist(), strict=True)]
        capacity = sum(int(c.sum()) for _, c in held) // least + 1
        hashes, counts, lost = np.zeros(0, np.uint64), np.zeros(0, np.int64), 0
        waiting, size = [], 0
        for i, cell in enumerate(held):
            waiting.append(cell)
            size += len(cell[0])
            if size > max(MERGE, 4 * capacity) or i == len(held) - 1:
                together = [np.concatenate([kept, *[w[j] for w in waiting]]) for j, kept in enumerate((hashes, counts))]
                hashes, counts, taken = merge(*together, capacity)
                lost, waiting, size = lost + taken, [], 0
        # A phrase was counted at most ``lost`` times more than its counter says.
        kept = packed_bits(hashes[counts + lost >= least], n, part_bits)
        return pa.table({"part": cells["part"].slice(0, 1), "bits": pa.array([kept], pa.binary())})

    return run


def _count_phrases(frequent, pairs, more, longest: int, part_bits: int):
    """(part, lang, phrases, counts) of the phrases in the bit maps, by slice; equal phrases are told by their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, two, rest = frequent.value, pairs.value, more.value
        for batch in batches:
            for lang, texts in slices(batch):
                ids, dictionary, piece = split(texts)
                before = None
                for n, at, h in phrases(ids, word_hashes(dictionary, lang), piece, words, two, longest):
                    if n > 2:
                        # Both shorter phrases inside a frequent one passed as well.
                        kept = (before[at] >= 0) & (before[at + 1] >= 0) & rest.has(h)
                        at, h = at[kept], h[kept]
                    # The same start and last word make the same phrase: numbers stay small and exact.
                    start = ids[at] if n == 2 else before[at]
                    distinct, first, which, counts = np.unique(
                        start * len(dictionary) + ids[at + n - 1], return_index=True, return_inverse=True, return_counts=True
                    )
                    before = np.full(len(ids) + 1, -1, np.int64)
                    before[at] = which
                    if len(distinct):
                        part = (h[first] >> np.uint64(64 - part_bits)).astype(np.int64)
                        order = np.argsort(part, kind="stable")
                        chosen = at[first][order]
                        parts = [dictionary.take(pa.array(ids[chosen + i])) for i in range(n)]
                        lows = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0])
                        edges = pa.array(np.append(lows, len(order)), pa.int32())
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part[order][lows]),
                                pa.array([lang] * len(lows)),
                                pa.ListArray.from_arrays(edges, pc.binary_join_element_wise(*parts, " ")),
                                pa.ListArray.from_arrays(edges, pa.array(counts[order])),
                            ],
                            names=["part", "lang", "phrases", "counts"],
                        )

    return run


def _exact(least: int):
    """(lang, phrase, f) of a partition's phrases that occur ``least`` times."""

    def run(cells: pa.Table) -> pa.Table:
        sizes = pc.list_value_length(cells["phrases"]).to_numpy()
        lang = cells["lang"].take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
        flat = pa.table({"lang": lang, "phrase": pc.list_flatten(cells["phrases"]), "f": pc.list_flatten(cells["counts"])})
        whole = flat.group_by(["lang", "phrase"]).aggregate([("f", "sum")])
        whole = whole.filter(pc.greater_equal(whole["f_sum"], least))
        return pa.table({"lang": whole["lang"], "phrase": whole["phrase"], "f": whole["f_sum"]})

    return run


COUNTED = "lang string, phrase string, f long"


def _bits_for(survivors: int) -> int:
    return min(BITS, max(16, math.ceil(math.log2(max(1, survivors) * PER_SURVIVOR))))


def _gathered(spark: SparkSession, frame: DataFrame, n: int, part_bits: int):
    """A broadcast bit map from (part, bits); of its size only 2 ** n bits ever reach the driver."""
    size = 1 << max(0, n - part_bits - 3)
    whole = bytearray((1 << n) // 8)
    for r in frame.collect():
        whole[r["part"] * size : (r["part"] + 1) * size] = r["bits"]
    return spark.sparkContext.broadcast(Bits(n, bytes(whole)))


def _word_map(spark: SparkSession, words: DataFrame, count: int):
    n = _bits_for(count)
    part_bits = max(0, n - 20)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                found = word_hashes(batch.column(1).filter(pc.equal(batch.column(0), lang)), lang)
                part = (found >> np.uint64(63 - part_bits) >> np.uint64(1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(found.view(np.int64))], names=["part", "hash"])

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, part = np.zeros((1 << (n - part_bits)) // 8, np.uint8), None
        for batch in batches:
            part = batch.column(0)[0].as_py()
            bits |= np.frombuffer(packed_bits(batch.column(1).to_numpy().view(np.uint64), n, part_bits), np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([bits.tobytes()])], names=["part", "bits"])

    segment.__annotations__ = ITERATED
    rows = words.select("lang", "phrase").mapInArrow(hashed, "part long, hash long")
    return _gathered(spark, rows.groupBy("part").applyInArrow(segment, "part long, bits binary"), n, part_bits)


# Tells Spark to hand a group over batch by batch.
ITERATED = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}


def _survivors(texts: DataFrame, frequent, pairs, mass: int, least: int, longest: int, purpose: str):
    """The broadcast bit map of phrases that may reach ``least``."""
    part_bits = _part_bits(mass)
    n = max(part_bits + 3, _bits_for(mass // least + 1))
    cells = texts.mapInArrow(_summaries(frequent, pairs, longest, part_bits), "part long, hashes binary, counts binary")
    merged = cells.groupBy("part").applyInArrow(_merged(least, n, part_bits), "part long, bits binary")
    return _gathered(texts.sparkSession, stored(merged, purpose), n, part_bits)


def _part_bits(mass: int) -> int:
    return max(3, math.ceil(math.log2(max(1, mass / PART))))


def counted(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of every word and phrase of at most ``longest`` words that occurs ``least`` times in a
    language, and (lang, n) with the words each language has."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = stored(
        texts.mapInArrow(_count_words, COUNTED).groupBy("lang", "phrase").agg(F.sum("f").alias("f")), "phrase-words"
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    often = words.where(F.col("f") >= least)
    mass, count = words.agg(F.coalesce(F.sum("f"), F.lit(0)), F.count(F.when(F.col("f") >= least, 1))).first()
    frequent = _word_map(spark, often, count)
    pairs = _survivors(texts, frequent, None, mass, least, longest, "phrase-pairs")
    more = _survivors(texts, frequent, pairs, mass * max(1, longest - 2), least, longest, "phrase-cells")
    part_bits = _part_bits(mass)
    cells = texts.mapInArrow(
        _count_phrases(frequent, pairs, more, longest, part_bits), "part long, lang string, phrases array<string>, counts array<long>"
    )
    exact = cells.groupBy("part").applyInArrow(_exact(least), COUNTED)
    return often.unionByName(stored(exact, "phrase-counts")), totals


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in decimals, since products pass 64 bits."""
    wide = "decimal(38,0)"
    above = F.lit(1000).cast(wide) * a.cast(wide) * n.cast(wide)
    return F.call_function("div", above, left.cast(wide) * right.cast(wide))


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, first: int = FIRST, share: int = SHARE
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): of each language the ``first`` phrases of 2 to ``longest`` words that
    occur ``least`` times, whose parts at their weakest cut occur together most.

    Texts are lower-cased in A-Z, split into pieces at ``PIECE_ENDS`` and those into words at ``BLANKS``.  Phrases
    with a longer one of ``share`` hundredths of their count go.  Equal scores rank by count, then by bytes.

    Defined for: a null language (``und``, with those so named), null and empty texts (no words), very long
    texts and pieces (split whole, a text at a time), repeated rows (each counts), empty tables (no rows),
    other columns (ignored).
    """
    counts, totals = counted(docs, least, longest)
    words = F.split("phrase", " ")
    candidates = counts.where(F.size(words) > 1)
    cuts = candidates.select(
        "lang", "phrase", F.col("f").alias("a"), words.alias("_w"), F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("_k")
    ).select(
        "lang",
        "phrase",
        "a",
        "_k",
        F.array_join(F.slice("_w", 1, F.col("_k")), " ").alias("_left"),
        F.array_join(F.slice("_w", F.col("_k") + 1, F.size("_w")), " ").alias("_right"),
    )
    left = counts.select("lang", F.col("phrase").alias("_left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("_right"), F.col("f").alias("r"))
    joined = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"]).join(totals, "lang")
    scored = joined.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    weakest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "_k", "a", "l", "r", "n")).alias("w"))
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.size(words) - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")
            ),
        )
    )
    longer = (
        candidates.where(F.size(words) > 2)
        .select("lang", F.col("f"), F.explode(F.array_distinct(inner)).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("_longer"))
    )
    kept = (
        weakest.join(longer, ["lang", "phrase"], "left")
        .where(F.col("_longer").isNull() | (F.col("_longer") * 100 < F.col("w.a") * share))
        .select("lang", "phrase", "w.a", "w.l", "w.r", "w.n", "w.score")
    )
    # First in lots, so that the last ranking of a language sees a bounded number of rows.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    lots = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(LOTS))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(lots)).where(F.col("rank") <= first)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= first).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
