"""Benchmark decontamination by template canonicalisation.

Words are turned into a template: numbers, units and names become typed placeholders, everything else its
lower-case word.  Windows of template words of a benchmark item are looked up in every document.  Where a
window was found, the values in its slots are compared: a verbatim copy has the item's own values, a
re-parameterised question has others, and then every slot value of the item must stand for one value of the
document throughout (slot consistency); windows that conflict with the others are chance and do not count.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import fresh, stored
from slotwise.operators.sizing import broadcast_if_small

# Template words in a window, and how many of them have to be words rather than placeholders: with fewer it is longer.
WINDOW = 8
LEAST_WORDS = 5
# A document holds an item if windows found cover at least this share of it, or this many of its words.
LEAST_SHARE = 0.5
LEAST_RUN = 13
# Window hashes of the benchmark looked up in one pass over the documents (16 bytes each).
BLOCK = 2_000_000
MEMO = 500_000
# Characters of documents whose windows are made at once.
CHUNK = 200_000

TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*%?|[^\W\d_]+|[.!?\n]")
# Units of measure and money, in the languages covered.
UNITS = frozenset(
    "mm cm m km mg g kg t ml l dl s ms min h hz khz mhz ghz w kw kwh v a ma n kn pa kpa j kj kcal cal mol k c f "
    "inch inches foot feet ft yard yards mile miles ounce ounces oz pound pounds lb lbs ton tons gram grams "
    "kilogram kilograms meter meters metre metres kilometer kilometers kilometre kilometres centimeter "
    "centimeters liter liters litre litres second seconds minute minutes hour hours day days week weeks month "
    "months year years dollar dollars cent cents euro euros percent degree degrees "
    "jour jours heure heures semaine semaines mois an ans mètre mètres litre litres gramme grammes "
    "tag tage stunde stunden woche wochen monat monate jahr jahre meter liter gramm prozent "
    "día días hora horas semana semanas mes meses año años metro metros litro litros gramo gramos "
    "usd eur gbp".split()
)

_MIX = np.uint64(0xBF58476D1CE4E5B9)  # fixed value: splitmix64
_STEP = np.uint64(0x9E3779B97F4A7C15)
WORD, NAME, NUMBER, UNIT, STOP = range(5)
_NAME, _NUMBER, _UNIT = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in ("<name>", "<number>", "<unit>"))


# A token is packed into 64 bits: 60 of its hash, its kind, and whether it is a unit.
_KIND, _IS_UNIT, _HASH = np.uint64(7), np.uint64(8), np.uint64(2**64 - 16)


def _packed(token: str) -> int:
    """A capitalised word is a name unless it begins a sentence, which its neighbours decide."""
    if token in ".!?\n":
        return STOP
    low = token.lower()
    kind = WORD
    if token[0].isdigit():
        kind = NUMBER
    elif len(token) > 1 and token[0].isupper() and token[1:].islower():
        kind = NAME
    return (xxhash.xxh3_64_intdigest(low) & int(_HASH)) | kind | (int(_IS_UNIT) if low in UNITS else 0)


class Canonical:
    """Texts to template words; remembers tokens."""

    def __init__(self) -> None:
        self.memo: dict[str, int] = {}

    def words(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(hash, kind) of every word of the text, sentence ends left out."""
        hashes, kinds, _ = self.many([text])
        return hashes, kinds

    def many(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of several texts one behind the other, and where each begins and the last ends."""
        found, sizes = [], []
        for text in texts:
            before = len(found)
            found += TOKEN.findall(text or "")
            # A text ends like a sentence.
            found.append("\n")
            sizes.append(len(found) - before)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for token in set(found).difference(memo):
            memo[token] = _packed(token)
        packed = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
        kinds = packed & _KIND
        before = np.r_[np.uint64(STOP), kinds[:-1]]
        kinds = np.where((kinds == NAME) & (before == STOP), np.uint64(WORD), kinds)
        kinds = np.where((packed & _IS_UNIT > 0) & (before == NUMBER), np.uint64(UNIT), kinds)
        keep = kinds != STOP
        edges = np.r_[0, np.cumsum(keep)][np.r_[0, np.cumsum(np.array(sizes, np.int64))]]
        return packed[keep] & _HASH, kinds[keep], edges


def template(hashes: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Template word hashes: numbers, units and names as placeholders."""
    out = np.where(kinds == NUMBER, _NUMBER, np.where(kinds == UNIT, _UNIT, hashes))
    return np.where(kinds == NAME, _NAME, out)


def windows(words: np.ndarray, fixed: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, holds enough fixed words) of every window of ``size``."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    out = np.full(n, np.uint64(size))
    for i in range(size):
        out = (out ^ (out >> np.uint64(31))) * _MIX + words[i : n + i] + _STEP
    total = np.r_[0, np.cumsum(fixed)]
    return out ^ (out >> np.uint64(29)), total[size:] - total[:-size] >= min(LEAST_WORDS, size)


def _forms(hashes: np.ndarray, kinds: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(hashes, holds enough words, which words are slots) of the windows of the template, and of the words as they are: for items that are mostly placeholders, and
    for copies whose capitals, and so their names, were changed."""
    yield *windows(template(hashes, kinds), kinds == WORD, size), kinds != WORD
    # Equal words leave nothing to compare.
    yield *windows(hashes, np.ones(len(hashes), bool), size), np.zeros(len(hashes), bool)


_BACK = np.uint64(pow(int(_STEP), -1, 2**64))


def longer(
    words: np.ndarray, fixed: np.ndarray, most: int, text_of: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the windows of up to ``most`` words that are read on, from a start or back from an
    end, until LEAST_WORDS fixed words are inside, where WINDOW words hold fewer.

    ``text_of`` numbers the texts the words are of, if several: no window leaves its text."""
    n = len(words)
    text_of = np.zeros(n, np.int64) if text_of is None else text_of
    total, where = np.r_[0, np.cumsum(fixed)], np.flatnonzero(fixed)
    few = np.flatnonzero(total[WINDOW:] - total[:-WINDOW] < LEAST_WORDS) if n > WINDOW else np.zeros(0, np.int64)
    few = few if len(where) >= LEAST_WORDS else few[:0]
    # A text of WINDOW words or fewer has no such window.
    few = few[(text_of[few] == text_of[few + WINDOW - 1]) & (np.bincount(text_of)[text_of[few]] > WINDOW)] if len(few) else few
    if not len(few):
        return np.zeros(0, np.uint64), few, few
    on = few[total[few] + LEAST_WORDS <= len(where)]
    back = few[total[few + WINDOW] >= LEAST_WORDS] + WINDOW
    start = np.r_[on, where[total[back] - LEAST_WORDS]]
    end = np.r_[where[total[on] + LEAST_WORDS - 1] + 1, back]
    both = np.stack([start, end])[:, (end - start <= most) & (text_of[start] == text_of[end - 1])]
    if not both.shape[1]:
        return np.zeros(0, np.uint64), few[:0], few[:0]
    start, end = np.unique(both, axis=1)
    # Sums over powers: any window is a difference, brought to the power of its start.
    mixed = (words ^ (words >> np.uint64(31))) * _MIX
    sums = np.r_[np.uint64(0), np.cumsum(mixed * np.cumprod(np.full(n, _STEP)))]
    out = (sums[end] - sums[start]) * np.cumprod(np.full(n + 1, _BACK))[start] + (end - start).astype(np.uint64) * _STEP
    out = (out ^ (out >> np.uint64(30))) * _MIX
    return out ^ (out >> np.uint64(29)), start, end


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, size, item_id, at, words, slots) of (item_id, text).

    An item shorter than a window is one window of its own size; where placeholders are many, windows are longer.
    slots are the values (hashes) of the window's names, numbers and units.
    """
    canonical = Canonical()
    for batch in batches:
        out: list[tuple] = []
        for item, text in zip(*batch.columns, strict=True):
            hashes, kinds = canonical.words(text.as_py())
            size = min(WINDOW, len(hashes))
            if not size:
                continue
            seen = set()
            for values, enough, slot in _forms(hashes, kinds, size):
                for at in np.flatnonzero(enough).tolist():
                    if (int(values[at]), at) not in seen:
                        seen.add((int(values[at]), at))
                        inside = slice(at, at + size)
                        slots = hashes[inside][slot[inside]].view(np.int64).tolist()
                        out.append((int(values[at].view(np.int64)), size, item.as_py(), at, len(hashes), slots))
            for value, at, end in zip(*longer(template(hashes, kinds), kinds == WORD, len(hashes)), strict=True):
                slots = hashes[at:end][kinds[at:end] != WORD].view(np.int64).tolist()
                out.append((int(value.view(np.int64)), int(end - at), item.as_py(), int(at), len(hashes), slots))
        columns = list(zip(*out, strict=True)) or [[]] * 6
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
        names = ("hash", "size", "item_id", "at", "words", "slots")
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(names))


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """Ids and texts of a batch, about CHUNK characters at a time: short texts share the cost of a step."""
    rows, texts, size = [], [], 0
    for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        rows.append(row)
        texts.append(text.as_py())
        size += len(texts[-1] or "")
        if size > CHUNK:
            yield rows, texts
            rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def text_key(text: str) -> bytes:
    """What names a text, as :func:`key_of` does in Spark: an id may be missing or stand for several rows."""
    return hashlib.sha256(text.encode()).digest()


def key_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _lookup(index: np.ndarray, sizes: list[int], most: int):
    """Finds the windows of documents among the sorted hashes ``index``: (doc_id, text_key, hash, size, at, slots).

    ``sizes`` are those of windows up to WINDOW, ``most`` is that of the longest."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical = Canonical()
        # A bit table answers most lookups from the cache.
        bits = max(16, int(np.ceil(np.log2(len(index) + 1))) + 4)
        table = np.zeros(1 << bits, bool)
        shift = np.uint64(64 - bits)
        table[(index.view(np.uint64) >> shift).astype(np.int64)] = True
        def known(values: np.ndarray, fit: np.ndarray) -> np.ndarray:
            """Which of the hashes are in the index, of those that fit."""
            maybe = np.flatnonzero(table[(values >> shift).astype(np.int64)] & fit)
            signed = values[maybe].view(np.int64)
            return maybe[index[np.minimum(np.searchsorted(index, signed), len(index) - 1)] == signed]

        for batch in batches:
            out: list[tuple] = []
            for rows, texts in _chunks(batch):
                hashes, kinds, edges = canonical.many(texts)
                text_of = np.repeat(np.arange(len(texts)), np.diff(edges))
                # (text, hash, size, at, slots)
                found: list[tuple] = []
                if most > WINDOW:
                    values, start, end = longer(template(hashes, kinds), kinds == WORD, most, text_of)
                    for i in known(values, np.ones(len(values), bool)).tolist():
                        at, to = int(start[i]), int(end[i])
                        slots = hashes[at:to][kinds[at:to] != WORD].view(np.int64).tolist()
                        found.append((int(text_of[at]), int(values[i].view(np.int64)), to - at, at, slots))
                for size in sizes:
                    within = text_of[: len(hashes) - size + 1] == text_of[size - 1 :]
                    for values, enough, slot in _forms(hashes, kinds, size):
                        for at in known(values, enough & within[: len(enough)]).tolist():
                            inside = slice(at, at + size)
                            slots = hashes[inside][slot[inside]].view(np.int64).tolist()
                            found.append((int(text_of[at]), int(values[at].view(np.int64)), size, at, slots))
                named = {i: (rows[i], text_key(texts[i])) for i in {f[0] for f in found}}
                out += [(*named[i], value, size, at - int(edges[i]), slots) for i, value, size, at, slots in found]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            types = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["doc_id", "text_key", "hash", "size", "at", "slots"],
            )

    return find


def agreed(pairs: list[tuple[list[int], list[int]]]) -> dict[int, int]:
    """The value of the document that each slot value of the item stands for: the one most matched windows give
    it, of equals its own, then the least.  ``pairs`` holds (item slots, document slots) of matched windows."""
    votes = defaultdict(lambda: defaultdict(int))
    for item, doc in pairs:
        for x, y in set(zip(item, doc, strict=False)):
            votes[x][y] += 1
    return {x: min(given, key=lambda y: (-given[y], y != x, y)) for x, given in votes.items()}


def agrees(item: list[int], doc: list[int], there: dict[int, int]) -> bool:
    return all(there[x] == y for x, y in zip(item, doc, strict=False))


def consistent(pairs: list[tuple[list[int], list[int]]]) -> tuple[bool, int]:
    """Whether each slot value of the item stands for one value of the document, and how many of the values differ.

    Two values of the item may become one of the document: other numbers can happen to be equal."""
    there = agreed(pairs)
    if not all(agrees(item, doc, there) for item, doc in pairs):
        return False, 0
    return True, sum(x != y for x, y in there.items())


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, item_id, windows, covered, words, changed) of matches collected by diagonal.

    Windows whose slots conflict with the others are left out; those without slots never do."""
    for batch in batches:
        out = []
        for doc, key, item, words, matches in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            there = agreed([(m["item_slots"], m["slots"]) for m in matches])
            matches = [m for m in matches if agrees(m["item_slots"], m["slots"], there)]
            size_of = defaultdict(int)
            for m in matches:
                size_of[m["item_at"]] = max(size_of[m["item_at"]], m["size"])
            covered = np.zeros(words, bool)
            for at, size in size_of.items():
                covered[at : at + size] = True
            _, changed = consistent([(m["item_slots"], m["slots"]) for m in matches])
            if matches:
                out.append((doc, key, item, len(size_of), int(covered.sum()), words, changed))
        columns = list(zip(*out, strict=True)) or [[]] * 7
        names = ["doc_id", "text_key", "item_id", "windows", "covered", "words", "changed"]
        types = [pa.binary() if n == "text_key" else pa.int64() for n in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _held(docs: DataFrame, benchmark: DataFrame) -> DataFrame | None:
    """(doc_id, text_key, item_id, best) of each text that holds an item; None where the benchmark is empty."""
    items = stored(
        benchmark.where("item_id is not null")
        .select(F.col("item_id").cast("long"), "text")
        .mapInArrow(_item_windows, "hash long, size int, item_id long, at int, words int, slots array<long>"),
        "decontaminate-items",
    )
    # The benchmark may be of any size: it is looked up in blocks of bounded size, each a pass over the documents.
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    total = items.agg(F.count("*")).first()[0]
    blocks = max(1, -(-total // BLOCK))
    sizes = [r["size"] for r in items.select("size").distinct().orderBy("size").collect()]
    hits = None
    for block in range(blocks):
        mine = items.where(F.pmod("hash", F.lit(blocks)) == block).select("hash").distinct().toArrow()["hash"]
        index = np.sort(mine.to_numpy())
        if not len(index):
            continue
        found = stored(
            texts.mapInArrow(_lookup(index, [x for x in sizes if x <= WINDOW], sizes[-1]), "doc_id long, text_key binary, hash long, size int, at int, slots array<long>"),
            "decontaminate-hits",
        )
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return None
    wanted = items.select(
        "hash", "size", "item_id", F.col("at").alias("item_at"), "words", F.col("slots").alias("item_slots")
    )
    aligned = (
        hits.join(wanted.hint("merge"), ["hash", "size"])
        .withColumn("diagonal", F.col("at") - F.col("item_at"))
        .groupBy("doc_id", "text_key", "item_id", "diagonal")
        .agg(
            F.first("words").alias("words"),
            # An alignment holds each window of one item in at most two forms, and one from each start and to each end.
            F.collect_set(F.struct("item_at", "size", "item_slots", "slots")).alias("matches"),
        )
    )
    judged = aligned.select("doc_id", "text_key", "item_id", "words", "matches").mapInArrow(
        _judge, "doc_id long, text_key binary, item_id long, windows long, covered long, words long, changed long"
    )
    best = judged.groupBy("doc_id", "text_key", "item_id").agg(
        F.max(F.struct("covered", "windows", (-F.col("changed")).alias("same"), "words")).alias("best")
    )
    enough = (F.col("best.covered") >= LEAST_SHARE * F.col("best.words")) | (F.col("best.covered") >= LEAST_RUN)
    return best.where(enough)


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, windows, covered, words, changed_slots): the items each document holds.

    ``covered`` of the item's ``words`` lie in windows found on one alignment of item and document; the best
    alignment counts.  A pair is reported if that is at least LEAST_SHARE of the item or LEAST_RUN words.

    Defined for: null texts (as empty), empty texts and items (hold nothing), items shorter than a window (one
    window), very long texts (whole), repeated rows and rows that share an id (each text is judged by itself; of an
    id the best counts), null ids (searched like others, reported as null), items without an id (dropped: they name
    nothing), empty tables (no rows), other columns (ignored).
    """
    found = _held(docs, benchmark)
    if found is None:
        none = "doc_id long, item_id long, windows long, covered long, words long, changed_slots long"
        return docs.sparkSession.createDataFrame([], none)
    best = found.groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    return best.select(
        "doc_id",
        "item_id",
        F.col("best.windows").alias("windows"),
        F.col("best.covered").alias("covered"),
        F.col("best.words").alias("words"),
        (-F.col("best.same")).alias("changed_slots"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; columns stay as they are.

    Rows are judged by their text: those without an id or with another's go or stay like any other.
    """
    found = _held(docs, benchmark)
    if found is None:
        return docs
    name = fresh(docs, "held")
    held = stored(found.select(F.col("text_key").alias(name)).distinct(), "decontaminate-held")
    return docs.join(broadcast_if_small(held), key_of(docs["text"]) == F.col(name), "left_anti")
