"""Exact repeats of 200 bytes and more, by sorting suffixes in two stages.

Two equal strings of LENGTH bytes have the same minimiser (the least hash of SEED_BYTES bytes in them), at the
same place.  So every window of LENGTH bytes belongs to one minimiser, and neighbouring windows to the same: a
document is cut into runs of windows, and runs of one minimiser that occurs again are brought together.  Equal runs
are counted, not moved.  Different ones are joined to one text per task, whose suffixes are sorted in two stages: those
smaller than their successor directly, the others induced from them by scanning the buckets in order.  Adjacent
suffixes with a common prefix of LENGTH bytes are repeats; prefixes are compared by fingerprints of 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stored

LENGTH = 200
SEED_BYTES = 32
REACH = LENGTH - SEED_BYTES
# Bytes of a document hashed at once, and bytes whose suffixes are sorted in one task, about.
CHUNK = 1 << 20
TASK_BYTES = 1 << 20
# Different runs of one minimiser that may meet in one task; of more, windows are compared by digest.
MOST = 20_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)  # fixed values: splitmix64


def minimisers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first, last): every minimiser, the leftmost of equal ones, and the windows of LENGTH
    bytes that it is the minimiser of.  At the edge of a chunk a run of windows may be in two parts."""
    parts = []
    for low in range(0, max(1, len(data) - LENGTH + 1), CHUNK):
        part = data[low : low + CHUNK + LENGTH - 1]
        if len(part) < LENGTH:
            break
        h, factor = part.astype(np.uint64) + np.uint64(1), _BASE
        width = 1
        while width < SEED_BYTES:
            h = h[:-width] * factor + h[width:]
            factor = np.uint64(int(factor) ** 2 & 0xFFFFFFFFFFFFFFFF)
            width *= 2
        h = (h ^ (h >> np.uint64(30))) * _MIX
        h ^= h >> np.uint64(27)
        # The upper 40 bits decide, then the position: a minimum that knows where it is.
        key = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(h), dtype=np.uint64)
        span, need = 1, REACH + 1
        while span * 2 <= need:
            key = np.minimum(key[:-span], key[span:])
            span *= 2
        if span < need:
            key = np.minimum(key[: len(key) - (need - span)], key[need - span :])
        place = (key & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        last = np.r_[first[1:], len(place)] - 1
        parts.append((h[place[first]], place[first] + low, first + low, last + low))
    if not parts:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


_ANCHOR = "h long, region long, rid long, start long, size long, copies long"
_ROW = "rid long, doc_id long, n_bytes long, sha string"


def joined_spans(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that touch or overlap as one."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    heads = np.flatnonzero(np.r_[True, low[1:] > high[:-1]])
    return low[heads], high[np.r_[heads[1:], len(low)] - 1]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per different run of windows: the hash of its minimiser, the digest of its bytes, where it starts and how
    long it is, and how often the document has it.  Where that is more than once the spans follow, with no hash."""
    for batch in batches:
        out: list[tuple[np.ndarray, ...]] = []
        for rid, text in zip(*batch.columns, strict=True):
            raw = (text.as_py() or "").encode()
            hashes, at, first, last = minimisers(np.frombuffer(raw, np.uint8))
            end = last + LENGTH
            region = np.fromiter(
                (xxhash.xxh3_64_intdigest(raw[a:b], c) for a, b, c in zip(first.tolist(), end.tolist(), (at - first).tolist(), strict=True)),
                np.uint64,
                len(at),
            )
            _, one, which, copies = np.unique(region ^ (hashes * _BASE), return_index=True, return_inverse=True, return_counts=True)
            again = copies[which] > 1
            low, high = joined_spans(first[again], end[again])
            row, marks = rid.as_py(), np.r_[np.ones(len(one), bool), np.zeros(len(low), bool)]
            none = np.zeros(len(low), np.int64)
            out.append(
                (
                    marks, np.r_[hashes[one].view(np.int64), none], np.r_[region[one].view(np.int64), none], np.full(len(marks), row),
                    np.r_[first[one], low], np.r_[(end - first)[one], high - low], np.r_[copies, none + 1],
                )
            )
        joined = [np.concatenate(c) for c in zip(*out, strict=True)] or [np.zeros(0, bool)] + [np.zeros(0, np.int64)] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(joined[1], pa.int64(), mask=~joined[0]), *[pa.array(c, pa.int64()) for c in joined[2:]]],
            names=["h", "region", "rid", "start", "size", "copies"],
        )


_PRINTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def fingerprints(text: np.ndarray, depth: int) -> list[np.ndarray]:
    """Two hashes of the ``depth`` bytes at every position; behind the end there are zeros."""
    n, padded = len(text), np.r_[text, np.zeros(depth, np.uint8)].astype(np.uint64) + np.uint64(1)
    out = []
    for base in _PRINTS:
        powers = np.cumprod(np.full(n + depth, np.uint64(base)), dtype=np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum(padded * powers, dtype=np.uint64)]
        back = np.cumprod(np.full(n, np.uint64(pow(base, -1, 1 << 64))), dtype=np.uint64)
        out.append((sums[depth : depth + n] - sums[:n]) * back)
    return out


def _same(prints: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (prints[0][x] == prints[0][y]) & (prints[1][x] == prints[1][y])


def directly_sorted(text: np.ndarray, order: np.ndarray, depth: int, prints: list[np.ndarray]) -> np.ndarray:
    """Suffixes by their first ``depth`` bytes, eight at a time; groups that are equal throughout are done."""
    padded = np.r_[text, np.zeros(depth + 16, np.uint8)]
    words = np.ndarray(len(padded) - 7, ">u8", padded.data, strides=(1,))
    pending, group = np.arange(len(order)), np.zeros(len(order), np.int64)
    for step in range(0, depth, 8):
        key = words[order[pending] + step].astype(np.uint64)
        by = np.argsort(key) if step == 0 else np.lexsort((key, group))
        order[pending], key, group = order[pending][by], key[by], group[by]
        heads = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
        sizes = np.diff(np.r_[heads, len(key)])
        equal = _same(prints, order[pending], np.repeat(order[pending[heads]], sizes))
        open_ = np.repeat(~np.logical_and.reduceat(equal, heads), sizes)
        pending, group = pending[open_], np.repeat(np.arange(len(heads)), sizes)[open_]
        if not len(pending):
            break
    return order


def suffix_array(text: np.ndarray, depth: int = LENGTH, prints: list[np.ndarray] | None = None) -> np.ndarray:
    """The positions of ``text`` ordered by their suffixes, to ``depth`` bytes at least; 0 ends the text."""
    n = len(text)
    t = np.r_[text, np.uint8(0)].astype(np.int16)
    # Smaller than its successor: decided by the next byte that differs.
    differs = np.where(t[1:] != t[:-1], np.arange(n, dtype=np.int32), np.int32(n))
    following = np.minimum.accumulate(differs[::-1])[::-1] if n else differs
    smaller = t[:n] < t[np.minimum(following + 1, n)]
    direct = np.flatnonzero(smaller)
    if len(direct):
        direct = directly_sorted(text, direct, depth, fingerprints(text, depth) if prints is None else prints)
    first = np.bincount(t[direct], minlength=256)
    sorted_direct = np.split(direct, np.cumsum(first)[:-1])
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(found: np.ndarray) -> np.ndarray:
        """Places the larger predecessors of suffixes read in order; returns those of the bucket itself."""
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        bytes_ = t[before]
        order = np.argsort(bytes_, kind="stable")
        before, bytes_ = before[order], bytes_[order]
        cuts = np.flatnonzero(np.diff(bytes_)) + 1
        own = np.zeros(0, np.int64)
        for piece in np.split(before, cuts):
            if len(piece):
                induced[t[piece[0]]].append(piece)
                if t[piece[0]] == now:
                    own = piece
        return own

    out = []
    # The end of the text is the smallest suffix; its predecessor is larger.
    for now in range(256):
        if n and now == t[n - 1] and not smaller[n - 1]:
            # It comes before all that is induced from suffixes of its own bucket.
            induced[now].insert(0, np.array([n - 1]))
        wave = np.concatenate(induced[now]) if induced[now] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave)
        if len(sorted_direct[now]):
            out.append(sorted_direct[now])
            induce(sorted_direct[now])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeats(regions: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(region, offset, class) of all windows of LENGTH bytes; equal windows have one class, classes ascend."""
    sizes = np.array([len(r) for r in regions], np.int64)
    text = np.frombuffer(b"\0".join(regions), np.uint8)
    starts = np.cumsum(sizes + 1) - sizes - 1
    prints = fingerprints(text, LENGTH)
    order = suffix_array(text, LENGTH, prints)
    owner = np.repeat(np.arange(len(regions), dtype=np.int32), sizes + 1)
    order = order[order <= (starts + sizes - LENGTH)[owner[order]]]
    new = np.r_[True, ~_same(prints, order[:-1], order[1:])][: len(order)]
    region = owner[order]
    return region, order - starts[region], np.cumsum(new) - 1


_FOUND = "rid long, low long, high long, window binary, alone boolean"


def _sorted(table: pa.Table) -> pa.Table:
    """Repeated windows of one task as spans (rid, low, high).

    For runs of split minimisers every class of windows is named by its digest too, so that those alone in
    this task can be found in another.
    """
    regions = table["bytes"].to_pylist()
    rid, base = table["rid"].to_numpy(), table["start"].to_numpy()
    copies, split = table["copies"].to_numpy(), table["split"].to_numpy()
    region, offset, group = repeats(regions)
    n = int(group[-1]) + 1 if len(group) else 0
    where = base[region] + offset
    # A class is repeated if it holds two places, or runs that occur more than once.
    places = group
    by = np.lexsort((base, rid))
    ends = base + np.array([len(r) for r in regions], np.int64) - LENGTH
    if ((rid[by][1:] == rid[by][:-1]) & (base[by][1:] <= ends[by][:-1])).any():
        # Some place was handed over twice.
        places = np.unique(np.stack([group, rid[region], where]), axis=1)[0]
    several = np.bincount(places, minlength=n) > 1
    np.logical_or.at(several, group, copies[region] > 1)
    hit = several[group] & (copies[region] == 1)
    spans = (rid[region[hit]], where[hit])
    by = np.lexsort((spans[1], spans[0]))
    r, w = spans[0][by], spans[1][by]
    edge = np.r_[True, (np.diff(r) != 0) | (np.diff(w) > LENGTH)] if len(r) else np.zeros(0, bool)
    heads = np.flatnonzero(edge)
    tails = np.r_[heads[1:], len(r)] - 1 if len(heads) else heads
    out = {
        "rid": [r[heads]], "low": [w[heads]], "high": [w[tails] + LENGTH],
        "window": [None] * len(heads), "alone": [False] * len(heads),
    }
    # Of the runs a class was seen in, any may be of a split minimiser.
    entries = np.flatnonzero(split[region])
    for i in entries[np.unique(group[entries], return_index=True)[1]].tolist():
        a = int(offset[i])
        out["rid"].append([rid[region[i]]])
        out["low"].append([where[i]])
        out["high"].append([where[i] + LENGTH])
        out["window"].append(hashlib.sha256(regions[region[i]][a : a + LENGTH]).digest()[:16])
        out["alone"].append(not several[group[i]])
    number = lambda k: pa.array(np.concatenate([np.asarray(x, np.int64) for x in out[k]]))
    return pa.table(
        {
            "rid": number("rid"), "low": number("low"), "high": number("high"),
            "window": pa.array(out["window"], pa.binary()), "alone": pa.array(out["alone"], pa.bool_()),
        }
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs asked for, one row each."""
    names = ["rid", "start", "copies", "task", "split", "bytes"]
    types = [pa.int64()] * 4 + [pa.bool_(), pa.binary()]
    for batch in batches:
        for i in range(batch.num_rows):
            rid, raw = batch.column(0)[i].as_py(), (batch.column(1)[i].as_py() or "").encode()
            wanted = batch.column(2)[i].as_py()
            rows = [(rid, w["start"], w["copies"], w["task"], w["split"], raw[w["start"] : w["start"] + w["size"]]) for w in wanted]
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of (doc_id, text, spans)."""
    for batch in batches:
        out = []
        for doc_id, text, spans in zip(*batch.columns, strict=True):
            raw = (text.as_py() or "").encode()
            digest, removed, runs, end = hashlib.sha256(), 0, 0, 0
            start = None
            for span in sorted((s["low"], s["high"]) for s in spans.as_py() or []):
                if start is None or span[0] > end:
                    if start is not None:
                        removed += end - start
                    digest.update(raw[end if start is not None else 0 : span[0]])
                    runs += 1
                    start, end = span
                else:
                    end = max(end, span[1])
            if start is not None:
                removed += end - start
            digest.update(raw[end:])
            out.append((doc_id.as_py(), len(raw), removed, runs, digest.hexdigest()))
        columns = list(zip(*out, strict=True)) or [[]] * 5
        types = [pa.int64()] * 4 + [pa.string()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def spans(rows: DataFrame) -> DataFrame:
    """(rid, low, high) of repeated strings in (rid, text): byte spans, ends exclusive, perhaps overlapping."""
    anchors = stored(rows.select("rid", "text").mapInArrow(_anchors, _ANCHOR), "suffix-anchors")
    # Stored, so that a join with a minimiser of very many runs can be split.
    again = stored(
        anchors.where("h is not null")
        .groupBy("h")
        .agg(F.sum("copies").alias("n"), F.min("region").alias("x"), F.max("region").alias("y"))
        .where("n > 1")
        .select("h", (F.col("x") != F.col("y")).alias("diverse")),
        "suffix-again",
    )
    shared = stored(anchors.join(again.hint("merge"), "h"), "suffix-shared")
    one = F.min(F.struct("rid", "start", "size")).alias("one")
    kinds = stored(
        shared.groupBy("h", "region", "diverse").agg(F.sum("copies").alias("copies"), one), "suffix-kinds"
    )
    # Equal runs: all their windows are repeats.
    span = ["rid", F.col("start").alias("low"), (F.col("start") + F.col("size")).alias("high")]
    equal = shared.join(kinds.where("copies > 1").select("h", "region").hint("merge"), ["h", "region"]).select(*span)
    equal = equal.unionByName(anchors.where("h is null").select(*span))
    # Different runs of one minimiser: one of each kind goes to the minimiser's task.
    diverse = kinds.where("diverse")
    many = stored(diverse.groupBy("h").agg(F.count("*").alias("kinds")), "suffix-many")
    size = diverse.agg(F.coalesce(F.sum("one.size"), F.lit(0))).first()[0]
    tasks = max(1, -(-int(size) // TASK_BYTES))
    salt = F.when(F.col("kinds") > MOST, F.pmod(F.xxhash64("region"), F.ceil(F.col("kinds") / MOST))).otherwise(0)
    wanted = (
        diverse.join(many.hint("merge"), "h")
        .select(
            F.col("one.rid").alias("rid"),
            F.struct(
                F.col("one.start").alias("start"), F.col("one.size").alias("size"), "copies",
                F.pmod(F.xxhash64("h", salt), F.lit(tasks)).alias("task"), (F.col("kinds") > MOST).alias("split"),
            ).alias("w"),
        )
        .groupBy("rid")
        # Bounded by the document's own minimisers.
        .agg(F.collect_list("w").alias("wanted"))
    )
    regions = (
        rows.select("rid", "text")
        .join(wanted.hint("merge"), "rid")
        .select("rid", "text", "wanted")
        .mapInArrow(_cut, "rid long, start long, copies long, task long, split boolean, bytes binary")
    )
    found = stored(regions.groupBy("task").applyInArrow(_sorted, _FOUND), "suffix-found")
    elsewhere = (
        found.where("window is not null")
        .groupBy("window")
        .agg(F.min(F.struct("rid", "low")).alias("x"), F.max(F.struct("rid", "low")).alias("y"), F.every("alone").alias("alone"))
        .where("x != y or not alone")
        .select("window")
    )
    merged = found.where("window is not null and alone").join(elsewhere.hint("merge"), "window", "left_semi")
    return (
        equal.unionByName(found.where("window is null").select("rid", "low", "high"))
        .unionByName(merged.select("rid", "low", "high"))
    )


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256): every byte covered by a string of LENGTH bytes that
    starts anywhere else too is removed.

    Defined for: null texts (as empty), texts under LENGTH bytes (nothing removed), very long texts (whole),
    repeated rows and null ids (each row is a document), empty tables (no rows), other columns (ignored).
    """
    rows = stored(docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), "text"), "suffix-rows")
    by_row = spans(rows).groupBy("rid").agg(F.collect_set(F.struct("low", "high")).alias("spans"))
    joined = rows.join(by_row.hint("merge"), "rid", "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
