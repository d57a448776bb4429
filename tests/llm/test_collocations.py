"""Collocations against a plain count, the guarantee of the summaries, and the cases the docstring defines."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from slotwise.llm import collocations
from slotwise.llm.collocations import merge, split

DOCS = "doc_id long, text string, lang string, rank string, phrase string, n long"


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, lang, "r", "p", 1) for i, (lang, t) in enumerate(rows)], DOCS)


def plain(rows, least, longest=5, first=2000):
    counts, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: chr(ord(m.group()) + 32), text or "")
        for piece in re.split("[.,;:!?\n\x0b\f\r]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inner = {
            p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if candidates[p[i : i + k]] <= a
        }
        ranked = []
        for p, a in candidates.items():
            if p not in inner:
                score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:first], 1):
            yield lang, rank, p.decode(), -a, left, right, n[lang], -score


def made(seed, rows=60):
    chance = random.Random(seed)
    words = ["a", "B", "über", "Äh", "x y", "z\x00", "the", "new", "york", "times"]
    marks = [" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\r\n", "!", ";"]
    text = lambda n: "".join(chance.choice(words) + chance.choice(marks) for _ in range(n))
    given = [(chance.choice(["en", "en", "de", None, "und"]), text(chance.randrange(60))) for _ in range(rows)]
    return given + given[:5] + [("en", None), ("en", ""), (None, " . "), ("fr", ".,"), ("en", text(3000))]


@pytest.mark.parametrize("seed", range(3))
def test_against_a_plain_count(spark, monkeypatch, seed):
    if seed:
        # Cells of a few entries, and a map in which many hashes meet.
        for name, value in {"FLUSH": 40, "MERGE": 10, "PART": 50, "BITS": 9 + seed}.items():
            monkeypatch.setattr(collocations, name, value)
    rows = made(seed)
    got = [tuple(r) for r in collocations.collocations(docs(spark, *rows), least=4).collect()]
    assert sorted(got) == sorted(plain(rows, 4))
    assert {r[0] for r in got} == {"en", "de", "und"}


def test_first_ranks_and_ties(spark):
    rows = [("en", f"w{i} v{i}.") for i in range(8) for _ in range(3)]
    got = [tuple(r) for r in collocations.collocations(docs(spark, *rows), least=3, first=5).collect()]
    assert sorted(got) == sorted(plain(rows, 3, first=5))
    assert [r[2] for r in sorted(got)] == [f"w{i} v{i}" for i in range(5)]


def test_no_words_and_no_rows(spark):
    assert collocations.collocations(docs(spark, ("en", None), (None, " .\n"))).count() == 0
    assert collocations.collocations(docs(spark, ("en", "x")).limit(0)).count() == 0


def test_products_beyond_64_bits(spark):
    big = spark.createDataFrame([(3_000_000_000, 9_000_000_000_000, 3_000_000_001, 3_000_000_007)], "a long, n long, l long, r long")
    a, n, left, right = (big[c] for c in ("a", "n", "l", "r"))
    score = big.select(collocations._score(a, n, left, right)).first()[0]
    assert score == 1000 * 3_000_000_000 * 9_000_000_000_000 // (3_000_000_001 * 3_000_000_007)


@pytest.mark.parametrize("seed", range(20))
def test_what_summaries_lose_stays_below_the_threshold(seed):
    rng = np.random.default_rng(seed)
    stream = (rng.zipf(1.3, 4000) % 700).astype(np.uint64)
    least = int(rng.integers(5, 60))
    capacity = len(stream) // least + 1
    cells, lost = [], 0
    hashes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for cell in np.array_split(stream, 23):
        cells.append(np.unique(cell, return_counts=True))
        if len(cells) == rng.integers(1, 6) or len(cells) == 6:
            hashes, counts, taken = merge(np.concatenate([hashes, *[c[0] for c in cells]]), np.concatenate([counts, *[c[1] for c in cells]]), capacity)
            assert len(hashes) <= capacity
            lost, cells = lost + taken, []
    hashes, counts, taken = merge(np.concatenate([hashes, *[c[0] for c in cells]]), np.concatenate([counts, *[c[1] for c in cells]]), capacity)
    lost += taken
    assert lost < least
    kept = dict(zip(hashes.tolist(), counts.tolist(), strict=True))
    for value, f in zip(*[x.tolist() for x in np.unique(stream, return_counts=True)], strict=True):
        assert kept.get(value, 0) <= f <= kept.get(value, 0) + lost


def test_words_of_sliced_arrays():
    texts = pa.array(["skip me", "One two", "", "three. four\tfive", ""]).slice(1)
    ids, words, piece = split(texts)
    assert [words[i].as_py() for i in ids] == ["one", "two", "three", "four", "five"]
    assert piece[0] == piece[1] < piece[2] < piece[3] == piece[4]


def test_slices_hold_every_text_once(monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", 10)
    texts = ["abc", "x" * 50, "", None, "de fg", "hi", "klm no"]
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "a", "a", "a", "a", "a"]), pa.array(texts)], names=["lang", "text"])
    held = [(lang, part.to_pylist()) for lang, part in collocations.slices(batch)]
    assert held == [("a", ["abc", "", "de fg", "hi"]), ("a", ["klm no"]), ("b", ["x" * 50])]
