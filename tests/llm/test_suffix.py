"""Repeats in long, periodic and odd texts against brute force."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest

from slotwise.llm import suffix

DOCS = "doc_id long, text string, rid long, h string, copies string"


def check(spark, *texts):
    raw = [(x or "").encode() for x in texts]
    count = collections.Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
    given = spark.createDataFrame([(i, x, 7, "h", "c") for i, x in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in suffix.remove_repeats(given).collect()}
    for i, x in enumerate(raw):
        gone, runs = np.zeros(len(x), bool), 0
        for a in range(len(x) - 199):
            if count[x[a : a + 200]] > 1:
                gone[a : a + 200] = True
        runs = int(np.count_nonzero(np.diff(np.r_[False, gone].astype(int)) == 1))
        kept = hashlib.sha256(np.frombuffer(x, np.uint8)[~gone].tobytes()).hexdigest()
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, got[i].kept_sha256) == (len(x), gone.sum(), runs, kept)


def made(seed, n, letters="abcdefghij \n"):
    return "".join(np.random.default_rng(seed).choice(list(letters), n))


def test_texts_longer_than_a_chunk(spark):
    long = made(1, suffix.CHUNK + 70_000)
    edge = suffix.CHUNK - 120
    check(spark, long, made(2, 50) + long[edge : edge + 300] + made(3, 80), long[:205], made(4, 300) + long[-260:])


def test_periodic_texts_and_nul_bytes(spark):
    check(spark, "abc " * 700, "a" * 3000, "x" + "abc " * 60, "\0" * 450, "q" + "\0" * 201, "ab" * 150 + "c", None, "", "\0\1" * 150)


def test_a_popular_line_in_many_contexts(spark, monkeypatch):
    line = made(5, 340)
    texts = [made(10 + i, 120, "ab") + line + made(300 + i, 120, "ab") for i in range(60)] + [line[:250], line[90:]]
    check(spark, *texts)
    monkeypatch.setattr(suffix, "MOST", 3)
    monkeypatch.setattr(suffix, "TASK_BYTES", 2000)
    check(spark, *texts)


def test_every_window_is_of_one_minimiser():
    monkey = np.frombuffer(made(6, 5000).encode(), np.uint8)
    hashes, at, first, last = suffix.minimisers(monkey)
    assert first[0] == 0 and last[-1] == len(monkey) - suffix.LENGTH and (first[1:] == last[:-1] + 1).all()
    assert ((first <= at) & (at + suffix.SEED_BYTES <= last + suffix.LENGTH) & (last <= at)).all()
    assert len(suffix.minimisers(monkey[:199])[0]) == 0


def test_a_document_hands_equal_runs_on_once():
    batch = pa.RecordBatch.from_arrays([pa.array([3]), pa.array(["a" * 100_000])], names=["rid", "text"])
    rows = [r for out in suffix._anchors(iter([batch])) for r in out.to_pylist()]
    assert [(r["start"], r["size"], r["copies"]) for r in rows if r["h"] is None] == [(0, 100_000, 1)]
    assert sum(r["copies"] for r in rows if r["h"] is not None) >= 1 and len(rows) < 10


@pytest.mark.parametrize("seed", range(6))
def test_directly_sorted_suffixes(seed):
    rng = np.random.default_rng(seed)
    text = rng.integers(0, 3, 600).astype(np.uint8)
    text[300:500] = text[50:250]
    order = suffix.directly_sorted(text, np.arange(600), 40, suffix.fingerprints(text, 40))
    cut = [bytes(np.r_[text, np.zeros(40, np.uint8)][i : i + 40]) for i in order]
    assert cut == sorted(cut) and sorted(order.tolist()) == list(range(600))
