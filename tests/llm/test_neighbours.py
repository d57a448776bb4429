"""Nearest neighbours against brute force, and the cases the docstring defines."""

import math

import numpy as np
import pytest

from slotwise.llm import neighbours
from slotwise.llm.neighbours import Forest

SHAPE = "vec_id long, embedding array<double>, node string, score string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "n", "s", "r") for i, v in rows], SHAPE)


def answers(found):
    named = {}
    for r in found.collect():
        named.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(a) for q, a in named.items()}


def fits(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v)


def plain(rows, k, every):
    """By brute force, for rows whose ids differ."""
    kept = {i: np.array(v) for i, v in rows if i is not None and fits(v)}
    named = {}
    for i, q in kept.items():
        if i % every == 0:
            near = sorted((-float((q * x).sum()), j) for j, x in kept.items() if j != i and len(x) == len(q))
            if near:
                named[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(near[:k])]
    return named


def made(seed, n=90, d=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * rng.lognormal(size=(n, 1))
    x[n // 2 : n // 2 + 12] = x[3]
    x[-5:] = np.round(x[-5:])
    return [(int(i), row.tolist()) for i, row in enumerate(x)]


ODD = [
    (None, [1.0] * 6), (900, None), (901, []), (902, [0.0] * 6), (903, [1.0, None] * 3), (904, [math.nan] * 6),
    (905, [math.inf] + [0.0] * 5), (906, [1.0, 2.0]), (907, [2.0, 1.0]), (908, [3.0]), (-4, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0]),
]


@pytest.mark.parametrize("small", [False, True])
def test_against_brute_force(spark, monkeypatch, small):
    if small:
        # Deep trees, cells of a few members, tiles; the trial holds all vectors, so all neighbours are found.
        for name, value in {"LEAF": 4, "LEAST_LEAF": 2, "CELL": 8, "VISITS": 3, "SLAB": 2, "TRIAL_QUERIES": 1000}.items():
            monkeypatch.setattr(neighbours, name, value)
    rows = made(1) + ODD
    got = answers(neighbours.nearest(frame(spark, rows + rows[:2]), 5, 2, recall=1.0))
    assert got == plain(rows, 5, 2)
    assert 908 not in got and [a[1] for a in got[906]] == [907]


def test_an_id_with_several_vectors(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [0.0, 3.0])]
    got = neighbours.nearest(frame(spark, rows), 2, 2)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect()) == [
        (0, 1, 1, 1.0), (0, 1, 2, 3.0), (0, 2, 0, 0.0), (0, 2, 1, 1.0), (2, 1, 0, 3.0), (2, 2, 1, 3.0)
    ]


def test_no_rows_and_products_beyond_doubles(spark):
    assert neighbours.nearest(frame(spark, []).limit(0)).count() == 0
    assert neighbours.nearest(frame(spark, [(0, None), (20, [0.0])])).count() == 0
    huge = [(0, [1e200, 1e200]), (1, [1e200, -1e200]), (2, [1e200, 1e200]), (3, [1.0, 1.0])]
    assert [a[1] for a in answers(neighbours.nearest(frame(spark, huge), 3, 20))[0]] == [2, 3, 1]


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    vectors = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    true, got = plain(rows, 20, 20), answers(neighbours.nearest(vectors))
    assert got.keys() == true.keys()
    held = sum(len({a[1] for a in got[q]} & {a[1] for a in true[q]}) for q in true)
    assert held >= 0.9 * 20 * len(true)
    exact = {(q, a[1]): a[2] for q in true for a in true[q]}
    assert all(exact.get((q, a[1]), a[2]) == a[2] for q in got for a in got[q])


def test_clustered_vectors_open_few_leaves():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(64, 32))
    x = centres[rng.integers(64, size=4096)] + 0.05 * rng.normal(size=(4096, 32))
    forest = Forest(32, 8, float(np.sqrt((x**2).sum(1)).max()), 4)
    forest.cuts = [forest.cut(x, t) for t in range(4)]
    assert forest.try_out(x, 64, 20, 0.95) < 0.15 * (4 << 8)
    for t in range(4):
        assert np.bincount(forest.leaves(x, t), minlength=256).max() <= 17


def test_leaves_open_nearest_first():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    forest = Forest(5, 4, 10.0, 3)
    forest.cuts = [forest.cut(x, t) for t in range(3)]
    place = forest.places(x[:1])[0]
    order = forest.open(place, 48)
    assert len(set(order)) == 48 and {order[i][0] for i in range(3)} == {0, 1, 2}

    def far(tree, leaf):
        node, total = int(leaf) + 16, 0.0
        while node > 1:
            level = node.bit_length() - 2
            margin = place[tree][level] - forest.cuts[tree][node >> 1]
            total += margin**2 if (margin >= 0) != node % 2 else 0.0
            node >>= 1
        return total

    walked = [far(*o) for o in order]
    assert walked == sorted(walked)
