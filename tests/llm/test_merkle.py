"""The Merkle manifest against a plain tree, and the cases its docstring defines."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from slotwise.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, node string, pos long, n long"


def sha(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def written(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def digest(r, text):
    return sha(*[written(v) for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)])


def tree(nodes, fanout):
    """The root, and for every leaf the nodes of its runs before and after its own."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + fanout, len(nodes))) for i in range(0, len(nodes), fanout)]
        for run in runs:
            for j in run:
                for leaf in below[j]:
                    paths[leaf].append(("".join(nodes[i] for i in run if i < j), "".join(nodes[i] for i in run if i > j)))
        nodes, below = [sha(*[nodes[j] for j in run]) for run in runs], [[x for j in run for x in below[j]] for run in runs]
    return nodes[0], paths


def plain(rows, fanout):
    named = {}
    for r in rows:
        named.setdefault(b"" if r["source"] is None else b"s" + r["source"].encode(), []).append(r)
    trees = []
    for name in sorted(named):
        order = sorted(named[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, digest(r, r["text"])))
        trees.append((order, *tree([digest(r, r["text"]) for r in order], fanout)))
    root, tops = tree([subroot for _, subroot, _ in trees], fanout)
    for (order, subroot, paths), top in zip(trees, tops, strict=True):
        for r, path in zip(order, paths, strict=True):
            steps, text = path + top, r["text"]
            if text is not None and r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = digest(r, text)
            for before, after in steps:
                folded = sha(before, folded, after)
            proof = sha(*[before + after for before, after in steps])
            yield r["doc_id"], digest(r, r["text"]), subroot, root, proof, folded, folded == root


def ordered(rows):
    return sorted(rows, key=str)


def given(spark, n):
    rows = [
        (None if i % 17 == 5 else i // 2 if i % 11 == 3 else i, None if i % 13 == 7 else f"zeile {i}\nüber\n" * (i % 5), "en" if i % 3 else None,
         None if i % 7 == 0 else "hot" if i % 3 else ["ä", "Z", "z", "", "one" + str(i)][i % 5], i if i % 4 else None, "t", "x", 9, 9)
        for i in range(n)
    ]
    return spark.createDataFrame(rows + rows[:3], DOCS)


@pytest.mark.parametrize(("n", "fanout", "height"), [(150, 3, 6), (150, 3, 1), (90, 2, 2), (2, 3, 6)])
def test_against_a_plain_tree(spark, monkeypatch, n, fanout, height):
    docs = given(spark, n)
    monkeypatch.setattr(merkle.manifest, "__defaults__", (None, fanout, height))
    got = [tuple(r) for r in merkle.proven(docs).collect()]
    assert ordered(got) == ordered(plain([r.asDict() for r in docs.collect()], fanout))


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(None, None, None, None, None)], "doc_id long, source string, lang string, n_chars long, text string")
    leaf = sha("-----")
    assert [tuple(r) for r in merkle.proven(one).collect()] == [(None, leaf, leaf, leaf, sha(""), leaf, True)]
    assert merkle.proven(one.limit(0)).count() == 0


def test_a_long_text_is_one_leaf(spark):
    text = "ü\n" * 300_000
    docs = spark.createDataFrame([(1, "s", "en", 2, text)], "doc_id long, source string, lang string, n_chars long, text string")
    row = merkle.manifest(docs).first()
    assert row["leaf"] == sha("1:1", "1:s", "2:en", "1:2", f"{len(text.encode())}:{text}") == row["root"]


def test_other_types_and_real_steps(spark):
    docs = given(spark, 40).withColumn("doc_id", F.col("doc_id").cast("int"))
    rows = merkle.manifest(docs, {"own": F.col("text")}).select("leaf", "root", "steps", "own", merkle.fold(F.col("leaf"), F.col("steps")).alias("f"))
    for r in rows.collect():
        assert r["f"] == r["root"]
        assert all(len(s["before"] + s["after"]) % 64 == 0 and len(s["before"] + s["after"]) <= 128 for s in r["steps"])
