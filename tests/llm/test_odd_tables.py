"""Odd tables that other tests leave out: mixing, embeddings, and the whole pipeline."""

import math

from pyspark.sql import functions as F

from slotwise.llm import embedding, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_mixing_of_null_sources_and_clashing_columns(spark):
    rows = [(i % 50 if i % 7 else None, f"t{i % 50}", "en", "a" if i % 3 else None, 2, "mine", "own") for i in range(300)]
    given = spark.createDataFrame(rows, DOCS + ", rate string, documents string")
    out = mixing.mix(given)
    assert {r.source for r in out.select("source").distinct().collect()} == {"a", None}
    assert 150 < out.count() < 600 and out.where("rate = 'mine' and documents = 'own'").count() == out.count()
    assert mixing.mix(given.limit(0)).count() == 0


def test_embeddings_at_the_threshold_and_empty(spark):
    # Cosines of 0.9 and just below, repeated vectors, and vectors that take no part.
    turned = lambda c: [c, math.sqrt(1 - c * c), 0.0, 0.0]
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (2, turned(0.9 + 1e-9)), (3, [0.0, 0.0, 5.0, 0.0]), (4, [0.0, 0.0, 0.5, 0.0]), (5, [0.0, 0.0, 1.0, 1.0])]
    rows += [(6, None), (7, [0.0] * 4), (8, [float("nan"), 1.0, 0.0, 0.0]), (9, [0.9 - 1e-9, 0.0, 0.0, -math.sqrt(1 - (0.9 - 1e-9) ** 2)])]
    given = spark.createDataFrame(rows, "vec_id long, vector array<double>").withColumn("cell", F.lit("x"))
    real = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    name = next(f.name for f in real.schema if f.dataType.typeName() == "array")
    given = given.withColumnRenamed("vector", name)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding.near(given).collect()}
    alone = {i: (0, i) for i in (5, 6, 7, 8, 9)}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), **alone}
    assert embedding.near(given.limit(0)).count() == 0


def test_pipeline_of_odd_tables(spark, folder):
    import corpus_pipeline as p

    plain = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(*[c.split()[0] for c in DOCS.split(", ")])
    odd = [(None, "a text of its own, and some more words", "en", None, 38), (7, None, None, "src0", None), (8, "", "en", "src0", 0), (8, "", "en", "src0", 0)]
    odd += [(9, 'the password = "Sommer2031!x" was kept for the next one', None, "src1", 55)]
    extra = {c: F.lit(c) for c in ("score", "node", "__raw", "__secrets", "class_id")}
    given = plain.unionByName(spark.createDataFrame(odd, DOCS)).withColumns(extra)
    for docs, empty in ((given, False), (given.limit(0), True)):
        path = folder("odd-tables")
        docs.write.parquet(f"{path}/documents.parquet")
        for name in ("labels", "benchmark"):
            spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
        for name, stage in p.STAGES[:-1]:
            assert stage(spark, docs, path).columns == docs.columns, name
        out = p.run(spark, path)
        assert set(docs.columns) <= set(out.columns) and (out.count() == 0) == empty
        assert out.where("text like '%Sommer2031%'").count() == 0
