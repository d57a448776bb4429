"""What the text operators share: stored intermediate tables, reading, spilt-safe components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.sources.scratch import new_folder


def stored(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared folder and read again: computed once, and safe from lost executors."""
    spark = frame.sparkSession
    path = new_folder(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until ``frame`` has no such column."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Connected components of the pairs (a, b): one row (node, component) per node that occurs, component
    being the smallest node reachable.

    Rounds of large-star and small-star steps: each node's neighbours are attached to the smallest node
    known to them, until nothing changes.  All state is distributed and every round is written to the
    shared folder.  A step aggregates the minimum per node on the map side; the join with it is a
    sort-merge join, whose hot nodes adaptive execution splits.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    links = stored(both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), purpose)
    mark = None
    while True:
        # Large star: every larger neighbour of u is tied to the smallest of u and its neighbours.
        around = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        tied = around.join(least.hint("merge"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        tied = tied.where("u <> v").distinct()
        # Small star: u and its smaller neighbours are tied to the smallest of them.
        small = tied.groupBy("u").agg(F.min("v").alias("m"))
        pairs = tied.join(small.hint("merge"), "u")
        links = stored(
            pairs.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(pairs.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            purpose,
        )
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
