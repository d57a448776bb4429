"""Mixing sources to target weights by Poisson replication.

Every document is repeated a Poisson number of times whose mean is its source's target repetition rate.
The number comes from inverting the distribution at a uniform value hashed from the document's id and a
seed, so it needs no state, is the same in every run and task, and equal rows get equal numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stored
from slotwise.operators.sizing import broadcast_if_small

TEMPERATURE = 0.5
SEED = "mix-1"
# 13 hexadecimal digits fill the 52 bits of a double's fraction.
DIGITS = 13
# The largest rate whose distribution is walked in one go; exp(-rate) is far from underflow.
PART = 500.0


def uniform(seed: str, *columns: Column) -> Column:
    """A value in [0, 1) from the MD5 of the seed and the columns; null counts as the text ``null``."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("null")) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def _inverse(u: Column, rate: Column) -> Column:
    """The smallest k with P(Poisson(rate) <= k) > u, walked up from zero."""
    state = F.struct(F.lit(0).alias("k"), F.exp(-rate).alias("p"), F.exp(-rate).alias("c"))
    top = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * rate / i
        return F.when(
            s["c"] <= u, F.struct(i.cast("int").alias("k"), p.alias("p"), (s["c"] + p).alias("c"))
        ).otherwise(s)

    return F.aggregate(F.sequence(F.lit(1), top), state, step)["k"]


def poisson_count(seed: str, key: Column, rate: Column) -> Column:
    """A Poisson(rate) number that depends on the seed and the key alone.

    A rate over ``PART`` is the sum of equal parts with a hashed value each, so no probability underflows.
    """
    parts = F.greatest(F.lit(1), F.ceil(rate / PART).cast("int"))
    return F.aggregate(
        F.sequence(F.lit(1), parts), F.lit(0), lambda n, j: n + _inverse(uniform(seed, key, j), rate / parts)
    )


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE) -> DataFrame:
    """(source, documents, rate): the repetition rate that gives each source its target share of as many
    rows as there are now.

    ``weights`` names target weights per source, others get none (rate 0); by default a source weighs its
    document count to the power ``temperature``.  A null source is a source of its own.
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("documents"))
    if weights is None:
        weighed = counts.withColumn("weight", F.pow(F.col("documents").cast("double"), F.lit(temperature)))
    else:
        given = [F.lit(x) for pair in weights.items() for x in (pair[0], float(pair[1]))]
        weighed = counts.withColumn("weight", F.coalesce(F.create_map(*given)[F.col("source")], F.lit(0.0)))
    total = weighed.agg(F.sum("documents").alias("n"), F.sum("weight").alias("w")).first()
    rows, sum_weight = float(total["n"] or 0), float(total["w"] or 0)
    share = F.col("weight") / F.lit(sum_weight) if sum_weight > 0 else F.lit(0.0)
    rate = share * F.lit(rows) / F.col("documents")
    return weighed.select("source", "documents", rate.alias("rate"))


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    temperature: float = TEMPERATURE,
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with each row repeated its Poisson number of times and shuffled globally.

    Adds ``copy`` (1, 2, …) and ``position`` (a hashed 63-bit key): rows go to partitions by the key and are
    sorted by it inside them, so reading the partitions one after another gives a random order.

    Defined for: null ids or texts (hashed as the text ``null``, kept), a null source (a source of its own),
    empty and very long texts (never looked at), repeated rows (equal rows get equal numbers and order),
    empty tables (empty result).  Input columns named like the added ones are replaced.
    """
    kept = docs.drop("copy", "position")
    rates = source_rates(docs, weights, temperature).select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    # One row per source; broadcast if measured small, else sort-merge with the hot source split.
    joined = kept.join(broadcast_if_small(stored(rates, "rates")), kept["source"].eqNullSafe(F.col("__source")))
    counted = joined.withColumn("__count", poisson_count(seed, F.col("doc_id"), F.col("__rate")))
    copies = (
        counted.where("__count > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("__count"))))
        .withColumn("position", F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("copy")), 1))
    )
    return (
        copies.drop("__source", "__rate", "__count")
        .repartition(F.col("position"))
        .sortWithinPartitions("position")
    )
