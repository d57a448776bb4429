"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon (words and word beginnings that toxic documents hold far more often) is counted over a bounded
sample of labelled documents, as are trees and calibration; every document is scored.  Features are
densities: lexicon hits, hits near second-person words, capitals, punctuation, obfuscated spellings.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import fresh, stored

# At most so many labelled documents are fitted on: the least by hash of their id.
SAMPLE = 16_000
# At most so many lexicon terms are kept: the strongest.
TERMS = 4_000
LEAST_COUNT = 4
LEAST_LOG_ODDS = 2.0
# Of ten parts of the sample, so many are kept for the calibration.
CALIBRATION_PARTS = 2
TREES, DEPTH, STEP, SEED = 20, 3, 0.3, 7
# The fitted rows are at most SAMPLE short lists: training passes over them a hundred times, in so many tasks.
FIT_TASKS = 6
NEAR = 5
BEGINNINGS = range(3, 8)

# Second-person words of the languages covered.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous votre vos "
    "tú ti tuyo tuya usted ustedes vosotros vuestro".split()
)
# Characters that stand for letters in disguised words.
DISGUISE = str.maketrans("@401357$!", "aaoiestsi")

WORD = re.compile(r"\w+(?:[@$!*.]\w+)*")
REPEATED = re.compile(r"(\w)\1{2,}")
PUNCTUATION = re.compile(r"[!?#$%&*]")
CAPITAL = re.compile(r"[^\W\d_a-z]")
MEMO = 200_000

Lexicon = dict[str, tuple[int, int]]


def terms_of(word: str) -> list[str]:
    """The word, and its beginnings marked as such."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if len(word) > n)]


def plain_word(token: str) -> tuple[str, bool]:
    """The token as a lexicon would hold it, and whether it was disguised: ``1d.i0t`` is ``idiot``."""
    low = token.lower()
    if low.isalpha():
        short = REPEATED.sub(r"\1", low) if len(low) > 3 else low
        return short, short != low
    letters = low.translate(DISGUISE)
    letters = "".join(c for c in letters if c.isalpha())
    mixed = any(c.isalpha() for c in low) and bool(letters)
    return (letters, True) if mixed else (low, False)


def log_odds(counts: tuple[int, int], classes: tuple[int, int], label: int | None) -> float:
    """Smoothed log odds of a term; a labelled document's own count is taken out first."""
    toxic, clean = counts
    if label is not None:
        toxic, clean = toxic - label, clean - (1 - label)
    if toxic < LEAST_COUNT - 1:
        return 0.0
    return math.log((toxic + 0.5) / (classes[0] + 1)) - math.log((max(clean, 0) + 0.5) / (classes[1] + 1))


class Features:
    """Turns texts into feature lists; remembers the odds of words it has met."""

    names = (
        "hits", "strong_hits", "odds", "strongest", "distinct_hits", "near_second_person", "second_person",
        "disguised_hits", "disguised", "capitals", "punctuation", "repeated", "log_words",
    )

    def __init__(self, lexicon: Lexicon, classes: tuple[int, int]) -> None:
        self.lexicon, self.classes, self.memo = lexicon, classes, {}

    def odds(self, token: str, label: int | None) -> tuple[float, bool, bool]:
        word, disguised = plain_word(token)
        found = [self.lexicon[t] for t in terms_of(word) if t in self.lexicon]
        best = max((log_odds(c, self.classes, label) for c in found), default=0.0)
        return (best if best >= LEAST_LOG_ODDS else 0.0), disguised, word in SECOND_PERSON

    def of(self, text: str | None, label: int | None = None) -> list[float]:
        """Features of a text; null counts as empty.  Lengths are bounded by the text alone."""
        text = text or ""
        memo = self.memo if label is None else {}
        if len(memo) > MEMO:
            memo.clear()
        n = strong = disguised_hits = disguised = second = near = 0
        total = best = 0.0
        hits: list[int] = []
        last_second = -NEAR - 1
        distinct = set()
        for match in WORD.finditer(text):
            token = match.group()
            known = memo.get(token)
            if known is None:
                known = memo[token] = self.odds(token, label)
            odds, hidden, person = known
            disguised += hidden
            if person:
                second += 1
                near += sum(1 for h in hits[-NEAR:] if n - h <= NEAR)
                last_second = n
            if odds:
                hits.append(n)
                distinct.add(token.lower())
                total += odds
                best = max(best, odds)
                strong += odds >= 4
                disguised_hits += hidden
                near += n - last_second <= NEAR
            n += 1
        words, size = max(n, 1), max(len(text), 1)
        return [
            len(hits) / words, strong / words, total / words, best, math.log1p(len(distinct)), near / words,
            second / words, disguised_hits / words, disguised / words, len(CAPITAL.findall(text)) / size,
            len(PUNCTUATION.findall(text)) / size, len(REPEATED.findall(text)) / words, math.log1p(n),
        ]


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, label, part): a bounded sample of the labelled documents that may be learnt from.

    Rows whose crc32(doc_id as text) mod 5 is 0 are held out.  A document labelled both ways counts as toxic.
    Only ids travel: they are at most ``sample`` rows, so broadcasting them is bounded.
    """
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1) and crc32(cast(doc_id as string)) % 5 <> 0")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .withColumn("h", F.xxhash64("doc_id"))
        .orderBy("h", "doc_id")
        .limit(sample)
        .select(F.col("doc_id").alias("__id"), F.col("label").alias("__label"), F.pmod("h", F.lit(10)).alias("__part"))
    )
    known = stored(known, "toxicity-ids")
    texts = docs.select("doc_id", "text")
    return texts.join(F.broadcast(known), F.col("doc_id") == F.col("__id")).select(
        "text", F.col("__label").alias("label"), F.col("__part").alias("part")
    )


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column(0), batch.column(1), strict=True):
            words = {plain_word(t)[0] for t in WORD.findall(text.as_py() or "")}
            (toxic if label.as_py() else clean).update({t for w in words for t in terms_of(w)})
    # A term no toxic document of this task holds matters only where another task counts it as toxic.
    terms = list(toxic.keys() | clean.keys())
    yield pa.RecordBatch.from_pydict(
        {
            "term": pa.array(terms, pa.string()),
            "toxic": pa.array([toxic[t] for t in terms], pa.int64()),
            "clean": pa.array([clean[t] for t in terms], pa.int64()),
        }
    )


class Model:
    """A fitted scorer: lexicon, trees and calibration, all of bounded size."""

    def __init__(
        self,
        features: Features,
        trees: GBTClassificationModel | None,
        calibration: IsotonicRegressionModel | None,
        rate: float,
    ) -> None:
        self.features, self.trees, self.calibration, self.rate = features, trees, calibration, rate

    def score(self, docs: DataFrame, name: str) -> DataFrame:
        """``docs`` with the column ``name``: the calibrated probability of label 1."""
        # Own names for the given columns: the fitted models add theirs.
        given = docs.toDF(*[f"given{i}" for i in range(len(docs.columns))])
        text = F.col(f"given{docs.columns.index('text')}")
        if self.trees is None:
            scored, probability = given, F.lit(self.rate)
        else:
            vectors = given.withColumn("__features", array_to_vector(_vectors(self.features)(text)))
            scored = self.trees.transform(vectors).withColumn("__margin", vector_to_array("__raw")[1])
            # The logistic of the margin keeps the order inside a step of the calibration.
            order = 1 / (1 + F.exp(-2 * F.col("__margin")))
            if self.calibration is None:
                probability = order
            else:
                scored = self.calibration.transform(scored)
                probability = 0.999 * F.col("__calibrated") + 0.001 * order
        kept = [F.col(f"given{i}").alias(c) for i, c in enumerate(docs.columns) if c != name]
        return scored.select(*kept, F.least(F.lit(1.0), F.greatest(F.lit(0.0), probability)).alias(name))


def _vectors(features: Features):
    def compute(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array([features.of(t.as_py()) for t in batch], pa.list_(pa.float64()))

    return F.arrow_udf(compute, "array<double>")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Lexicon and trees from eight tenths of the sample, calibration from the rest.

    Without labels of both classes the score is the rate of the one seen, 0 if there are none.
    """
    known = stored(labelled_sample(docs, labels, sample), "toxicity-sample")
    learning = known.where(F.col("part") >= CALIBRATION_PARTS)
    seen = {r["label"]: r["n"] for r in learning.groupBy("label").agg(F.count("*").alias("n")).collect()}
    classes = (seen.get(1, 0), seen.get(0, 0))
    if not all(classes):
        return Model(Features({}, classes), None, None, 1.0 if classes[0] else 0.0)
    odds = F.log((F.col("p") + 0.5) / (classes[0] + 1)) - F.log((F.col("q") + 0.5) / (classes[1] + 1))
    strongest = (
        learning.select("text", "label")
        .mapInArrow(_term_counts, "term string, toxic long, clean long")
        .groupBy("term")
        .agg(F.sum("toxic").alias("p"), F.sum("clean").alias("q"))
        .where((F.col("p") >= LEAST_COUNT) & (odds >= LEAST_LOG_ODDS))
        .orderBy((odds * F.sqrt("p")).desc(), "term")
        .limit(TERMS)
        .collect()
    )
    features = Features({r["term"]: (r["p"], r["q"]) for r in strongest}, classes)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels_, parts = (batch.column(i).to_pylist() for i in range(3))
            own = [y if part >= CALIBRATION_PARTS else None for y, part in zip(labels_, parts, strict=True)]
            lists = [features.of(t, y) for t, y in zip(texts, own, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {
                    "values": pa.array(lists, pa.list_(pa.float64())),
                    "label": pa.array([float(y) for y in labels_], pa.float64()),
                    "part": pa.array(parts, pa.int64()),
                }
            )

    prepared = stored(
        known.select("text", "label", F.col("part").cast("long")).mapInArrow(
            rows, "values array<double>, label double, part long"
        ),
        "toxicity-features",
    )
    prepared = prepared.coalesce(FIT_TASKS).withColumn("__features", array_to_vector("values"))
    learner = GBTClassifier(
        featuresCol="__features", labelCol="label", predictionCol="__class",
        maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED,
    )
    learner = learner.setRawPredictionCol("__raw").setProbabilityCol("__probability")
    trees = learner.fit(prepared.where(F.col("part") >= CALIBRATION_PARTS))
    held = trees.transform(prepared.where(F.col("part") < CALIBRATION_PARTS)).withColumn(
        "__margin", vector_to_array("__raw")[1]
    )
    calibration = None
    if held.select("label").distinct().count() == 2:
        calibration = IsotonicRegression(
            featuresCol="__margin", labelCol="label", predictionCol="__calibrated"
        ).fit(held.select("__margin", "label"))
    return Model(features, trees, calibration, classes[0] / sum(classes))


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are never learnt from; a null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Defined for: null texts (scored as empty), null ids (held out), empty and very long texts, repeated rows
    (one result each), empty tables (no rows; without labels every score is 0), other columns (ignored).
    """
    scored = fit(docs, labels).score(docs.select("doc_id", "text"), "score")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored ``threshold`` or more; columns stay as they are."""
    name = fresh(docs, "score")
    return fit(docs, labels).score(docs, name).where(F.col(name) < threshold).drop(name)
