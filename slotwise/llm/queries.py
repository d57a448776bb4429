"""The registered queries of this package and the SQL each is compared with, where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm import (
    collocations,
    decontaminate,
    embedding,
    merkle,
    minhash,
    mixing,
    neighbours,
    pii,
    secrets,
    suffix,
    template,
    toxicity,
    warc,
)
from slotwise.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


@query()
def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings by digest: a report of secrets must not spread them."""
    found = secrets.secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "finding",
        F.sha2(F.col("candidate").cast("binary"), 256).alias("secret_sha256"),
        F.length("candidate").alias("n_chars"),
        "score",
    )


@query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


MIX_SQL = f"""
WITH per_source AS (
    SELECT source, count(*) AS n, sqrt(count(*)) AS w FROM {{docs}} GROUP BY source
), totals AS (
    SELECT sum(n) AS n_all, sum(w) AS w_all FROM per_source
), rates AS (
    SELECT source, w / w_all * n_all / n AS rate FROM per_source, totals
), steps AS (
    SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS below
    FROM rates, (SELECT unnest(range(0, 120)) AS k)
), drawn AS (
    SELECT d.*, ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, 'null') || ':1'), 1, 13))::BIGINT
        / 4503599627370496.0 AS u
    FROM {{docs}} d
), counted AS (
    SELECT d.* EXCLUDE (u), (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.below <= d.u) AS times
    FROM drawn d
)
SELECT * EXCLUDE (times), unnest(range(1, times + 1))::INTEGER AS copy FROM counted
"""


@query(MIX_SQL.format(docs="documents"))
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("position")


@query()
def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


@query()
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


@query()
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query()
def op10_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near(table(spark, sf_dir, "embeddings"))


@query()
def op3_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return template.main_text(table(spark, sf_dir, "pages"))


@query()
def op7_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def manifest_sql(docs: str, depth: int, top: int) -> str:
    """The manifest by lists of children, for sources of up to 3 ** depth rows and 3 ** top sources."""

    def row(text: str) -> str:
        values = [text if c == "text" else c for c in merkle.COLUMNS]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values) + ")"

    # The checksum's register bit by bit; its complement is the checksum.
    crc = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
        lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384)))"""
    parts = [
        f"""marked AS (SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
        CASE WHEN {crc} & 1 = 1 THEN replace(text, chr(10), '') ELSE text END AS other FROM {docs})""",
        f"hashed AS (SELECT doc_id, tree, {row('text')} AS leaf, {row('other')} AS forged FROM marked)",
        """a0 AS (SELECT *, leaf AS node, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY tree) AS n FROM hashed)""",
        "p0 AS (SELECT doc_id, leaf, tree, pos, forged AS folded, '' AS proof FROM a0)",
    ]

    def climb(nodes: str, paths: str, levels: int) -> None:
        for k in range(levels):
            before, after = "array_to_string(kids[:p.pos % 3], '')", "array_to_string(kids[p.pos % 3 + 2:], '')"
            parts.append(
                f"{nodes}_kids{k} AS (SELECT tree, pos // 3 AS up, n, list(node ORDER BY pos) AS kids FROM {nodes}{k} GROUP BY ALL)"
            )
            parts.append(
                f"""{nodes}{k + 1} AS (SELECT tree, up AS pos, (n + 2) // 3 AS n,
                CASE WHEN n > 1 THEN sha256(array_to_string(kids, '')) ELSE kids[1] END AS node FROM {nodes}_kids{k})"""
            )
            parts.append(
                f"""{paths}{k + 1} AS (SELECT p.* EXCLUDE (pos, folded, proof), p.pos // 3 AS pos,
                CASE WHEN n > 1 THEN sha256({before} || folded || {after}) ELSE folded END AS folded,
                CASE WHEN n > 1 THEN proof || {before} || {after} ELSE proof END AS proof
                FROM {paths}{k} p JOIN {nodes}_kids{k} k ON k.tree = p.tree AND k.up = p.pos // 3)"""
            )

    climb("a", "p", depth)
    parts.append(f"b0 AS (SELECT 0 AS tree, tree AS pos, count(*) OVER () AS n, node FROM a{depth})")
    parts.append(
        f"""q0 AS (SELECT doc_id, leaf, b0.node AS subroot, 0 AS tree, b0.pos, folded, proof
        FROM p{depth} p JOIN b0 ON b0.pos = p.tree)"""
    )
    climb("b", "q", top)
    return f"""WITH {", ".join(parts)}
    SELECT doc_id, leaf, subroot, node AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = node AS verified
    FROM q{top}, b{top}"""


@query(manifest_sql("documents", 12, 6))
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proven(table(spark, sf_dir, "documents"))


COLLOCATIONS_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), worded AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
), sized AS (
    SELECT lang, w, i, unnest(range(1, 6)) AS k FROM placed
), f AS (
    SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS f
    FROM sized WHERE i + k - 1 <= len(w) GROUP BY ALL
), n AS (
    SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
    SELECT lang, phrase, string_split(phrase, ' ') AS w, k, f AS a FROM f WHERE k > 1 AND f >= 100
), cuts AS (
    SELECT c.lang, c.phrase, c.a, c.cut, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * a * n.n) // (l.f::HUGEINT * r.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:cut], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
    JOIN n ON n.lang = c.lang
), weakest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), kept AS (
    SELECT * FROM weakest w WHERE NOT EXISTS (
        SELECT 1 FROM candidates c WHERE c.lang = w.lang AND c.a >= w.a AND c.phrase <> w.phrase
            AND contains(' ' || c.phrase || ' ', ' ' || w.phrase || ' '))
)
SELECT * FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
           n::BIGINT AS n, score::BIGINT AS score
    FROM kept
) WHERE rank <= 2000
"""


@query(COLLOCATIONS_SQL)
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query()
def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))
