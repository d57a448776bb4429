"""Secret scans: candidate strings, and a random forest that removes the false positives.

Everything here is DataFrame expressions and Spark ML; nothing leaves the JVM.  Candidates are long unbroken
strings with a digit, whatever is assigned to a name that tells of secrets, passwords in addresses, signed
tokens of dotted parts and the bodies of private keys.  The forest looks at their length, their character
transitions (mixed classes, and how likely their letter pairs are in the corpus), how much of them dictionary
words cover, the path they were found under and the words beside them.  It is trained on labelled findings.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.llm.common import fresh, stored
from slotwise.operators.sizing import broadcast_if_small

# Names whose values are candidates, however short; the last part of a name may follow them.
NAMES = "token|secret|password|passwd|passphrase|pwd|pass|api.?key|access.?key|private.?key|credentials?|auth"
# A value behind such a name: the first test is cheap and rules out nearly every place.
ASSIGNED = (
    r"(?<=[=:>]\s{0,2}[\"'`]?)(?<=(?i:" + NAMES + r")(?:[_.-][A-Za-z0-9_.-]{0,16}|s)?[\"'`\]]{0,2}\s{0,2}[:=]{1,2}>?\s{0,2}[\"'`]?)"
    r"(?!//)[^\s\"'`,;&<>()\[\]{}=:][^\s\"'`,;&<>()\[\]]{3,}(?<![.!?:])"
)
# The password of an address (of users of up to 64 characters), a signed token, the body of a private key.
ADDRESS = r"(?<=:)(?<=://[^\s:/@]{0,64}:)[^\s/@]{3,}+(?=@)"
SIGNED = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]{4,}+){1,2}"
PRIVATE = r"(?<=-----\s{0,2})(?<=PRIVATE KEY-----\s{0,2})[A-Za-z0-9+/][A-Za-z0-9+/=\s]{31,}+"
# A run of key characters, not part of a longer one nor the name of a value, with a digit in it; '=' may pad it.
RUN = r"(?<![A-Za-z0-9_+/-])(?=[A-Za-z_+/-]*[0-9])[A-Za-z0-9_+/-]{16,}+(?!=[\"'`]?[A-Za-z0-9_+/-])(?:={1,2})?"
CANDIDATE = "|".join((PRIVATE, SIGNED, ADDRESS, ASSIGNED, RUN))
# A secret of this length is masked wherever its text holds it again; a shorter one just where it was found.
LONG = 16
MASK = "[secret]"
# The commonest words of the corpus that count as dictionary words.
DICTIONARY = 5_000
# Labelled findings generated when none are given, and the most that are ever fitted on.
FINDINGS = 4_000
MOST_FINDINGS = 50_000
TREES, DEPTH, SEED = 30, 6, 11
BEFORE, AFTER = 48, 24

# Words that stand beside secrets, beside other identifiers, and in paths of samples.
SECRET_WORDS = "token|secret|passw|pwd|api.?key|access.?key|private.?key|auth|bearer|credential|signature"
OTHER_WORDS = "commit|sha|md5|digest|checksum|hash|etag|revision|uuid|guid|order|card|invoice|phone|isbn|page|tag|version|build"
SAMPLE_PATHS = "test|example|sample|mock|fixture|docs?/"
PLACEHOLDERS = "example|placeholder|change.?me|your[_-]|xxxx|dummy|0000000|1234567|abcdef|redacted|[*]{3}"
NO_VALUES = (
    "^(none|null|nil|true|false|undefined|required|optional|string|str|text|password|passwd|pass|secret|token|username|user|root|admin|test|empty|hidden|unset)$"
    "|^[$%]|environ|getenv|[a-z]\\.[a-z]{3,}|config|vault"
)

FEATURES = (
    "length", "digits", "uppers", "symbols", "class_changes", "letter_digit", "repeats", "pair_odds",
    "covered", "hex_only", "placeholder", "secret_word", "assigned", "quoted", "other_word", "sample_path",
    "address", "signed", "private", "no_value", "prose",
)


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """(doc_id, finding, candidate, before, after, path): every candidate of every text, numbered from 0."""
    where = F.col(path) if path in docs.columns else F.lit(None)
    found = docs.select(
        "doc_id",
        where.cast("string").alias("path"),
        F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)).alias("found"),
        # The texts between the candidates: the one at i ends where candidate i begins.
        F.split("text", CANDIDATE, -1).alias("between"),
    ).where(F.size("found") > 0)
    item = F.transform(
        "found",
        lambda c, i: F.struct(
            i.alias("finding"),
            c.alias("candidate"),
            F.right(F.get("between", i), F.lit(BEFORE)).alias("before"),
            F.left(F.get("between", i + 1), F.lit(AFTER)).alias("after"),
        ),
    )
    return found.select("doc_id", "path", F.explode(item).alias("f")).select("doc_id", "path", "f.*")


def vocabulary(docs: DataFrame, size: int = DICTIONARY) -> tuple[list[str], dict[str, float]]:
    """The ``size`` commonest words of all texts, and the log odds of letter pairs in them against chance."""
    words = docs.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    counts = words.where(F.length("word").between(2, 20)).groupBy("word").agg(F.count("*").alias("n"))
    # How many words have how many occurrences, in steps of a sixteenth of a power of two: what is sorted is near ``size``.
    counts = stored(counts.withColumn("step", F.floor(F.log2("n") * 16).cast("int")), "secret-words")
    steps = sorted(((r["step"], r["count"]) for r in counts.groupBy("step").count().collect()), reverse=True)
    least, above = 0, 0
    for least, words_ in steps:
        above += words_
        if above >= size:
            break
    common = counts.where(F.col("step") >= least).orderBy(F.col("n").desc(), "word").limit(size).collect()
    pairs: dict[str, float] = {}
    for row in common:
        for i in range(len(row["word"]) - 1):
            pair = row["word"][i : i + 2]
            pairs[pair] = pairs.get(pair, 0) + row["n"]
    total = sum(pairs.values()) or 1
    # Against 26 letters drawn evenly, in steps of a thousandth; unseen pairs get the least odds.
    odds = {p: n / total * 676 for p, n in pairs.items()}
    return [r["word"] for r in common if len(r["word"]) > 2], odds


class Measures:
    """The feature expressions; holds the bounded vocabulary."""

    UNSEEN = -4.0

    def __init__(self, words: list[str], pairs: dict[str, float]) -> None:
        # Foldable expressions: one literal each, however many words.
        self.words = F.split(F.lit(" ".join(words)), " ")
        odds = {p: max(self.UNSEEN, math.log(o)) for p, o in pairs.items()}
        self.pairs = F.str_to_map(F.lit(",".join(f"{p}:{o:.3f}" for p, o in odds.items())), F.lit(","), F.lit(":")).cast(
            "map<string,double>"
        )

    def columns(self) -> list[Column]:
        c = F.col("candidate")
        low = F.lower("candidate")
        size = F.length(c).cast("double")
        count = lambda pattern, of=c: F.coalesce(F.regexp_count(of, F.lit(pattern)), F.lit(0)).cast("double")
        before, after = F.lower(F.coalesce("before", F.lit(""))), F.coalesce("after", F.lit(""))
        flag = lambda test: test.cast("double")
        classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(c, "[a-z]+", "l"), "[A-Z]+", "u"), "[0-9]+", "d")
        parts = F.filter(F.split(low, r"[^\p{L}]+"), lambda w: F.length(w) > 2)
        covered = F.aggregate(
            F.filter(parts, lambda w: F.array_contains(self.words, w)), F.lit(0), lambda n, w: n + F.length(w)
        )
        odds = F.aggregate(
            F.sequence(F.lit(1), F.length(c) - 1),
            F.lit(0.0),
            lambda n, i: n + F.coalesce(F.try_element_at(self.pairs, low.substr(i, F.lit(2))), F.lit(self.UNSEEN)),
        )
        return [
            F.log(size),
            count("[0-9]") / size,
            count("[A-Z]") / size,
            count("[^A-Za-z0-9]") / size,
            F.length(classes) / size,
            count("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])") / size,
            count(r"(.)(?=\1)") / size,
            odds / size,
            covered / size,
            flag(F.regexp_like(c, F.lit("^([0-9a-f]+|[0-9A-F]+)$")) & F.regexp_like(low, F.lit("[a-f]"))),
            flag(F.regexp_like(low, F.lit(PLACEHOLDERS))),
            flag(F.regexp_like(before, F.lit(f"({SECRET_WORDS})[^\\n]{{0,12}}$"))),
            flag(F.regexp_like(before, F.lit("[:=]\\s*[\"'`]?$"))),
            flag(F.regexp_like(before, F.lit("[\"'`]$")) & F.regexp_like(after, F.lit("^[\"'`]"))),
            flag(F.regexp_like(before, F.lit(f"({OTHER_WORDS})\\W[^\\n]{{0,12}}$"))),
            flag(F.regexp_like(F.lower(F.coalesce("path", F.lit(""))), F.lit(SAMPLE_PATHS))),
            flag(F.regexp_like(before, F.lit("://[^\\s:/@]*:$")) & F.startswith(after, F.lit("@"))),
            flag(F.regexp_like(c, F.lit("^eyJ[A-Za-z0-9_-]+\\."))),
            flag(F.regexp_like(before, F.lit("private key-----\\s*$"))),
            flag(F.regexp_like(low, F.lit(NO_VALUES))),
            # Unquoted, and more words follow: a sentence about secrets.
            flag(F.regexp_like(before, F.lit(": ?$")) & F.regexp_like(after, F.lit("^[,.;]? [a-z]"))),
        ]

    def add(self, found: DataFrame, name: str = "__features") -> DataFrame:
        """``found`` with the feature vector."""
        values = [F.coalesce(x, F.lit(0.0)) for x in self.columns()]
        return found.withColumn(name, array_to_vector(F.array(*values)))


def labelled_findings(spark: SparkSession, words: list[str], n: int = FINDINGS) -> DataFrame:
    """(candidate, before, after, path, label): findings labelled by how they were made, half of them secrets.

    Secrets are keyed digests in several alphabets beside the words that announce them; the others are
    numbers, compounds of corpus words, placeholders, and digests beside the words for checksums and ids.
    """
    vocabulary_ = F.split(F.lit(" ".join(words[:500] or ["word"])), " ")
    h = lambda k: F.sha2(F.concat(F.lit(f"finding-{k}-"), F.col("id").cast("string")), 512)
    pick = lambda k, of: F.element_at(of, (F.pmod(F.xxhash64(F.lit(k), "id"), F.size(of)) + 1).cast("int"))
    word = lambda k: pick(k, vocabulary_)
    choose = lambda k, *of: pick(k, F.array(*[x if isinstance(x, Column) else F.lit(x) for x in of]))
    cut = lambda text, k, low, span: F.left(text, (F.pmod(F.xxhash64(F.lit(k), "id"), F.lit(span)) + low).cast("int"))
    base64 = F.translate(F.base64(F.unhex(h("b"))), "=", "")
    secret = choose(
        "kind", cut(h("a"), "n1", 32, 33), F.left(h("a"), F.lit(40)), F.left(h("a"), F.lit(40)), F.left(h("a"), F.lit(32)),
        F.left(h("a"), F.lit(64)), F.upper(F.left(h("a"), F.lit(40))), cut(base64, "n2", 20, 45),
        F.concat(choose("p", "sk_live_", "ghp_", "xoxb-", "AKIA"), cut(base64, "n3", 20, 20)),
    )
    digits = F.translate(h("d"), "abcdef", "012345")
    uuid = F.regexp_replace(F.left(h("e"), F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    other = choose(
        "other", cut(digits, "n4", 16, 12), cut(digits, "n5", 16, 4),
        F.concat_ws("-", word("w1"), word("w2"), word("w3"), F.left(digits, F.lit(4))),
        F.concat(word("w4"), word("w5"), word("w6"), F.left(digits, F.lit(2))),
        F.concat(F.lit("2024-01-"), F.left(digits, F.lit(2)), F.lit("T10"), F.lit("-00-00Z")),
        choose("ph", "xxxxxxxxxxxxxxxx0000", "your_token_here_12345", "0000000000000000000a", "abcdef0123456789abcdef", "EXAMPLEKEY1234567"),
        F.left(h("f"), F.lit(40)), uuid,
        F.concat_ws("/", word("w7"), word("w8"), F.left(digits, F.lit(5)), word("w9")),
    )
    filler = F.concat_ws(" ", word("c1"), word("c2"), word("c3"))
    key = choose("key", "token", "secret", "password", "api_key", "access_key", "auth token", "bearer", "TOKEN", "Secret")
    glue = choose("glue", ' = "', ' = "', '="', ": ", " = ", ': "', " ", "=", "=")
    idle = choose("idle", "", "the ", "= ", ": ", "id: ", "no. ", '"', "id=", "?page=", "&order=")
    check = choose("sum", "commit ", "sha256: ", "md5 = ", "digest ", "checksum: ", "uuid = ", "etag: ", "md5=", "?commit=", "&uuid=")
    # Unquoted assignments stand in shells and in the queries of addresses.
    lead = F.when(F.col("glue") == "=", choose("lead", " ", "\n", "?", "&", " export ")).otherwise(F.lit(" "))
    trail = F.when(F.col("glue") == "=", choose("trail", " ", "\n", "&", "")).otherwise(F.lit(" "))
    far = F.pmod(F.xxhash64(F.lit("path"), "id"), F.lit(10)) == 0
    parts = {"secret": secret, "other": other, "filler": filler, "key": key, "glue": glue, "idle": idle, "check": check}
    ends = {"lead": lead, "trail": trail}
    made = stored(
        spark.range(n)
        .select("id", (F.col("id") % 2 == 1).alias("real"), far.alias("far"), *[x.alias(k) for k, x in parts.items()])
        .select("*", *[x.alias(k) for k, x in ends.items()]),
        "secret-parts",
    )
    is_digest = F.col("other").rlike("^[0-9a-f-]{32,}$") & F.col("other").rlike("[a-f]")
    is_placeholder = F.col("other").rlike("(?i)xxxx|your_|0000000|abcdef|EXAMPLE")
    announced = F.when(F.col("real") | is_placeholder, F.concat("key", "glue")).when(is_digest, F.col("check"))
    quoted = F.col("real") & F.col("glue").endswith('"')
    return made.select(
        F.when(F.col("real"), F.col("secret")).otherwise(F.col("other")).alias("candidate"),
        F.concat("filler", F.when(announced.isNull(), F.lit(" ")).otherwise(F.col("lead")), F.coalesce(announced, F.col("idle"))).alias("before"),
        F.when(quoted, F.lit('" ')).otherwise(F.col("trail")).alias("after"),
        F.when(~F.col("far"), F.lit("src0")).when(F.col("real"), F.lit("src/main")).otherwise(F.lit("test/data")).alias("path"),
        F.col("real").cast("double").alias("label"),
    )


def short_findings(spark: SparkSession, words: list[str], n: int = FINDINGS) -> DataFrame:
    """As ``labelled_findings``, of other forms: passwords assigned and in addresses, signed tokens, keys broken by
    dashes, private keys; against them words, names of settings and placeholders where values stand."""
    vocabulary_ = F.split(F.lit(" ".join(words[:500] or ["word"])), " ")
    h = lambda k: F.sha2(F.concat(F.lit(f"short-{k}-"), F.col("id").cast("string")), 512)
    pick = lambda k, of: F.element_at(of, (F.pmod(F.xxhash64(F.lit(f"short-{k}"), "id"), F.size(of)) + 1).cast("int"))
    word = lambda k: pick(k, vocabulary_)
    choose = lambda k, *of: pick(k, F.array(*[x if isinstance(x, Column) else F.lit(x) for x in of]))
    cut = lambda text, k, low, span: F.left(text, (F.pmod(F.xxhash64(F.lit(f"short-{k}"), "id"), F.lit(span)) + low).cast("int"))
    plain = lambda k: F.translate(F.base64(F.unhex(h(k))), "=+/", "")
    digits = F.translate(h("d"), "abcdef", "012345")
    password = choose(
        "password", F.concat(F.initcap(word("p1")), cut(digits, "p2", 2, 4), choose("p3", "!", "#", "$", "")),
        cut(plain("p4"), "p5", 8, 8), F.concat(word("p6"), choose("p7", "@", "_", "!", "-"), cut(digits, "p8", 2, 3), F.initcap(word("p9"))),
        F.concat(F.translate(F.concat(F.initcap(word("p10")), word("p11")), "aeiost", "43105+"), cut(digits, "p12", 1, 3)),
        F.concat(word("p13"), cut(digits, "p14", 1, 4)), F.translate(cut(plain("p15"), "p16", 12, 20), "0123456789", "qWzKvXjRpT"),
    )
    no_value = choose(
        "none", word("n1"), word("n2"), word("n3"), F.initcap(word("n4")), F.concat_ws("-", word("n5"), word("n6")), "required", "None", "null", "true",
        "false", "${PASSWORD}", "$SECRET", "%PASS%", "********", "changeme", "your-password", "os.environ", "config.password", "self.token",
        "request.token", "xxxxxxxx", "password", "<hidden>", "example", "REDACTED",
    )
    dashed = F.concat(
        choose("v1", "xoxb-", "xoxp-", "sk-", "glpat-", "pk_live_", "rk_live_"),
        choose("v2", F.concat(F.left(digits, F.lit(12)), F.lit("-")), F.lit("")), cut(plain("v3"), "v4", 12, 24),
    )
    slug = choose("slug", F.concat_ws("-", F.lit("release"), F.lit("2024"), F.lit("01"), word("s1"), word("s2")), F.concat_ws("_", word("s3"), word("s4"), word("s5"), F.left(digits, F.lit(3))))
    jwt = F.concat(F.lit("eyJ"), cut(plain("j1"), "j2", 14, 24), F.lit("."), cut(plain("j3"), "j4", 20, 60), F.lit("."), cut(plain("j5"), "j6", 20, 40))
    key = choose("key", "password", "passwd", "DB_PASSWORD", "secret", "token", "api_key", "pwd", '"password"', "auth_token", "Password", "client_secret")
    glue = choose("glue", ' = "', '="', ': "', "=", ": ", " = ", "='", ": '")
    quote = F.regexp_extract("glue", "[\"']$", 0)
    made = stored(
        spark.range(n).select(
            "id", (F.col("id") % 2 == 1).alias("real"), choose("shape", *["assigned"] * 6, *["address"] * 3, "token", "run", "run", "private").alias("shape"),
            password.alias("password"), no_value.alias("no_value"), dashed.alias("dashed"), slug.alias("slug"), jwt.alias("jwt"),
            plain("k").alias("body"), key.alias("key"), glue.alias("glue"), F.concat_ws(" ", word("c1"), word("c2"), word("c3")).alias("filler"),
            choose("scheme", "postgres", "mysql", "https", "redis", "amqp", "mongodb").alias("scheme"), word("user").alias("user"),
            choose("lead", " ", "\n", " export ", "\n  ").alias("lead"), choose("more", "\n", "\n", "").alias("more"),
            (F.pmod(F.xxhash64(F.lit("short-named"), "id"), F.lit(2)) == 0).alias("named"),
        ),
        "secret-short",
    )
    real, shape = F.col("real"), F.col("shape")
    assigned = F.concat("filler", "lead", "key", "glue")
    value = F.when(real, F.col("password")).otherwise(F.col("no_value"))
    # Sentences go on behind a word; values end their line.
    ending = F.when(quote != "", quote).when(~real & F.col("no_value").rlike("^[A-Za-z]+$"), F.concat(F.lit(" "), "filler")).otherwise(F.col("more"))
    run = F.when(real, F.col("dashed")).otherwise(F.col("slug"))
    token = F.when(real, F.col("jwt")).otherwise(F.col("slug"))
    loose = F.when(F.col("named") & real, assigned).otherwise(F.concat("filler", F.lit(" ")))
    loosely = F.when(F.col("named") & real, F.concat(quote, F.lit("\n"))).otherwise(F.concat(F.lit(" "), "filler"))
    of = lambda a, b, c, d, e: F.when(shape == "assigned", a).when(shape == "address", b).when(shape == "token", c).when(shape == "run", d).otherwise(e)
    return made.select(
        of(value, value, token, run, F.when(real, F.col("body")).otherwise(F.col("slug"))).alias("candidate"),
        of(
            assigned, F.concat("filler", F.lit(" "), "scheme", F.lit("://"), "user", F.lit(":")), loose, loose,
            F.when(real, F.lit("-----BEGIN RSA PRIVATE KEY-----\n")).otherwise(F.concat("filler", F.lit(" "))),
        ).alias("before"),
        F.left(of(ending, F.concat(F.lit("@"), "user", F.lit(".net/")), loosely, loosely, F.when(real, F.lit("-----END RSA PRIVATE KEY")).otherwise(F.lit(" "))), F.lit(AFTER)).alias("after"),
        F.lit("src0").alias("path"),
        real.cast("double").alias("label"),
    )


def fit(findings: DataFrame, measures: Measures) -> RandomForestClassificationModel:
    """The forest over the labelled findings; of more than MOST_FINDINGS, over about as many (the least by hash)."""
    share = MOST_FINDINGS / max(findings.count(), 1)
    part = F.pmod(F.xxhash64("candidate", "before", "after"), F.lit(1 << 32)) < int(share * (1 << 32))
    bounded = findings.where(part) if share < 1 else findings
    learner = RandomForestClassifier(
        featuresCol="__features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED
    ).setProbabilityCol("__probability").setPredictionCol("__class").setRawPredictionCol("__raw")
    return learner.fit(stored(measures.add(bounded).select("__features", F.col("label").cast("double")), "secret-findings"))


def trained(docs: DataFrame, findings: DataFrame | None) -> tuple[Measures, RandomForestClassificationModel]:
    words, pairs = vocabulary(docs)
    measures = Measures(words, pairs)
    spark = docs.sparkSession
    made = findings if findings is not None else labelled_findings(spark, words).unionByName(short_findings(spark, words))
    return measures, fit(made, measures)


def scan(docs: DataFrame, findings: DataFrame | None = None, path: str = "source") -> DataFrame:
    """(doc_id, finding, candidate, path, score): every candidate of ``docs`` with its probability to be a secret.

    Defined for: null and empty texts (no candidates), very long texts (whole), repeated rows (each has its
    findings), null ids (kept), a null or missing path (no path feature), empty tables (no rows), other
    columns (ignored).
    """
    measures, forest = trained(docs, findings)
    scored = forest.transform(measures.add(candidates(docs, path)))
    return scored.select(
        "doc_id", "finding", "candidate", "path", vector_to_array("__probability")[1].alias("score")
    )


def secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """The findings of ``scan`` that are secrets: their false positives are gone."""
    return scan(docs, findings).where(F.col("score") >= threshold)


def mask_secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` with every secret replaced by MASK; all rows stay, n_chars follows if there is one.

    A secret of LONG characters goes wherever its text has it as a candidate, a shorter one where it was found.
    Defined for: null and empty texts (kept as they are), null ids and rows that share one (each by its own
    text), repeated rows (alike), a missing source (no path feature), empty tables, columns of any name (kept).
    """
    measures, forest = trained(docs, findings)
    # Rows that agree in this digest have the same findings.
    same = ["doc_id", "text", *(["source"] if "source" in docs.columns else [])]
    digest, low, top = fresh(docs, "__secrets"), F.xxhash64(F.lit(1), *same), F.xxhash64(F.lit(2), *same)
    marked = docs.select(F.struct(low.alias("a"), top.alias("b")).alias("doc_id"), "text", *same[2:])
    found = forest.transform(measures.add(candidates(marked)))
    hot = found.where(vector_to_array("__probability")[1] >= threshold)
    # Findings are few and small: they go back to the texts they are in, once for rows that are alike.
    by_row = hot.groupBy("doc_id").agg(
        F.collect_set("finding").alias("at"), F.collect_set(F.when(F.length("candidate") >= LONG, F.col("candidate"))).alias("values")
    )
    by_row = stored(by_row.select(F.struct("doc_id.a", "doc_id.b", "at", "values").alias(digest)), "secret-masks")
    joined = docs.join(broadcast_if_small(by_row), (low == F.col(f"{digest}.a")) & (top == F.col(f"{digest}.b")), "left")
    masked = F.zip_with(
        F.split("text", CANDIDATE, -1),
        F.transform(
            F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0)),
            lambda c, i: F.when(
                F.array_contains(F.col(f"{digest}.at"), i) | F.array_contains(F.col(f"{digest}.values"), c), F.lit(MASK)
            ).otherwise(c),
        ),
        lambda between, c: F.concat(between, F.coalesce(c, F.lit(""))),
    )
    clean = F.col(digest).isNull()
    out = joined.withColumn("text", F.when(clean, F.col("text")).otherwise(F.concat_ws("", masked)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(clean, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)
