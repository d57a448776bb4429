"""The text operators against plain versions, and the cases their docstrings define."""

import collections
import gzip
import hashlib
import html
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slotwise.llm import decontaminate, embedding, minhash, mixing, pii, queries, secrets, suffix, template, toxicity, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, copy string, node string"


def docs(spark, *texts, ids=None):
    """Documents with extra columns whose names the operators use themselves."""
    ids = ids if ids is not None else range(len(texts))
    data = [(i, t, "en", "src0", len(t or ""), "s", "c", "n") for i, t in zip(ids, texts, strict=True)]
    return spark.createDataFrame(data, DOCS)


def words(n, start=0):
    return " ".join(f"word{i}" for i in range(start, start + n))


ODD = [None, "", "a", " \n", words(40), words(40), "ü" * 3000]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, 1, i % 2) for i in range(8)] + [(None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")


# ---- odd rows: every operator keeps its promise on nulls, empty and repeated rows, empty tables ----


def test_odd_rows(spark, labels):
    odd = docs(spark, *ODD, ids=[1, 2, 3, 4, 5, 5, None])
    none = odd.limit(0)
    bench = spark.createDataFrame([(1, None), (2, ""), (3, words(20, 5)), (3, words(20, 5)), (None, "x")], "item_id long, text string")
    assert toxicity.score_documents(odd, labels).count() == len(ODD)
    assert toxicity.score_documents(none, labels.limit(0)).count() == 0
    assert minhash.classes(odd).count() == len(ODD)
    assert minhash.classes(none).count() == 0
    assert {r.doc_id for r in decontaminate.find(odd, bench).collect()} == {5}
    assert decontaminate.find(odd, bench.limit(0)).count() == 0
    assert decontaminate.find(none, bench).count() == 0
    assert secrets.secrets(odd).count() == 0
    assert secrets.mask_secrets(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert pii.find(odd).count() == len(ODD)
    removed = {(r.doc_id, r.n_removed) for r in suffix.remove_repeats(odd).collect()}
    assert (5, len(words(40))) in removed and (1, 0) in removed and (None, 6000) in removed
    assert suffix.remove_repeats(none).count() == 0


def test_stages_keep_the_columns(spark, labels):
    given = docs(spark, words(40), words(40), None, "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" " + words(3))
    bench = spark.createDataFrame([(1, words(20, 900))], "item_id long, text string")
    for out in (
        toxicity.drop_toxic(given, labels), minhash.keep_one(given),
        decontaminate.drop_contaminated(given, bench), secrets.mask_secrets(given),
    ):
        assert out.columns == given.columns
    assert sorted(r.doc_id for r in minhash.keep_one(given).collect()) == [0, 2, 3]


# ---- 1 secrets ----


def test_secrets_and_lookalikes(spark):
    real = "the token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" here"
    given = docs(spark, real, "commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff done", "card 4785380592391139 ok", words(30))
    assert [r.doc_id for r in secrets.secrets(given).collect()] == [0]
    masked = {r.doc_id: (r.text, r.n_chars) for r in secrets.mask_secrets(given).collect()}
    assert masked[0][0] == 'the token = "[secret]" here' and masked[0][1] == len(masked[0][0])
    assert masked[1][0].startswith("commit 24be")


def test_unquoted_values_behind_an_equals_sign(spark):
    key = "24be64439e3e49cf46b2d7c90f3602a3"
    forms = [
        f"export API_KEY={key}\nnext", f"see https://h.example/a?token={key}&x=1 ok", f"password={key}",
        f"MY_SERVICE_2_API_KEY={key} set", f'the token = "{key}" here',
    ]
    others = [f"commit={key} done", f"see https://h.example/a?commit={key}&x=1 ok", f"md5={key}"]
    given = docs(spark, *forms, *others)
    found = secrets.candidates(given).where(F.col("candidate") == key)
    assert {r.doc_id for r in found.collect()} == set(range(len(forms + others)))
    masked = {r.doc_id: r.text for r in secrets.mask_secrets(given).collect()}
    # The long name of form 3 is a candidate of its own, and may be masked too.
    assert all(masked[i] == forms[i].replace(key, "[secret]") for i in (0, 1, 2, 4)) and masked[3].endswith("=[secret] set")
    assert [masked[i] for i in range(len(forms), len(masked))] == others
    padded = docs(spark, "token: dGhpcyBpcyBhIHRlc3Q0NTY3OA== end")
    assert [r.candidate for r in secrets.candidates(padded).collect()] == ["dGhpcyBpcyBhIHRlc3Q0NTY3OA=="]


# ---- 2 WARC ----


def test_warc_round_trip_and_pushdown(spark, folder):
    pages = spark.createDataFrame(
        [(1, "http://a/", "<p>x</p>"), (2, "http://b/", "<p>x</p>"), (3, "http://c/", None), (4, None, "ü\r\n\r\nWARC/1.1")],
        "page_id long, url string, html string",
    )
    path = folder("warc")
    warc.write(warc.page_records(pages), path)
    back = {r.record_id: r for r in warc.read(spark, path).collect()}
    assert back["<urn:page:1>"].record_type == "revisit" and back["<urn:page:1>"].refers_to == "<urn:page:2>"
    assert bytes(back["<urn:page:4>"].payload).decode() == "ü\r\n\r\nWARC/1.1"
    assert bytes(back["<urn:page:3>"].payload) == b""
    only = warc.read(spark, path, payload=False).where("record_type = 'revisit' and target_uri like 'http://a%'")
    assert [(r.record_id, r.payload) for r in only.collect()] == [("<urn:page:1>", None)]
    assert warc.archived(pages.limit(0)).count() == 0


def test_foreign_warc(spark, tmp_path):
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(record * 2)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(record) + gzip.compress(record))
    assert [bytes(r.payload) for r in warc.read(spark, str(tmp_path)).collect()] == [b"hello"] * 4


# ---- 3 HTML ----


def test_main_text(spark):
    page = "<html><head><title>t</title></head><body><nav>menu</nav><div class='ad'>buy</div><article><h1>H &amp; {0}</h1><p><b>one\n two<br><p>three {0}</p><aside>no</aside><div class=\"comments\"><p>me too</p></div></article><footer>f</footer>"
    rows = [(i, f"http://h/{i}", page.format(words(30, i * 50))) for i in range(4)] + [(9, None, None), (10, "x", "")]
    got = {r.page_id: r for r in template.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == f"H & {words(30, 50)}\none two\nthree {words(30, 50)}" and got[1].n_chars == len(got[1].text)
    assert got[9].text == got[10].text == ""


def test_main_text_of_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r.text for r in queries.QUERIES["op3_template"](spark, SF).collect()}
    for p in pages:
        inside = p.html[p.html.index("<article>") + 9 : p.html.index("</article>")]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert got[p.page_id] == "\n".join(b for b in blocks if b)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p class=notice>buy<p>one</p><p>two</p></article>", "one\ntwo"),
        ("<article><ul><li class=share>us<li>one</ul><p>two</article>", "one\ntwo"),
        ("<article><div><p class='ad'>buy</div>one<p>two</p></article>", "one\ntwo"),
        ("<body><nav><ul><li>menu</ul><article><p>one<p>two</article></body>", "one\ntwo"),
        ("<body><header>top<div id=content><p>one</p>two</div></body>", "one\ntwo"),
        ("<html><head><title>t</title><body><p>one<p>two", "one\ntwo"),
        ("<table><tr><td class=sidebar>menu<td><p>one<tr><td>two</table>", "one\ntwo"),
        ("<article><nav><article><p>menu</article></nav><svg class=x /><p>one</p><p class=notice>buy <b>now</b></p>two</article>", "one\ntwo"),
    ],
)
def test_furniture_without_end_tags_leaves_the_rest(page, text):
    found = next((x for x in (template.blocks(page, "article"), template.blocks(page, None)) if x), [])
    assert "\n".join(found) == text


# ---- 4 toxicity ----


def test_toxicity_held_out(spark):
    """At sf0.1 the held-out rows reach 0.98; with the few labels here the ranking must still be clear."""
    scored = queries.QUERIES["op4_toxicity"](spark, "/root/testdata/sf0.01").collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    held = [(r.score, toxic[r.doc_id]) for r in scored if r.held_out and r.doc_id in toxic]
    pos, neg = [s for s, t in held if t], [s for s, t in held if not t]
    assert np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg]) > 0.8
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


# ---- 5 decontamination ----


def test_reparameterised_item_is_found_and_chance_is_not(spark):
    item = "A farmer from Ohio had 12 apples and gave Anna 5 of them before the market closed at noon"
    given = docs(
        spark, "Intro. " + item, "We read: a farmer from Utah had 31 apples and gave Betty 7 of them before the market closed at noon!",
        item.upper(), words(60), "a farmer had apples",
    )
    got = {r.doc_id: r for r in decontaminate.find(given, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()}
    assert set(got) == {0, 1, 2} and got[0].changed_slots == 0 and got[1].changed_slots > 0
    assert not decontaminate.consistent([([1, 2], [5, 6]), ([1], [6])])[0]


def held(spark, item, *texts):
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    return {r.doc_id: r for r in decontaminate.find(docs(spark, *texts), bench).collect()}


def test_conflicting_slots_leave_the_other_windows(spark):
    copied = words(25).translate(str.maketrans("0123456789", "abcdefghij"))
    got = held(spark, f"if x is 3 and y is 3 then {copied}", f"if x is 4 and y is 5 then {copied}", f"if x is 4 and y is 5 then {words(25)}")
    assert set(got) == {0} and got[0].covered >= 25
    both = held(spark, "we put 3 red balls and 5 blue balls into the old box", "we put 4 red balls and 4 blue balls into the old box")
    assert set(both) == {0} and both[0].changed_slots == 2
    # One value stands for two: only windows that agree with each other count.
    assert not decontaminate.consistent([([1, 1], [5, 6])])[0] and decontaminate.agreed([([1], [5]), ([1], [6]), ([1], [6])]) == {1: 6}


def test_items_rich_in_placeholders_are_found_with_other_values(spark):
    got = held(
        spark, "Tom rides 12 km in 3 hours and Ann rides 20 km in 4 hours", "Ben rides 15 km in 2 hours and Eva rides 30 km in 5 hours",
        "Intro " * 9 + ". We know that Ben rides 15 km in 2 hours and Eva rides 30 km in 5 hours. " + words(30), "Ben rides 15 km in 2 hours and sleeps",
    )
    assert set(got) == {0, 1} and got[0].changed_slots > 0
    # All five words stand in front: read back from the end.
    row = "add up all these lengths {} km {} km {} km {} km {} km {} km {} km {} km {} km"
    assert set(held(spark, row.format(*range(11, 20)), row.format(*range(31, 40)), " ".join(f"{i} km" for i in range(31, 40)))) == {0}


def test_longer_windows_against_plain_ones():
    rng = np.random.default_rng(4)
    for n in (0, 5, 8, 9, 60):
        given, fixed = rng.integers(1, 9, n).astype(np.uint64), rng.random(n) < 0.4
        values, start, end = decontaminate.longer(given, fixed, 30)
        want = set()
        for a in range(n):
            for b in range(a + 9, min(n, a + 30) + 1):
                if fixed[a:b].sum() == 5 and (fixed[b - 1] and fixed[a : a + 8].sum() < 5 or fixed[a] and fixed[b - 8 : b].sum() < 5):
                    want.add((a, b))
        assert set(zip(start.tolist(), end.tolist(), strict=True)) == want
        named = {int(v): given[a:b].tobytes() for v, a, b in zip(values, start, end, strict=True)}
        assert len(set(named.values())) == len(named)


# ---- 6 personal data ----


def test_base_spans_match_the_patterns(spark):
    text = "a@b.co x@y a.b+c@d-e.f.g 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111 1111 1111 +49 (30) 123-4567 1111 @.x +1"
    base = pii.base_spans(text)
    assert [text[a:b] for a, b in base["email"]] == [m.group() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert [text[a:b] for a, b in base["ip"]] == ["1.2.3.4", ".5.6.7.8"[1:]]
    assert base["phone"] and not pii.emails("x" * 50_000) and not pii.ips("1" * 50_000)


@pytest.mark.parametrize(
    ("text", "span"),
    [
        ("mail john.doe (at) example (dot) com now", "john.doe (at) example (dot) com"),
        ("joe at mail dot example dot org", "joe at mail dot example dot org"),
        ("ехample@mаil.com", "ехample@mаil.com"),
        ("ip 192 dot 168 dot 1 dot 20", "192 dot 168 dot 1 dot 20"),
        ("call plus four nine one seven zero one two three four", "plus four nine one seven zero one two three four"),
    ],
)
def test_disguises(text, span):
    found = pii.added_spans(text, pii.base_spans(text))
    assert [text[a:b] for v in found.values() for a, b in v] == [span]


def test_clean_text_gains_nothing():
    text = "we met at noon and stood at one table, two chairs, at home. dot"
    assert not any(pii.added_spans(text, pii.base_spans(text)).values())


# ---- 7 suffixes ----


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array(seed):
    data = np.random.default_rng(seed).integers(1, 4, 300).astype(np.uint8)
    order = suffix.suffix_array(data, 300)
    assert order.tolist() == sorted(range(300), key=lambda i: bytes(data[i:]))


def test_repeats_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    text = lambda n: "".join(rng.choice(list("abcé "), n))
    shared = text(260)
    given = [text(100) + shared + text(150), shared + text(90), text(300), "a" * 500, text(50) + shared[:210], text(30) + shared[5:], *["z" * 199] * 2]
    raw = [x.encode() for x in given]
    count = collections.Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
    for most in (1_500, 2):
        monkeypatch.setattr(suffix, "MOST", most)
        got = {r.doc_id: r for r in suffix.remove_repeats(docs(spark, *given)).collect()}
        for i, x in enumerate(raw):
            gone = np.zeros(len(x), bool)
            for a in range(len(x) - 199):
                if count[x[a : a + 200]] > 1:
                    gone[a : a + 200] = True
            kept = hashlib.sha256(np.frombuffer(x, np.uint8)[~gone].tobytes()).hexdigest()
            assert (got[i].n_removed, got[i].kept_sha256) == (gone.sum(), kept)


def check_repeats(spark, given):
    """The removed bytes are those of windows of 200 bytes that are at two places."""
    raw = [x.encode() for x in given]
    count = collections.Counter(x[i : i + 200] for x in raw for i in range(len(x) - 199))
    got = {r.doc_id: r for r in suffix.remove_repeats(docs(spark, *given)).collect()}
    for i, x in enumerate(raw):
        gone = np.zeros(len(x), bool)
        for a in range(len(x) - 199):
            if count[x[a : a + 200]] > 1:
                gone[a : a + 200] = True
        kept = hashlib.sha256(np.frombuffer(x, np.uint8)[~gone].tobytes()).hexdigest()
        assert (got[i].n_removed, got[i].kept_sha256) == (gone.sum(), kept)


def test_one_place_in_several_tasks_is_no_repeat(spark, monkeypatch):
    rng = np.random.default_rng(2)
    text = lambda n: "".join(rng.choice(list("abc "), n))
    shared = text(600)
    monkeypatch.setattr(suffix, "MOST", 2)
    monkeypatch.setattr(suffix, "TASK_BYTES", 300)
    check_repeats(spark, [text(150) + shared + text(150) for _ in range(12)])


def test_a_window_first_seen_by_an_unsplit_minimiser_has_its_digest():
    one = bytes(np.random.default_rng(3).integers(1, 255, 200).astype(np.uint8))
    for split in ([True, False], [False, True]):
        given = {"rid": [5, 5], "start": [0, 0], "copies": [1, 1], "split": split, "bytes": [one, one]}
        assert [(r["rid"], r["low"], r["alone"]) for r in suffix._sorted(pa.table(given)).to_pylist()] == [(5, 0, True)]


# ---- 8 mixing ----


def test_large_rates_and_weights(spark):
    rate = spark.range(300).select(mixing.poisson_count("s", F.col("id"), F.lit(2000.0)).alias("n"))
    assert abs(rate.agg(F.avg("n")).first()[0] - 2000) < 15
    given = spark.createDataFrame([(i, "t", "a" if i % 10 else "b") for i in range(2000)], "doc_id long, text string, source string")
    mixed = mixing.mix(given, {"a": 1, "b": 3}).groupBy("source").count().collect()
    shares = {r["source"]: r["count"] for r in mixed}
    assert abs(shares["b"] / sum(shares.values()) - 0.75) < 0.05


# ---- 9 near copies ----


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 60, 300).astype(np.uint64)
    a = np.unique(np.r_[base[:200], np.repeat(base[:30], 6)], return_counts=True)
    b = np.unique(np.r_[base[20:260], np.repeat(base[20:60], 3)], return_counts=True)
    signed = minhash.signatures([a, b], 3000)
    assert abs((signed[0] == signed[1]).mean() - minhash.overlap(a, b)) < 0.03


@pytest.mark.parametrize(("tile", "fan"), [(2_000, 16), (3, 2)])
def test_classes_against_brute_force(spark, monkeypatch, tile, fan):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "FAN", fan)
    given = spark.read.parquet(f"{SF}/documents.parquet")
    rows = given.collect()
    bags = [minhash.Shingler().bag(r.text) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if rows[i].text == rows[j].text or (len(bags[i][0]) and len(bags[j][0]) and minhash.overlap(bags[i], bags[j]) >= 0.8):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    least = {}
    for x, r in zip(label, rows, strict=True):
        least[x] = min(least.get(x, r.doc_id), r.doc_id)
    got = {r.doc_id: r.class_id for r in minhash.classes(given).collect()}
    assert got == {r.doc_id: least[x] for x, r in zip(label, rows, strict=True)}


def test_bound_of_the_overlap_is_never_below_it():
    texts = [" ".join(f"w{(i * k) % 90}" for i in range(n)) for k, n in ((7, 60), (7, 50), (11, 60), (1, 400), (1, 390), (7, 6))]
    batch = pa.RecordBatch.from_arrays([pa.array([bytes([i]) for i in range(len(texts))]), pa.array(texts)], names=["node", "text"])
    (made,) = minhash._bags([batch])
    maps = np.frombuffer(b"".join(made["map"].to_pylist()), np.uint64).reshape(len(texts), -1)
    size, bags = made["size"].to_numpy(), [minhash.Shingler().bag(t) for t in texts]
    for i in range(len(texts)):
        bound = minhash.most_overlap(maps[[i] * len(texts)], maps, size[i], size)
        assert all(bound[j] >= minhash.overlap(bags[i], bags[j]) - 1e-12 for j in range(len(texts)))
    equal = np.random.default_rng(1).random((50, minhash.COMPONENTS)) < 0.7
    assert (minhash._true_bytes(equal) == equal.sum(1)).all()


# ---- 10 embeddings ----


def test_single_precision_rules_out_most_pairs_and_no_near_one():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 64))
    x[300:] = x[:300] + rng.normal(size=(300, 64)) * np.linspace(0, 0.5, 300)[:, None]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cut, share = embedding.blocks_of(64)[0], embedding.shares(64, 0.9)[0]
    first, second = embedding._lifted(x[:, cut], share)
    left = first @ second.T >= -embedding.ROUGH * first.shape[1]
    near = ((x[:, None, cut] - x[None, :, cut]) ** 2).sum(2) <= share
    assert first.dtype == np.float32 and left[near].all() and left.mean() < 0.02


@pytest.mark.parametrize("sizes", [(6_000, 3_000), (40, 25)])
def test_links_against_brute_force(spark, monkeypatch, sizes):
    monkeypatch.setattr(embedding, "CELL", sizes[0])
    monkeypatch.setattr(embedding, "TILE", sizes[1])
    rng = np.random.default_rng(3)
    heart = rng.normal(size=64)
    vectors = [(heart + rng.normal(size=64) * s).tolist() for s in np.linspace(0, 0.9, 150)] + rng.normal(size=(60, 64)).tolist()
    vectors += [vectors[0], (2 * np.array(vectors[0])).tolist(), [0.0] * 64, None, [float("nan")] * 64, [1.0]]
    rows = [(i, v, "x") for i, v in enumerate(vectors)] + [(None, vectors[0], "x")]
    got = {r.vec_id: r for r in embedding.near(spark.createDataFrame(rows, "vec_id long, embedding array<double>, links string")).collect()}
    x = np.array([v for v in vectors if v and len(v) == 64 and np.isfinite(v).all() and any(v)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    assert [got[i].n_links for i in range(len(x))] == close.sum(1).tolist()
    label = np.arange(len(x))
    while not (label == (new := np.minimum(label, np.where(close, label, len(x)).min(1)))).all():
        label = new
    assert [got[i].component_id for i in range(len(x))] == label.tolist()
    assert got[None].kept and got[len(vectors) - 1].n_links == 0


def near_by_brute_force(rows):
    """(n_links, component_id) by id, for rows of vectors that all can link and ids that differ."""
    unit = {i: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) for i, v in rows}
    tied = {i: {j for j in unit if j != i and len(unit[j]) == len(unit[i]) and unit[i] @ unit[j] >= 0.9} for i in unit}
    least = {i: i for i in unit}
    while (new := {i: min([least[i], *(least[j] for j in tied[i])]) for i in unit}) != least:
        least = new
    return {i: (len(tied[i]), least[i]) for i in unit}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_cells_chunks_and_tasks_against_brute_force(spark, monkeypatch, kind):
    for name, value in {"CELL": 30, "TILE": 20, "PART_BYTES": 4_000, "SLAB": 7, "PAIRS": 50}.items():
        monkeypatch.setattr(embedding, name, value)
    rng, batch = np.random.default_rng(8), spark.conf.get(embedding.BATCH)
    vectors = []
    for dimensions, centres, spread in ((40, 9, 0.15), (100, 2, 0.05), (3, 30, 0.3), (1, 3, 0.2)):
        hearts = rng.normal(size=(centres, dimensions))
        vectors += (hearts[rng.integers(centres, size=120)] + rng.normal(size=(120, dimensions)) * spread).astype(np.float32).tolist()
    # Copies within a chunk, over batches, and of other lengths.
    vectors += [vectors[0]] * 60 + [[4 * c for c in vectors[0]], [3 * c for c in vectors[0]], [0.0] * 39 + [1.0]]
    rows = [(1_000 - i, v) for i, v in enumerate(vectors)]
    given = spark.createDataFrame([*rows, (2_000, [0.0] * 40), (None, vectors[0])], f"vec_id long, embedding array<{kind}>").repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding.near(given).collect()}
    assert spark.conf.get(embedding.BATCH) == batch
    assert got.pop(None) == (0, None, True) and got.pop(2_000) == (0, 2_000, True)
    assert got == {i: (n, c, i == c) for i, (n, c) in near_by_brute_force(rows).items()}


def test_disk_does_not_grow_with_the_pairs_of_cells(spark, monkeypatch, folder):
    """Vectors were copied for every tile they met in: 27 times the input at 20 MB, and more the more cells."""
    from slotwise.sources.scratch import shared_folder

    monkeypatch.setattr(embedding, "CELL", 100)
    monkeypatch.setattr(embedding, "TILE", 100)
    x = np.random.default_rng(9).normal(size=(6_000, 64)).astype(np.float32)
    given = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    given.write.parquet(path := folder("embeddings"))
    places = [Path(shared_folder(spark)), *map(Path, spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())]
    used = lambda: sum(f.stat().st_size for p in places for f in p.rglob("*") if f.is_file())
    before = used()
    assert embedding.near(spark.read.parquet(path)).where("n_links = 0").count() == len(x)
    grown = used() - before
    assert grown < 4 * x.nbytes, grown / x.nbytes


def test_links_merge_into_the_smallest_member():
    rng = np.random.default_rng(6)
    label, links = np.arange(300), rng.integers(300, size=(400, 2))
    for part in np.split(links, 8):
        embedding.merged(label, part[:, 0], part[:, 1])
    plain = np.arange(300)
    for _ in range(300):
        for a, b in links:
            plain[a] = plain[b] = min(plain[a], plain[b])
    assert label.tolist() == plain.tolist()


def test_far_chunks_and_vectors_are_not_compared_and_near_ones_are():
    rng = np.random.default_rng(7)
    pivots = np.linalg.qr(rng.normal(size=(64, 2)))[0].T
    x = np.r_[pivots[0] + rng.normal(size=(60, 64)) * 0.02, pivots[1] + rng.normal(size=(60, 64)) * 0.02, pivots.sum(0) + rng.normal(size=(40, 64)) * 0.01]
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    home = (x @ pivots.T).argmax(1)
    one, two = (embedding.Chunk(x[home == k].tobytes(), "<f8", embedding._leading(x), 0.9) for k in (0, 1))
    plane = (pivots[0] - pivots[1]) / np.linalg.norm(pivots[0] - pivots[1])
    near = one.units @ two.units.T >= 0.9
    found = np.zeros_like(near)
    for a, b in embedding.linked(one, two, 0.9, plane):
        found[a, b] = True
    assert near.any() and (found == near).all()
    only = [embedding.Chunk(x[k : k + 60].tobytes(), "<f8", embedding._leading(x), 0.9) for k in (0, 60)]
    assert not list(embedding.linked(*only, 0.9, plane))


# ---- pipeline ----


def test_pipeline_against_plain_steps(spark):
    """Each stage's decisions, recomputed on that stage's input; and the last result's sources and copies."""
    import corpus_pipeline as p

    given = spark.read.parquet(f"{SF}/documents.parquet")
    near = p.drop_near_copies(spark, given, SF)
    heads = {r.class_id for r in minhash.classes(given).collect()}
    assert {r.doc_id for r in near.collect()} == heads
    bench = [" " + " ".join(re.findall(r"\w+", r.text.lower())) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in near.collect() if not any(b in " " + " ".join(re.findall(r"\w+", r.text.lower())) + " " for b in bench)}
    kept = p.drop_contaminated(spark, near, SF)
    assert {r.doc_id for r in kept.collect()} == clean
    masked = p.mask_secrets(spark, kept, SF)
    assert not [r for r in masked.collect() if re.search(r"token = \"[0-9a-f]{40}", r.text)]
    assert [n for n, _ in p.STAGES] == ["toxicity", "minhash", "decontamination", "secrets", "mixing"]
