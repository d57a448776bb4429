"""Input that once hung, crashed or slipped through."""

import gzip
import time

import pytest

from slotwise.llm import decontaminate, pii, toxicity, warc

N = 100_000


# ---- long texts made to trap patterns ----

TRAPS = {
    "brackets": "one two x one" + " ( " * (N // 3) + "x",
    "blanks": "a" + " " * N + "b",
    "tabs": "a (at) b " + "\t" * N + "b",
    "open": "(" * N,
    "open blanks": "( " * (N // 2),
    "dashes": "one" + "-" * N + "two",
    "commas": "one" + ", " * (N // 2) + "x",
    "digits": "one " + "1" * N + "x",
    "digit words": "one " * (N // 4) + "x",
    "short runs": "one two three x " * (N // 16),
    "doubles": "double " * (N // 7),
    "plus": "+ " * (N // 2),
    "plus words": "plus one " * (N // 9),
    "at": "x at " * (N // 5),
    "at dot": "x at dot " * (N // 9),
    "dots": "x dot " * (N // 6) + " at ",
    "one host": "a@b" + " dot c" * (N // 6),
    "hosts": "a@b dot c " * (N // 10),
    "labels": "x at " + "a." * (N // 2),
    "ats": "@" * N + " (at) ",
    "local": "a." * (N // 2) + " (at) b",
    "numbers": "1 dot " * (N // 6),
    "phones": "+1" + " " * N,
    "many spans": "a (at) b.c, d@e.f " * (N // 18),
    "homoglyphs": "а" * N,
}


@pytest.mark.parametrize("trap", TRAPS)
def test_patterns_stay_linear(trap):
    begun = time.process_time()
    text = TRAPS[trap]
    pii.added_spans(text, pii.base_spans(text))
    assert time.process_time() - begun < 1.5


def test_a_long_host_keeps_its_tail():
    host = " dot ".join(f"label{i}" for i in range(60))
    text = f"mail me@{host} dot org now"
    assert pii.added_spans(text, pii.base_spans(text))["email"] == [(5, len(text) - 4)]


def test_added_spans_do_not_overlap():
    text = "a (at) b.c (at) d.e (at) f.g 1 dot 2 dot 3 dot 4"
    base = pii.base_spans(text)
    for spans in pii.added_spans(text, base).values():
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))


# ---- damaged archives ----

RECORD = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


@pytest.mark.parametrize(
    ("name", "data"),
    [
        ("payload.warc", RECORD.replace(b"Content-Length: 5", b"Content-Length: 500")),
        ("headers.warc", RECORD[:40]),
        ("cut.warc.gz", gzip.compress(RECORD)[:-10]),
        ("sum.warc.gz", gzip.compress(RECORD)[:-8] + b"\0\0\0\0" + gzip.compress(RECORD)[-4:]),
    ],
)
def test_damaged_foreign_archives_fail(spark, tmp_path, name, data):
    (tmp_path / name).write_bytes(data)
    with pytest.raises(Exception, match="(?i)ends inside|end-of-stream|CRC"):
        warc.read(spark, str(tmp_path)).collect()


def test_damaged_own_archives_fail(spark, tmp_path):
    path = str(tmp_path / "own")
    pages = spark.createDataFrame([(1, "http://a/", "<p>x</p>")], "page_id long, url string, html string")
    warc.write(warc.page_records(pages), path)
    file = max((tmp_path / "own").glob("*.warc.gz"), key=lambda f: f.stat().st_size)
    whole = file.read_bytes()
    assert warc.read(spark, path).count() == 1
    for damaged in (whole[:-6], whole[:-8] + bytes([whole[-8] ^ 1]) + whole[-7:], whole[:25]):
        file.write_bytes(damaged)
        with pytest.raises(Exception, match="ends inside|check sum|size"):
            warc.read(spark, path).collect()
    file.write_bytes(whole[:-6])
    with pytest.raises(Exception, match="ends inside a payload"):
        warc.read(spark, path, payload=False).collect()


# ---- rows without id, or with another's ----

DOCS = "doc_id long, text string, lang string, held string, score string, __raw string, __margin double, given0 string"


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, "en", "h", "s", "r", 2.5, "g") for i, t in rows], DOCS)


def test_contaminated_rows_go_whatever_their_id(spark):
    item = " ".join(f"benchmark{i}" for i in range(20))
    clean = " ".join(f"other{i}" for i in range(20))
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    given = docs(spark, (None, item), (None, clean), (3, item), (3, clean), (None, None), (4, ""), (5, item + " x"), (6, "y " + item))
    kept = decontaminate.drop_contaminated(given, bench)
    assert kept.columns == given.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (0, clean), (3, clean), (4, "")]
    assert {r.doc_id for r in decontaminate.find(given, bench).collect()} == {None, 3, 5, 6}
    assert decontaminate.drop_contaminated(given, bench.limit(0)).count() == 8


def test_toxicity_keeps_columns_named_like_its_own(spark):
    rows = [(i, f"you are worthless and stupid {i}" if i % 2 else f"a quiet morning by the river {i}") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    given = docs(spark, *rows)
    kept = toxicity.drop_toxic(given, labels)
    assert kept.columns == given.columns
    got = kept.collect()
    assert {r["__margin"] for r in got} == {2.5} and {r.held for r in got} == {"h"} and {r.score for r in got} == {"s"}
    assert {r.doc_id % 2 for r in got} == {0} and len(got) == 40
    assert toxicity.drop_toxic(given, labels.limit(0)).count() == 80
