"""The main text by templates: layouts, nested pairs and fixed blocks on pages without any telling names."""

import pytest

from slotwise.llm import template

PAGES = "page_id long, url string, html string, host string, slots string, path string"
MENU = "<div><a href=/a>Home</a> <a href=/b>About</a></div>"


def words(n, start):
    return " ".join(f"w{i}" for i in range(start, start + n))


def texts(spark, pages, url="http://h.example/{}"):
    rows = [(i, url.format(i), p, "h", "s", "p") for i, p in enumerate(pages)]
    return {r.page_id: r.text for r in template.main_text(spark.createDataFrame(rows, PAGES)).collect()}


def test_fixed_blocks_leave_the_text(spark):
    page = "<html><body>{menu}<div class=x><h1>Title {i}</h1><p>{a}</p><p>{b}</p><p>Copyright 2024 Some House</p></div><div class=y>Imprint</div></body></html>"
    pages = [page.format(menu=MENU, i=i, a=words(40, i * 100), b=words(20, i * 100 + 50)) for i in range(16)]
    got = texts(spark, pages)
    assert got == {i: f"Title {i}\n{words(40, i * 100)}\n{words(20, i * 100 + 50)}" for i in range(16)}


def test_two_layouts_of_a_host(spark):
    one = "<body>{menu}<div class=l1><div><p>{a}</p></div><div>Links A B C</div></div></body>"
    two = "<body><div class=k2>Links A B C</div><div class=k3><h2>News {i}</h2><div class=k4><p>{a}</p></div></div>{menu}</body>"
    pages = [(one if i % 3 else two).format(menu=MENU, i=i, a=words(30, i * 100)) for i in range(45)]
    got = texts(spark, pages)
    assert got == {i: words(30, i * 100) if i % 3 else f"News {i}\n{words(30, i * 100)}" for i in range(45)}


def test_varying_text_beside_the_main_slot_goes(spark):
    page = "<body><div id=p{i}><div class=q1>{few}</div><div class=q2><p>{a}<p>{b}</div><div class=q3>{few}</div></div></body>"
    pages = [page.format(i=i, few=words(5, i * 100 + 90), a=words(30, i * 100), b=words(30, i * 100 + 40)) for i in range(16)]
    assert texts(spark, pages) == {i: f"{words(30, i * 100)}\n{words(30, i * 100 + 40)}" for i in range(16)}


def test_copies_are_no_template(spark):
    # Every page says the same: nothing tells the text from a template, so it stays.
    pages = [f"<body><article><h1>T</h1><p>{words(50, 0)}</p></article></body>"] * 20
    assert set(texts(spark, pages).values()) == {f"T\n{words(50, 0)}"}


def test_passages_on_some_pages_stay(spark):
    page = "<body><div class=a><p>{a}</p>{shared}</div></body>"
    pages = [page.format(a=words(40, i * 100), shared="<p>a passage of many pages</p><p>and its second part</p>" if i % 2 else "") for i in range(40)]
    got = texts(spark, pages)
    assert all(("passage" in got[i]) == (i % 2 == 1) for i in got) and all(words(40, i * 100) in got[i] for i in got)


def test_odd_rows(spark):
    frame = spark.createDataFrame([(1, None, None), (None, "x", "<p>a"), (None, "x", "<p>a"), (3, "http://h", "<div>" * 3000 + "t" * 200_000)], "page_id long, url string, html string")
    got = sorted((r.page_id or 0, r.text[:1], r.n_chars) for r in template.main_text(frame).collect())
    assert got == [(0, "a", 1), (0, "a", 1), (1, "", 0), (3, "t", 200_000)]
    assert template.main_text(frame.limit(0)).count() == 0


@pytest.mark.parametrize("path", ["<div><div>a</div><div>b</div></div>", "<nav><ul><li>x<article>a</article></ul><div>b</div>"])
def test_paths_tell_siblings_apart(path):
    places, found = template.walk(path)
    assert [b.text for b in found] == ["a", "b"] and len({b.place.path for b in found}) == 2
