"""Main text of web pages by equivalence classes of tokens.

Tokens are the tags of elements, told apart by their path from the root (with the position among equal
siblings where elements hold others), and whole blocks of text, told apart by the element they stand in.  Over
the pages of a host, tokens with equal occurrence vectors form an equivalence class: those of one layout occur
on just the pages of that layout, so layouts need no names.  A class is valid if its opening and closing tags
pair up once a page on pages with different texts; the pairs nest by their paths into the host's template.
Blocks on nearly all pages of the pair they stand in belong to the template too.  What remains in the innermost
slot that holds most of the remaining text of its pages is extracted, without the parts that are page furniture.
"""

from __future__ import annotations

import html as htmllib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.llm.common import stored
from slotwise.operators.sizing import broadcast_if_small

# A block belongs to the template if it is on this share of the pages of its slot; the main slot holds this share
# of the text.  A token counts if it is on pages of so many different texts, and on this share of the host's pages:
# a template has at most 1 / FREQUENT times as many tokens as a page.
SUPPORT = 0.9
SHARE = 0.5
LEAST = 5
FREQUENT = 0.02
# Counts kept in a task before they are passed on.
HELD = 200_000

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|</?[A-Za-z][^<>\s/]*(?:\"[^\"]*\"|'[^']*'|[^'\">])*>|[^<]+|<", re.S)
TAG = re.compile(r"</?\s*([A-Za-z][A-Za-z0-9:-]*)")
MARK = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
# Elements whose content is code, elements that hold page furniture, and marks of such parts.
RAW = frozenset(("script", "style", "noscript", "template", "svg", "iframe", "textarea", "title", "math", "object"))
FURNITURE = frozenset(("nav", "header", "footer", "aside", "form", "menu", "button", "select", "dialog", "head")) | RAW
MARKED = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|adv|advert\w*|banner|sponsor\w*|promo\w*|cookie\w*|consent|notice|alert|sidebar|side|menu|nav\w*|"
    r"breadcrumb\w*|comment\w*|reply|replies|disqus|share|social|related|recommend\w*|footer|header|masthead|popup|modal|"
    r"newsletter|subscribe|login|signup|search|pagination|pager|toolbar|widget|navigation|complementary|contentinfo)(?:[\s_-]|$)",
    re.I,
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul caption".split()
)


# Elements that may be a main slot; others hold a single block or part of one.
CONTAINERS = frozenset(("article", "main", "section", "div", "td", "center"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


# Fixed values of HTML: elements that may lack an end tag, what begins after them, and where looking for them stops.
_ENDS_P = BLOCKS - frozenset("body caption dd dt html legend li option tbody td tfoot th thead tr".split())
_LIST, _ROW = frozenset("ul ol menu dl table td th article section aside nav main header footer form blockquote body".split()), frozenset(("table",))
IMPLIED = {name: ((frozenset(("p",)), frozenset("button table td th caption body".split())),) for name in _ENDS_P | {"li", "dt", "dd"}}
for _names, _ends, _stop in (
    ("li", "li", _LIST), ("dt dd", "dt dd", _LIST), ("option", "option", frozenset(("select",))), ("optgroup", "option optgroup", frozenset(("select",))),
    ("td th", "td th", _ROW), ("tr", "tr td th", _ROW), ("tbody thead tfoot", "tr td th tbody thead tfoot caption", _ROW), ("body", "head", frozenset()),
):
    for _name in _names.split():
        IMPLIED[_name] = ((frozenset(_ends.split()), _stop), *IMPLIED.get(_name, ()))
OPTIONAL = frozenset("p li dt dd td th tr thead tbody tfoot caption option optgroup head body html".split())
HEADS = frozenset("title meta link base script style noscript template".split())
# An end tag inside a cell does not reach out of it; what begins the text behind furniture that is never closed.
CELLS, OF_TABLES = frozenset("td th caption table".split()), frozenset("td th caption table tr tbody thead tfoot html body".split())
FLOW = frozenset("article main section div h1 p".split())


class Tag:
    __slots__ = ("closing", "ended", "implied", "key", "name", "skipped", "step")

    def __init__(self, text: str, implied: bool = False) -> None:
        found = TAG.match(text)
        self.name = found.group(1).lower() if found else ""
        self.closing = text.startswith("</")
        self.ended, self.implied = text.endswith("/>"), implied
        marks = "" if self.closing else " ".join(sorted(f"{k.lower()}={a or b or c}" for k, a, b, c in MARK.findall(text)))
        self.key = f"{self.name}|{marks}" if marks else self.name
        # Numbers in marks count pages and parts; they do not tell layouts apart.
        self.step = re.sub(r"\d+", "#", self.key)
        values = " ".join(x.partition("=")[2] for x in marks.split(" ")) if marks else ""
        self.skipped = self.name in FURNITURE or (self.name not in ("html", "body", "article", "main") and bool(MARKED.search(values)))


# Tags recur; they are never changed.
tag = lru_cache(maxsize=4096)(Tag)


def events(page: str) -> Iterator[tuple[str, Tag | str]]:
    """("open" | "close" | "text", what) in page order; comments and the content of code elements are left out."""
    raw, low = None, None
    for m in TOKEN.finditer(page):
        piece = m.group()
        if raw is not None:
            # Inside code only its own end counts, wherever in a piece it stands.
            if piece.startswith("</") and piece[2 : 2 + len(raw)].lower() == raw:
                yield "close", tag(piece)
                raw = None
            continue
        if piece.startswith(("<!", "<?")):
            continue
        if piece[0] == "<" and len(piece) > 1:
            low = tag(piece)
            if not low.name:
                continue
            yield ("close" if low.closing else "open"), low
            if not low.closing and low.name in RAW and not piece.endswith("/>"):
                raw = low.name
        else:
            yield "text", piece


def balanced(page: str) -> list[tuple[str, Tag | str]]:
    """The events of the page with the ends that HTML implies put in; end tags of nothing open are left out.

    Furniture that lacks an end tag it must have ends where text begins behind it (FLOW), or with its parent.
    """
    out: list[tuple[str, Tag | str]] = []
    # Open elements: tag, and where in ``out`` the first of FLOW inside furniture is.
    stack: list[list] = []
    furniture: list[list] = []
    # How many of each name are open: most names need no search.
    opened: dict[str, int] = {}
    cuts: list[tuple[int, str]] = []

    def close(low: int, own: Tag | None) -> None:
        """Ends the open elements from ``low`` on; ``own`` is the end tag of that one."""
        while len(stack) > low:
            ended, flow = entry = stack.pop()
            opened[ended.name] -= 1
            if furniture and furniture[-1] is entry:
                furniture.pop()
            if own is not None and len(stack) == low:
                out.append(("close", own))
            elif ended.skipped and ended.name not in OPTIONAL and flow is not None:
                cuts.append((flow, ended.name))
            else:
                out.append(("close", tag(f"</{ended.name}>", implied=True)))

    for kind, what in events(page):
        if kind == "text":
            out.append((kind, what))
            continue
        name = what.name
        if kind == "close":
            if name == "p" and not opened.get(name):
                # Alone it is an empty paragraph.
                out.append((kind, what))
            stop = frozenset() if name in OF_TABLES else CELLS
            for at in range(len(stack) - 1, -1, -1) if opened.get(name) else ():
                if stack[at][0].name == name:
                    close(at, what)
                    break
                if stack[at][0].name in stop:
                    break
            continue
        if stack and stack[-1][0].name == "head" and name not in HEADS:
            close(len(stack) - 1, None)
        for ends, stop in IMPLIED.get(name, ()):
            found = None
            for at in range(len(stack) - 1, -1, -1) if any(map(opened.get, ends)) else ():
                if stack[at][0].name in ends:
                    found = at
                elif stack[at][0].name in stop:
                    break
            if found is not None:
                close(found, None)
        if name in FLOW:
            for entry in furniture:
                if entry[1] is None:
                    entry[1] = len(out)
        out.append((kind, what))
        if name in VOID:
            continue
        stack.append([what, None])
        opened[name] = opened.get(name, 0) + 1
        if what.skipped:
            furniture.append(stack[-1])
        if what.ended and name in RAW:
            close(len(stack) - 1, None)
    close(0, None)
    if cuts:
        at: dict[int, list[str]] = {}
        for place, name in cuts:
            at.setdefault(place, []).append(name)
        out = [e for i, x in enumerate(out) for e in (*(("close", tag(f"</{n}>", implied=True)) for n in at.get(i, ())), x)]
    return out


def hashed(text: str) -> int:
    """64 bits of a hash as a signed number."""
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


@lru_cache(maxsize=65536)
def path_id(parent: int, step: str) -> int:
    return hashed(f"{parent}>{step}")


class Place:
    """An open element of a page: its path, what it stands in, and the nearest element around it that may be a slot."""

    __slots__ = ("closed", "container", "depth", "kids", "parent", "path", "tag")

    def __init__(self, parent: Place | None, what: Tag | None) -> None:
        self.parent, self.tag, self.kids, self.closed = parent, what, {}, False
        if parent is None:
            self.path, self.depth, self.container = 0, 0, self
            return
        step, holds = what.step, what.name in CONTAINERS
        if holds:
            nth = parent.kids[step] = parent.kids.get(step, 0) + 1
            step = f"{step}[{nth}]"
        self.path, self.depth = path_id(parent.path, step), parent.depth + 1
        self.container = self if holds else parent.container

    def around(self) -> Iterator[Place]:
        """This element and those around it, the page itself excepted."""
        here = self
        while here.parent is not None:
            yield here
            here = here.parent


class Block:
    __slots__ = ("heading", "id", "place", "text")

    def __init__(self, text: str, place: Place) -> None:
        self.text, self.place = text, place
        self.heading = any(p.tag.name in HEADINGS for p in place.around())
        self.id = hashed(f"{place.container.path}:{text}")


def walk(page: str) -> tuple[list[Place], list[Block]]:
    """The elements that may be slots and the blocks of text of a page, both in page order, furniture left out."""
    places: list[Place] = []
    out: list[Block] = []
    held: list[str] = []
    here = Place(None, None)
    began: Place | None = None
    skipping, depth = None, 0
    # Elements opened inside furniture that ended before them: their end tags end nothing outside.
    inner: dict[str, int] = {}
    orphans: dict[str, int] = {}

    def end() -> None:
        nonlocal began
        text = " ".join(htmllib.unescape("".join(held)).split()) if held else ""
        held.clear()
        if text:
            out.append(Block(text, began or here))
        began = None

    for kind, what in balanced(page):
        if kind == "text":
            if skipping is None:
                if began is None and not what.isspace():
                    began = here
                held.append(what)
            continue
        name = what.name
        if skipping is not None:
            if name == skipping:
                depth += 1 if kind == "open" else -1
                if depth == 0:
                    skipping = None
                    for k, n in inner.items():
                        if n > 0:
                            orphans[k] = orphans.get(k, 0) + n
            elif name not in VOID:
                inner[name] = inner.get(name, 0) + (1 if kind == "open" else -1)
            continue
        if kind == "open" and what.skipped and name not in VOID:
            end()
            skipping, depth, inner = name, 1, {}
            continue
        if name in BLOCKS:
            end()
        elif name == "br":
            held.append(" ")
        if name in VOID:
            continue
        if kind == "open":
            here = Place(here, what)
            if name in CONTAINERS:
                places.append(here)
            continue
        if here.tag is not None and here.tag.name != name and orphans.get(name):
            orphans[name] -= 1
            continue
        found = next((p for p in here.around() if p.tag.name == name), None)
        if found is not None:
            found.closed = not what.implied or name in OPTIONAL
            here = found.parent
    end()
    return places, out


def inside(blocks_: list[Block], test: Callable[[Place], bool]) -> list[Block]:
    """The blocks within an element for which ``test`` holds."""
    return [b for b in blocks_ if any(test(p) for p in b.place.around())]


def blocks(page: str, slot: str | None) -> list[str]:
    """Texts of the blocks of the elements whose name and marks are ``slot`` (the whole page for None)."""
    found = walk(page)[1]
    return [b.text for b in (found if slot is None else inside(found, lambda p: p.tag.key == slot))]


def by_name(found: list[Block]) -> list[Block]:
    """The blocks of the article or main element, plain ones first; of the whole page if there is none."""
    tests = [lambda p, n=n: p.tag.key == n for n in ("article", "main")] + [lambda p, n=n: p.tag.name == n for n in ("main", "article")]
    return next((some for some in (inside(found, t) for t in tests) if some), found)


# Kinds of tokens: the page itself, opening and closing tags, blocks of text.
PAGE, OPEN, CLOSE, TEXT = 0, 1, 2, 3
TOKENS = "host string, kind int, path long, other long, depth int, pages long, times long, vector long, chars long, heads long, total long, texts long"


def _token_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """TOKENS: partial sums over the pages of a task.

    ``vector`` joins a hash of (page, count) for each page by exclusive or: tokens with equal vectors and pages
    have equal occurrence vectors.  ``chars`` and ``heads`` count the words, and those of headings, inside a pair of
    tags or in a block, ``total`` those of the pages.  ``texts`` has a bit for the longest block of each page: so many bits
    are set, on so many pages of different texts the token is at least.  ``other`` is the path of the slot
    around a pair, or the hash of a block.
    """
    names = [x.split()[0] for x in TOKENS.split(", ")]
    types = [{"string": pa.string(), "int": pa.int32(), "long": pa.int64()}[x.split()[1]] for x in TOKENS.split(", ")]
    held: dict[tuple, list[int]] = {}

    def flush() -> pa.RecordBatch:
        columns = [*zip(*held), *zip(*held.values())] if held else [()] * len(names)
        batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        held.clear()
        return batch

    for batch in batches:
        for host, page_id, page in zip(*batch.columns, strict=True):
            host, page = host.as_py() or "", page.as_py() or ""
            places, found = walk(page)
            # Of each token: depth, times, words, words of headings.
            counts: dict[tuple[int, int, int], list[int]] = {(PAGE, 0, 0): [0, 1, 0, 0]}
            whole = counts[PAGE, 0, 0]
            for p in places:
                one = counts.setdefault((OPEN, p.path, p.parent.container.path), [p.depth, 0, 0, 0])
                one[1] += 1
                if p.closed:
                    counts.setdefault((CLOSE, p.path, 0), [p.depth, 0, 0, 0])[1] += 1
            longest = ""
            for b in found:
                words = len(b.text.split())
                heads = words if b.heading else 0
                longest = max(longest, b.text, key=len)
                own = counts.setdefault((TEXT, b.place.container.path, b.id), [0, 0, 0, 0])
                own[1] += 1
                sums = [own, whole]
                for p in b.place.around():
                    if p.container is p:
                        sums.append(counts[OPEN, p.path, p.parent.container.path])
                for one in sums:
                    one[2] += words
                    one[3] += heads
            name = f"{page_id.as_py()}:{hashed(page)}"
            bit = hashed(longest) & 63
            mask = (1 << bit) - (1 << 64 if bit == 63 else 0)
            hashes: dict[int, int] = {}
            for (kind, path, other), (depth, n, words, heads) in counts.items():
                value = hashes.get(n)
                if value is None:
                    value = hashes[n] = hashed(f"{name}:{n}")
                one = held.get((host, kind, path, other, depth))
                if one is None:
                    held[host, kind, path, other, depth] = [1, n, value, words, heads, whole[2], mask]
                    continue
                one[0] += 1
                one[1] += n
                one[2] ^= value
                one[3] += words
                one[4] += heads
                one[5] += whole[2]
                one[6] |= mask
            if len(held) >= HELD:
                yield flush()
    yield flush()


def template(tokens: list[dict]) -> tuple[list[int], list[int]]:
    """(paths of the main slots, hashes of the blocks that belong to the template) from the tokens of a host."""
    opened = {t["path"]: t for t in tokens if t["kind"] == OPEN}
    ends = {t["path"]: t for t in tokens if t["kind"] == CLOSE}
    pages = sum(t["pages"] for t in tokens if t["kind"] == PAGE)
    same = lambda t: (t["pages"], t["vector"])
    # Valid: the two tags of a pair are in one class, once on each of its pages.
    pairs = {p: t for p, t in opened.items() if t["times"] == t["pages"] and p in ends and same(ends[p]) == same(t)}
    on = {0: pages, **{p: t["pages"] for p, t in pairs.items()}}

    def around(path: int) -> Iterator[int]:
        while path in opened:
            yield path
            path = opened[path]["other"]

    fixed = [t for t in tokens if t["kind"] == TEXT and t["path"] in on and t["pages"] >= SUPPORT * on[t["path"]]]
    # Words of the template by the class they stand in: all and those of headings inside each pair, and a page's in all.
    within: dict[int, dict[tuple, list[int]]] = {}
    a_page: dict[tuple, float] = {}
    for t in fixed:
        key = same(pairs[t["path"]]) if t["path"] in pairs else ()
        a_page[key] = a_page.get(key, 0) + t["chars"] / t["pages"]
        for p in around(t["path"]):
            sums = within.setdefault(p, {}).setdefault(key, [0, 0])
            sums[0] += t["chars"]
            sums[1] += t["heads"]
    left = {}
    slots = set()
    for p, t in pairs.items():
        own = within.get(p, {})
        left[p] = t["chars"] - sum(n for n, _ in own.values()), t["heads"] - sum(n for _, n in own.values())
        # What is fixed on the pages of this pair: in its own class, in those around it, and inside it.
        classes = {(), *(same(opened[q]) for q in around(p))}
        words = sum(a_page.get(c, 0) for c in classes) * t["pages"] + sum(n for c, (n, _) in own.items() if c not in classes)
        if left[p][0] > 0 and left[p][0] >= SHARE * (t["total"] - words):
            slots.add(p)
    # A heading just outside belongs to the text: the pair around is the slot if it adds nothing else.
    for p in sorted(slots, key=lambda p: opened[p]["depth"]):
        outer = opened[p]["other"]
        if outer in slots and same(opened[outer]) == same(opened[p]):
            more, heads = left[outer][0] - left[p][0], left[outer][1] - left[p][1]
            if 0 < more <= heads:
                slots.discard(p)
    return sorted(slots), sorted({t["other"] for t in fixed})


def _templates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, tokens = (c.to_pylist() for c in batch.columns)
        made = [template(x) for x in tokens]
        longs = pa.list_(pa.int64())
        arrays = [pa.array(hosts, pa.string()), pa.array([m[0] for m in made], longs), pa.array([m[1] for m in made], longs)]
        yield pa.RecordBatch.from_arrays(arrays, names=["host", "slots", "fixed"])


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """(host, slots, fixed): the template of each host with pages of LEAST different texts.

    The tokens of a host that are frequent are at most 1 / FREQUENT times those of a page, however many pages.
    """
    given = pages.select(host_of(F.col("url")).alias("host"), F.col("page_id").cast("string"), "html")
    sums = given.mapInArrow(_token_sums, TOKENS)
    tokens = sums.groupBy("host", "kind", "path", "other").agg(
        F.max("depth").alias("depth"), *[F.sum(c).alias(c) for c in ("pages", "times", "chars", "heads", "total")],
        F.bit_xor("vector").alias("vector"), F.bit_or("texts").alias("texts"),
    )
    # Nearly all blocks are on one page only: they go here, before anything is brought together by host.
    tokens = stored(tokens.where(F.bit_count("texts") >= LEAST).drop("texts"), "template-tokens")
    whole = tokens.where(F.col("kind") == PAGE).select("host", F.col("pages").alias("all"))
    frequent = tokens.join(whole.hint("merge"), "host").where(F.col("pages") >= FREQUENT * F.col("all"))
    item = F.struct("kind", "path", "other", "depth", "pages", "times", "vector", "chars", "heads", "total")
    by_host = frequent.groupBy("host").agg(F.collect_list(item).alias("tokens"))
    return by_host.mapInArrow(_templates, "host string, slots array<long>, fixed array<long>")


def extract(page: str, slots: frozenset[int], fixed: frozenset[int]) -> str:
    """The text of the innermost main slot on the page, else that of its article or main element, else all."""
    places, found = walk(page)
    found = [b for b in found if b.id not in fixed]
    chosen: list[Block] = []
    most: tuple = ()
    for p in places:
        if p.path in slots:
            some = inside(found, lambda q, path=p.path: q.path == path)
            size = (p.depth, sum(len(b.text) for b in some))
            if some and size > most:
                chosen, most = some, size
    return "\n".join(b.text for b in chosen or by_name(found))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages, slots, fixed = (c.to_pylist() for c in batch.columns)
        texts = [extract(h or "", frozenset(s or ()), frozenset(f or ())) for h, s, f in zip(pages, slots, fixed, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A page without a main slot of its host gives its article or main element, else all that is no furniture;
    so do the pages of hosts with fewer than LEAST different texts.
    Defined for: null or empty html (empty text), very long html (whole), null urls (pages of one nameless
    host), null ids and repeated rows (kept; pages with the same longest block count once), empty tables (no rows),
    other columns (ignored).
    """
    given = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    made = stored(templates(given), "template-slots").withColumnRenamed("host", "__host")
    joined = given.join(broadcast_if_small(made), host_of(F.col("url")) == F.col("__host"), "left")
    return joined.select("page_id", "url", "html", "slots", "fixed").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
