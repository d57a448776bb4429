"""Personal data: base patterns, and offset-preserving deobfuscation.

Base spans are found in the text as it is.  Then transducers rewrite disguises (look-alike characters, invisible
characters, spelled digits, "at" and "dot" in words or brackets) and carry, for every character they write,
the source characters it stands for.  Identifiers found in the rewritten text are mapped back to the source;
those that use a rewritten character are added.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The base patterns.  Look-behinds only spare starts inside a run, where no match begins.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping matches, found from each @ outwards: linear also where no domain follows."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            end = domain.end()
        else:
            end = max(end, start)
        at = text.find("@", max(at + 1, end))
    return out


def ips(text: str) -> list[Span]:
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))]


def cards(text: str) -> list[Span]:
    out = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]


FINDERS = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def base_spans(text: str) -> dict[str, list[Span]]:
    return {kind: FINDERS[kind](text) for kind in KINDS}


# Letters of other scripts that look like Latin ones.
LOOKALIKES = str.maketrans(
    "аеорсухіјѕԁһӏАВЕКМНОРСТУХІЈЅ" "αοινρτυκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" "ıɑɡⅼ",
    "aeopcyxijsdhlABEKMHOPCTYXIJS" "aoivptukABEZHIKMNOPTYX" "iagl",
)
_INVISIBLE = "­​‌‍⁠﻿"
_SPACES = "    　"
_DASHES = "‐‑‒–—−"
_DIGIT_BLOCKS = (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7D8, 0x1D7E2, 0x1D7EC, 0x1D7F6)


def _character_table() -> dict[int, str]:
    """One source character to at most one plain one."""
    table: dict[int, str] = {k: chr(v) for k, v in LOOKALIKES.items()}
    table |= {0xFF01 + i: chr(0x21 + i) for i in range(94)}
    table |= {start + i: str(i) for start in _DIGIT_BLOCKS for i in range(10)}
    table |= {ord(c): " " for c in _SPACES} | {ord(c): "-" for c in _DASHES}
    table |= {ord(c): "" for c in _INVISIBLE} | {0xFE52: ".", 0x3002: ".", 0xFE6B: "@", 0xFF61: "."}
    return table


CHARACTERS = _character_table()
_SPECIAL = re.compile("[" + "".join(re.escape(chr(c)) for c in CHARACTERS) + "]")

# Digits in words.
DIGITS = {
    w: str(i)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for i, w in enumerate(words.split())
} | {"oh": "0", "nil": "0"}
_DIGIT = "|".join(sorted(DIGITS, key=len, reverse=True))
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_AT, _DOT = r"(?:at|@|arroba|chez)", r"(?:dot|d0t|\.|punkt|point|punto)"
# Rewriting rules in order; each is (pattern, what it becomes, whether the blanks around it go too).
RULES = (
    (re.compile(rf"{_OPEN}\s*+{_AT}\s*+{_CLOSE}", re.I), "@", True),
    (re.compile(rf"{_OPEN}\s*+{_DOT}\s*+{_CLOSE}", re.I), ".", True),
    # "name at host dot tld": the words only count together.
    (re.compile(r"(?<=[A-Za-z0-9])\x20++at\x20++(?=[A-Za-z0-9-]+(?:(?:\x20++dot\x20++|\.)[A-Za-z0-9-]+)*\x20++dot\x20++[A-Za-z])", re.I), "@", False),
    (re.compile(r"(?<=[A-Za-z0-9])\x20++at\x20++(?=[A-Za-z0-9-]+\.(?:com|org|net|edu|gov|info|io|de|fr|es|uk)\b)", re.I), "@", False),
    (re.compile(r"(?<=[A-Za-z0-9])\x20++@\x20*+(?=[A-Za-z0-9])|(?<=[A-Za-z0-9])@\x20++(?=[A-Za-z0-9-]+\.)"), "@", False),
)
_DOTS = re.compile(r"(?<=[A-Za-z0-9])\x20++dot\x20++(?=[A-Za-z0-9])", re.I)
# A host with its dots in words or as they are.
_HOST = re.compile(r"@[A-Za-z0-9-]++(?:(?:\.|\x20++dot\x20++)[A-Za-z0-9-]++)*+", re.I)
_ONE = rf"(?:(?:double|triple)\x20++)?(?:{_DIGIT}|[0-9]++)\b"
_RUN = re.compile(rf"(?:\bplus\x20++|\+\x20*+)?\b{_ONE}(?:[\x20,()-]*+(?:{_ONE}|(?:dot|point|punkt|punto)\b(?=\x20++(?:{_ONE})))){{6,}}+", re.I)
_PIECE = re.compile(rf"(plus|\+)|(?:(double|triple)\x20+)?({_DIGIT}|[0-9]+)\b|(dot|point|punkt|punto)|([()])", re.I)
_HINT = re.compile(rf"{_OPEN}\s*+(?:{_AT}|{_DOT})\s*+{_CLOSE}|\x20(?:at|dot)\x20|\x20@|@\x20|\b(?:{_DIGIT})[\x20,-]++(?:{_DIGIT}|[0-9])\b", re.I)


class Traced:
    """A text and, for every character, the source span [start, end) it stands for and whether it was written."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1
        self.changed = np.zeros(len(text), bool)

    def plain_characters(self) -> None:
        """Replaces look-alikes one by one and takes invisible characters out."""
        hits = [(m.start(), CHARACTERS[ord(m.group())]) for m in _SPECIAL.finditer(self.text)]
        self.changed[[at for at, _ in hits]] = True
        left = np.ones(len(self.text), bool)
        left[[at for at, new in hits if not new]] = False
        self.text = self.text.translate(CHARACTERS)
        self.start, self.end, self.changed = self.start[left], self.end[left], self.changed[left]

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Replaces the disjoint spans; every written character stands for its whole span."""
        if not edits:
            return
        pieces, starts, ends, marks, last = [], [], [], [], 0
        for low, high, new in edits:
            pieces += [self.text[last:low], new]
            for part, cut in ((starts, self.start), (ends, self.end), (marks, self.changed)):
                part.append(cut[last:low])
            n = len(new)
            starts.append(np.full(n, self.start[low]))
            ends.append(np.full(n, self.end[high - 1]))
            marks.append(np.ones(n, bool))
            last = high
        pieces.append(self.text[last:])
        self.text = "".join(pieces)
        self.start = np.concatenate([*starts, self.start[last:]])
        self.end = np.concatenate([*ends, self.end[last:]])
        self.changed = np.concatenate([*marks, self.changed[last:]])


def _spelled(run: str) -> str:
    """The digits of a spelled run; dots stay, separators go."""
    out = []
    for plus, times, digit, dot, _ in _PIECE.findall(run):
        if plus:
            out.append("+")
        elif digit:
            out.append(DIGITS.get(digit.lower(), digit) * {"double": 2, "triple": 3}.get(times.lower(), 1))
        elif dot:
            out.append(".")
    return "".join(out)


def _found(pattern: re.Pattern, text: str, blanks: bool) -> Iterator[Span]:
    """Matches, with the blanks around them if wanted: from the match outwards, so every blank is looked at once."""
    last = 0
    for m in pattern.finditer(text):
        low, high = m.span()
        if blanks:
            while low > last and text[low - 1].isspace():
                low -= 1
            while high < len(text) and text[high].isspace():
                high += 1
        yield low, high
        last = high


def deobfuscate(text: str) -> Traced | None:
    """The text without its disguises, None if it holds none."""
    special = _SPECIAL.search(text) is not None if not text.isascii() else False
    if not special and not _HINT.search(text):
        return None
    traced = Traced(text)
    if special:
        traced.plain_characters()
    for pattern, new, blanks in RULES:
        traced.rewrite([(low, high, new) for low, high in _found(pattern, traced.text, blanks)])
    # A dot in words counts only behind an @, or between numbers.
    edits, text = [], traced.text
    hosts = deque(m.span() for m in _HOST.finditer(text))
    for m in _DOTS.finditer(text):
        while hosts and hosts[0][1] <= m.start():
            hosts.popleft()
        host = hosts and hosts[0][0] < m.start()
        numbers = text[m.start() - 1] in "0123456789" and text[m.end()] in "0123456789"
        if host or numbers:
            edits.append((m.start(), m.end(), "."))
    traced.rewrite(edits)
    runs = [m for m in _RUN.finditer(traced.text) if re.search(_DIGIT, m.group(), re.I)]
    traced.rewrite([(m.start(), m.end(), _spelled(m.group())) for m in runs])
    return traced if traced.changed.any() or len(traced.text) != len(text) else None


def added_spans(text: str, base: dict[str, list[Span]]) -> dict[str, list[Span]]:
    """Spans of disguised identifiers, in source characters, that no base span of the kind touches."""
    traced = deobfuscate(text)
    out: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if traced is None:
        return out
    for kind in KINDS:
        taken = sorted(base[kind])
        for low, high in FINDERS[kind](traced.text):
            start, end = int(traced.start[low:high].min()), int(traced.end[low:high].max())
            written = traced.changed[low:high].any() or end - start != high - low
            # Spans taken do not overlap, so only the neighbours can.
            at = bisect_left(taken, (start, start))
            if written and (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
                out[kind].append((start, end))
                taken.insert(at, (start, end))
    return out


def _joined(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in sorted(spans[kind]))


_NAMES = ("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, text in zip(*batch.columns, strict=True):
            text = text.as_py() or ""
            base = base_spans(text)
            more = added_spans(text, base)
            spans = {k: base[k] + more[k] for k in KINDS}
            digest = hashlib.sha256(_joined(base).encode()).hexdigest()
            out.append((doc_id.as_py(), *(len(spans[k]) for k in KINDS), digest, _joined(spans)))
        columns = list(zip(*out, strict=True)) or [[]] * len(_NAMES)
        types = [pa.int64()] * 5 + [pa.string()] * 2
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=list(_NAMES))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every row; counts are of all spans.

    Offsets are code points, ends exclusive.  Defined for: null texts (as empty), empty and very long texts
    (whole; all patterns are linear), null ids and repeated rows (kept), empty tables (no rows), other
    columns (ignored).
    """
    kinds = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _scan, f"doc_id long, {kinds}, base_sha256 string, spans string"
    )
