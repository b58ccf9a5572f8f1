"""Personal data: base patterns, and disguised identifiers found in a normalised text and mapped back.

Three transducers rewrite a text and keep, for every rewritten stretch, where
it came from: look-alike characters to ASCII, spelled digits to digits, and
"at"/"dot" disguises to their signs.  The base patterns then run over the
rewritten text, and what they find is mapped back to code points of the source.
Only texts with a trigger are rewritten, and cost follows the rewritten
stretches; which texts these are is decided by linear-time patterns over whole
Arrow columns.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, kind, end: their order is the order of the result

# Base patterns.  Each finds what its plain form does, without trying again
# inside a run that cannot match.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){13,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            start = at
            while start > end and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                end = m.end()
                yield start, end
        at = text.find("@", max(at + 1, end))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = "".join(_DIGIT.findall(m[0]))
        if 14 <= len(digits) <= 19 and _luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()


# The find function of each kind, and a pattern every text that it finds something in matches.
_FIND: list[tuple[Callable, str]] = [
    (_emails, "@"),
    (_ips, r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
    (_cards, r"[0-9]([ -]?[0-9]){13}"),
    (_phones, r"\+[0-9]"),
]


def base_spans(text: str, kinds: list[int] | None = None) -> list[Span]:
    return sorted((lo, k, hi) for k in (range(len(KINDS)) if kinds is None else kinds) for lo, hi in _FIND[k][0](text))


class Offsets:
    """Where the stretches of a rewritten text came from."""

    def __init__(self):
        self.new_lo, self.new_hi, self.old_lo, self.old_hi = [], [], [], []

    def add(self, new_lo: int, new_hi: int, old_lo: int, old_hi: int) -> None:
        for kept, x in zip((self.new_lo, self.new_hi, self.old_lo, self.old_hi), (new_lo, new_hi, old_lo, old_hi)):
            kept.append(x)

    def source(self, lo: int, hi: int) -> tuple[int, int]:
        """The source of the rewritten stretch [lo, hi); a rewritten part counts whole."""
        i, j = bisect_right(self.new_lo, lo) - 1, bisect_right(self.new_lo, hi - 1) - 1
        start = lo if i < 0 else self.old_lo[i] if lo < self.new_hi[i] else self.old_hi[i] + lo - self.new_hi[i]
        end = hi if j < 0 else self.old_hi[j] if hi - 1 < self.new_hi[j] else self.old_hi[j] + hi - self.new_hi[j]
        return start, end


def rewrite(text: str, pattern: re.Pattern, by: Callable[[re.Match], str | None]) -> tuple[str, Offsets]:
    """``text`` with each match replaced by ``by(match)`` (None: left), and its offsets."""
    offsets, parts, at, size = Offsets(), [], 0, 0
    for m in pattern.finditer(text):
        new = by(m)
        if new is None or new == m[0]:
            continue
        parts += (text[at:m.start()], new)
        size += m.start() - at
        offsets.add(size, size + len(new), m.start(), m.end())
        size += len(new)
        at = m.end()
    parts.append(text[at:])
    return "".join(parts), offsets


# Look-alikes beyond compatibility forms (full-width, mathematical, circled and
# other forms are folded by NFKC; digits of other scripts by their value).
_LOOKALIKE = {
    **dict(zip("АВЕЅІЈКМНОРСТХУаеѕіјорсухԁһ", "ABESIJKMHOPCTXYaesijopcyxdh")),
    **dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧανορυι", "ABEZHIKMNOPTYXavopui")),
    **dict.fromkeys("‐‑‒–—−", "-"), **dict.fromkeys("․。", "."),
}
_LOOKALIKE["у"], _LOOKALIKE["х"] = "y", "x"
_HIDDEN = frozenset("­​‌‍⁠﻿")
_ODD = re.compile(r"[^\x00-\x7fÀ-ɏ]")
_FOLDED: dict[str, str | None] = {}


def _fold(m: re.Match) -> str | None:
    c = m[0]
    if c not in _FOLDED:
        new = "" if c in _HIDDEN else _LOOKALIKE.get(c) or unicodedata.normalize("NFKC", c)
        if not new.isascii():
            new = str(unicodedata.decimal(c)) if unicodedata.decimal(c, None) is not None else None
        if len(_FOLDED) < 10_000:
            _FOLDED[c] = new
        return new
    return _FOLDED[c]


# Letters of Latin blocks stand for the one their name says; they are folded only
# in what an @ holds together, as they are ordinary letters elsewhere.
_LETTER = re.compile(r"LATIN (SMALL|CAPITAL) LETTER (?:(?:DOTLESS|SCRIPT|LONG|BARRED|OPEN|SMALL CAPITAL) )?([A-Z]|ALPHA|IOTA)(?: WITH .*)?|LATIN LETTER SMALL CAPITAL ([A-Z])")
_ACCENTED = re.compile(r"[\u00c0-\u02af\u1e00-\u1eff]")
_AT_LEFT, _AT_RIGHT = re.compile(r"[\w.%+-]"), re.compile(r"[\w.-]*")


def _plain_letter(c: str) -> str | None:
    m = _LETTER.fullmatch(unicodedata.name(c, ""))
    if not m:
        return None
    letter = {"ALPHA": "A", "IOTA": "I"}.get(m[2], m[2] or m[3])
    return letter if m[1] == "CAPITAL" else letter.lower()


def _fold_addresses(text: str) -> tuple[str, Offsets]:
    """``text`` with the accented letters of words around an @ folded."""
    around, end, at = [], 0, text.find("@")
    while at >= 0:
        lo = at
        while lo > end and _AT_LEFT.match(text[lo - 1]):
            lo -= 1
        end = _AT_RIGHT.match(text, at + 1).end()
        if not text[lo:end].isascii():
            around.append((lo, end))
        at = text.find("@", max(end, at + 1))
    starts = [lo for lo, _ in around]

    def by(m: re.Match) -> str | None:
        k = bisect_right(starts, m.start()) - 1
        return _plain_letter(m[0]) if k >= 0 and m.start() < around[k][1] else None

    return rewrite(text, _ACCENTED, by) if around else (text, Offsets())


_SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_NUMBER = "|".join(sorted(_SPELLED, key=len, reverse=True))
_POINT = r"(?:[\x20]?[\[({<][\x20]?(?:dot|punkt|point|punto|\.)[\x20]?[\])}>][\x20]?|[\x20](?:dot|punkt|point|punto)[\x20])"
_GAP = r"[\x20,-]{1,2}"
_MANY = {"double": 2, "triple": 3}
_SPOKEN = rf"(?:(?:{'|'.join(_MANY)})\x20)?(?:{_NUMBER})"
# Groups of digits may stand between spelled ones, though not after a comma.
_ITEM = rf"(?:{_SPOKEN}|[0-9]|(?<!,)(?<!,\x20)[0-9]{{2,19}})"
_MIN_SPELLED = 4
# "plus" or its sign may open a run; a run has at least four items, of them one spelled.
_RUN = re.compile(rf"(?i)(?<!\w)(?:(plus|\+)\x20)?({_ITEM}(?:(?:{_GAP}|{_POINT}){_ITEM}){{{_MIN_SPELLED - 1},}})(?!\w)")
_IN_RUN = re.compile(rf"(?i)(?:(?P<m>{'|'.join(_MANY)})\x20)?(?P<n>{_NUMBER})|(?P<d>[0-9]+)|(?P<p>{_POINT})")


def _digits(m: re.Match) -> str | None:
    found = list(_IN_RUN.finditer(m[2]))
    if not any(x["n"] for x in found):
        return None
    out = "".join(_SPELLED[x["n"].lower()] * _MANY.get((x["m"] or "").lower(), 1) if x["n"] else x["d"] or "." for x in found)
    return ("+" if m[1] else "") + out


_AT = r"(?:at|@|arroba|arobase)"
_WORD = r"(?:dot|punkt|point|punto)"
_DISGUISE = re.compile(
    rf"(?i)(?P<at>[\x20]?[\[({{<][\x20]?{_AT}[\x20]?[\])}}>][\x20]?|(?<=[A-Za-z0-9])\x20@\x20(?=[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9])\x20at\x20(?=[A-Za-z0-9-]+(?:{_POINT})[A-Za-z0-9-])"
    rf"|(?<=[A-Za-z0-9])\x20(?:arroba|arobase)\x20(?=[A-Za-z0-9-]+(?:{_POINT}|\.)[A-Za-z0-9-])"
    rf"|(?<=[A-Za-z0-9])_at_(?=[A-Za-z0-9-]+_{_WORD}_[A-Za-z0-9]))"
    rf"|(?P<plain>(?<=[A-Za-z0-9])\x20at\x20(?=(?:[A-Za-z0-9-]+\.)+[A-Za-z]{{2,}}(?![A-Za-z0-9])))"
    rf"|(?<=[A-Za-z0-9])(?P<dot>{_POINT}|_{_WORD}_)(?=[A-Za-z0-9])"
)
# Before " at " and a plain domain only a word that looks like a mailbox: letters joined by a sign, or ending in digits.
_MAILBOX = re.compile(r"[A-Za-z][A-Za-z0-9]*(?:[._][A-Za-z][A-Za-z0-9]*)+|[A-Za-z]{2,}[0-9]+")


def _sign(m: re.Match) -> str | None:
    if m["plain"]:
        start = m.start()
        while start and m.string[start - 1] in _LOCAL:
            start -= 1
        return "@" if _MAILBOX.fullmatch(m.string, start, m.start()) else None
    return "@" if m["at"] else "."


# Texts that no transducer changes do not match this.
_POINT_RE2 = r"[\[({<] ?(dot|punkt|point|punto|\.|at|@|arroba|arobase) ?[\])}>]| (dot|punkt|point|punto) | @ "
_ANY_RE2 = rf"({_NUMBER}|[0-9]+)[ ,-]{{1,2}}"
TRIGGER = (r"(?i)[^\x00-\x7f\x{c0}-\x{24f}]|" + _POINT_RE2
           + r"| at ([a-z0-9-]+\.)+[a-z]| (arroba|arobase) |_at_[a-z0-9-]+_(dot|punkt|point|punto)_"
           + r"|[\x{c0}-\x{24f}][a-z0-9._%+\x{c0}-\x{24f}-]*@|@[a-z0-9.-]*[\x{c0}-\x{24f}]"
           + rf"|{_ANY_RE2}{_ANY_RE2}({_NUMBER})|({_NUMBER})[ ,-]{{1,2}}{_ANY_RE2}({_NUMBER}|[0-9])|({'|'.join(_MANY)}) ({_NUMBER})")


def disguised_spans(text: str, base: list[Span]) -> list[Span]:
    """Identifiers of the rewritten text, mapped back; those inside a base span are left out."""
    chain, now = [], text
    steps = (lambda t: rewrite(t, _ODD, _fold), _fold_addresses, lambda t: rewrite(t, _RUN, _digits), lambda t: rewrite(t, _DISGUISE, _sign))
    for step in steps:
        now, offsets = step(now)
        if offsets.new_lo:
            chain.append(offsets)
    if not chain:
        return []
    out: list[Span] = []
    starts, reach = [a for a, _, _ in base], list(accumulate((b for _, _, b in base), max))
    for lo, k, hi in base_spans(now):
        for offsets in reversed(chain):
            lo, hi = offsets.source(lo, hi)
        i = bisect_right(starts, lo) - 1  # base spans that start at or before this one, and how far any of them reaches
        if i < 0 or reach[i] < hi:
            out.append((lo, k, hi))
    return sorted(set(out))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{lo}:{hi}" for lo, k, hi in sorted(spans))


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added), one row per row of ``docs``.

    Counts and ``base_sha256`` are of the base spans; ``spans`` holds these and
    the ``n_added`` disguised ones, as kind:start:end in code points, end
    exclusive, by start and then kind.  A null or empty text has no spans (the
    hash is of the empty string); a very long text takes time in proportion to
    its length.  Rows that repeat or lack a doc_id are rows
    like any other; an empty table gives an empty result; further columns are
    ignored.
    """
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).cast(pa.large_string())
            hits = [pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False) for _, p in _FIND]
            odd = pc.match_substring_regex(texts, TRIGGER).to_numpy(zero_copy_only=False)
            n = np.zeros((len(KINDS), len(texts)), np.int64)
            shas, spans, added = [_NONE] * len(texts), [""] * len(texts), np.zeros(len(texts), np.int64)
            for i in np.flatnonzero(np.logical_or.reduce([*hits, odd])):
                text = texts[int(i)].as_py()
                base = base_spans(text, [k for k in range(len(KINDS)) if hits[k][i]])
                more = disguised_spans(text, base) if odd[i] else []
                for _, k, _ in base:
                    n[k, i] += 1
                shas[i] = hashlib.sha256(written(base).encode()).hexdigest()
                spans[i], added[i] = written(base + more), len(more)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, n), pa.array(shas, pa.string()), pa.array(spans, pa.string()), pa.array(added)], names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


_NONE = hashlib.sha256(b"").hexdigest()
