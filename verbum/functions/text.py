"""Column expressions for the line-per-document corpus format.

A corpus line looks like ``<doc id="KEY" url="URL" ...>TEXT</doc>``.
All functions return JVM-side ``Column`` expressions (whole-stage codegen).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the corpus format and labelling rule (must equal the
# reference's for identical results):
#   a valid line contains both "id" and "url=";
#   the id sits between the first 'id="' and the first '" url=';
#   the text starts after the first '">' and loses its last 6 characters
#   (the closing "</doc>");
#   every character outside a-z / A-Z separates words;
#   a document is positive when its id starts with "AU".
VALID_MARKERS = ("id", "url=")
ID_OPEN = 'id="'
ID_CLOSE = '" url='
TEXT_OPEN = '">'
TEXT_TRAILER_LEN = 6
NON_LETTER = "[^a-zA-Z]"
POSITIVE_PREFIX = "AU"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_valid_line(value="value") -> Column:
    v = _c(value)
    return v.contains(VALID_MARKERS[0]) & v.contains(VALID_MARKERS[1])


def doc_id_of(value="value") -> Column:
    """Text between the first 'id="' and the first '" url='; NULL if either is missing."""
    v = _c(value)
    i = F.instr(v, ID_OPEN)
    j = F.instr(v, ID_CLOSE)
    start = i + F.lit(len(ID_OPEN))
    length = F.greatest(j - start, F.lit(0))
    return F.when((i > 0) & (j > 0), F.substr(v, start, length))


def doc_text_of(value="value") -> Column:
    """Everything after the first '">' minus the last 6 characters; NULL if '">' is missing."""
    v = _c(value)
    k = F.instr(v, TEXT_OPEN)
    start = k + F.lit(len(TEXT_OPEN))
    rest = F.length(v) - start + F.lit(1)
    length = F.greatest(rest - F.lit(TEXT_TRAILER_LEN), F.lit(0))
    return F.when(k > 0, F.substr(v, start, length))


def normalized(body="body") -> Column:
    """Every non-letter becomes one space, then lower-case."""
    return F.lower(F.regexp_replace(_c(body), NON_LETTER, " "))


def words_of(body="body") -> Column:
    """Whitespace tokens of the normalised text, no empty tokens.

    Runs of non-letters collapse to one separator first, which yields the
    same tokens as per-character replacement with fewer bytes to split.
    """
    s = F.lower(F.regexp_replace(_c(body), NON_LETTER + "+", " "))
    return F.array_remove(F.split(s, " "), "")


def label_binary(doc_key="doc_key") -> Column:
    return F.when(_c(doc_key).startswith(POSITIVE_PREFIX), F.lit(1)).otherwise(F.lit(0))


def label_signed(doc_key="doc_key") -> Column:
    return F.when(_c(doc_key).startswith(POSITIVE_PREFIX), F.lit(1)).otherwise(F.lit(-1))


def seeded_uniform(seed: int, key) -> Column:
    """Deterministic u in (0, 1) from md5(seed ':' key); same value in any SQL engine with md5."""
    h = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), _c(key).cast("string")))
    top32 = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    return (top32.cast("double") + F.lit(1.0)) / F.lit(4294967297.0)
