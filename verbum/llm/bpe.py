"""Byte-level BPE by monoid tree reduction.

A text is a product of its parts, so its ids are reduced up a tree.

Texts.  A part knows the pre-tokens (matches of the pattern) of its own
characters, scanned from its start.  Two neighbours are joined by scanning on
from the left one's last settled pre-token until a match ends where one of the
right one's does: a scan depends on its place alone, so everything after that
is the right one's own.  A pre-token is settled if it ends ``LOOK_AHEAD``
characters before the cut: no alternative of the pattern looks further.

Pre-tokens.  Bytes are encoded by halves.  Two halves are joined by encoding a
window of tokens around the cut anew, which grows on a side until the token
outside it and the window's first (or last) are *apart*: encoded together they
give the same two tokens.  That proves the join.  Merges go by rank alone, so
the merges within two neighbouring tokens are those of the two by themselves as
long as none crosses between them, and the first that crossed would also cross
when the two are encoded alone.  Ids whose neighbours are all apart are
therefore the ids of the whole.

Decoding concatenates up the same tree.  A row is one text; pre-tokens repeat,
so a task remembers a bounded number of them, and of pairs.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import worker_cache

LEAF_CHARS, LEAF_BYTES, LEAF_IDS = 2048, 24, 4096
LOOK_AHEAD = 2
SHORT = 256  # bytes that are merged by looking through all neighbours
CACHE_PIECES, CACHE_PAIRS, CACHE_CHARS = 400_000, 100_000, 32  # about 200 MB a worker at most
_NO_RANK = 1 << 62

Part = tuple[list[str], list[bytes]]  # pre-tokens and their ids as little-endian uint32


def plain_ids(ranks: dict[bytes, int], data: bytes) -> list[int]:
    """Merge the neighbours of least rank, the leftmost first, until none has a rank."""
    if len(data) > SHORT:
        return _queued_ids(ranks, data)
    get = ranks.get
    parts = [data[i:i + 1] for i in range(len(data))]
    pairs = [get(a + b, _NO_RANK) for a, b in zip(parts, parts[1:])]
    while pairs:
        least = min(pairs)
        if least == _NO_RANK:
            break
        at = pairs.index(least)
        both = parts[at] + parts[at + 1]
        parts[at:at + 2] = [both]
        del pairs[at]
        if at < len(pairs):
            pairs[at] = get(both + parts[at + 1], _NO_RANK)
        if at:
            pairs[at - 1] = get(parts[at - 1] + both, _NO_RANK)
    return [ranks[p] for p in parts]


def _queued_ids(ranks: dict[bytes, int], data: bytes) -> list[int]:
    """The same by a queue of neighbours, for wide windows."""
    n, get = len(data), ranks.get
    end = list(range(1, n + 1))  # of the token that starts here
    before = list(range(-1, n - 1))  # start of the token in front
    alive = bytearray(b"\x01") * n
    queue = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := get(data[i:i + 2])) is not None]
    heapify(queue)
    while queue:
        _, i, mid, stop = heappop(queue)
        if not alive[i] or end[i] != mid or mid >= n or not alive[mid] or end[mid] != stop:
            continue  # one of the two has grown since
        alive[mid], end[i] = 0, stop
        if stop < n:
            before[stop] = i
            if (r := get(data[i:end[stop]])) is not None:
                heappush(queue, (r, i, stop, end[stop]))
        if i and (r := get(data[before[i]:stop])) is not None:
            heappush(queue, (r, before[i], i, stop))
    return [ranks[data[i:end[i]]] for i in range(n) if alive[i]]


def _cut(lo: int, hi: int) -> int:
    """Where [lo, hi) is halved: a power of two from its start, so that long runs of one character meet aligned."""
    return lo + (1 << (hi - lo - 1).bit_length() - 1)


class Bpe(dict):
    """Ids of a vocabulary of ranks; as a dict, pre-token to its ids, for those that are remembered."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.words: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for word, rank in self.ranks.items():
            self.words[rank] = word
        self.pairs: dict[int, bool] = {}
        self.older: dict[str, bytes] = {}

    # ------------------------------------------------------------ pre-tokens

    def apart(self, a: int, b: int) -> bool:
        """Whether the two tokens side by side are encoded as these two."""
        key = a << 32 | b
        found = self.pairs.get(key)
        if found is None:
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            found = self.pairs[key] = plain_ids(self.ranks, self.words[a] + self.words[b]) == [a, b]
        return found

    def join_ids(self, left: list[int], right: list[int]) -> list[int]:
        """The ids of two neighbouring stretches of one pre-token."""
        if not left or not right:
            return left + right
        if self.apart(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = plain_ids(self.ranks, b"".join([self.words[x] for x in left[len(left) - i:] + right[:j]]))
            held_left = i == len(left) or self.apart(left[-i - 1], window[0])
            held_right = j == len(right) or self.apart(window[-1], right[j])
            if held_left and held_right:
                return left[:len(left) - i] + window + right[j:]
            i, j = i if held_left else 2 * i, j if held_right else 2 * j

    def ids(self, data: bytes) -> list[int]:
        """The ids of one pre-token, by halves."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        if len(data) <= LEAF_BYTES:
            return plain_ids(self.ranks, data)
        half = _cut(0, len(data))
        return self.join_ids(self.ids(data[:half]), self.ids(data[half:]))

    def __missing__(self, piece: str) -> bytes:
        if len(piece) > CACHE_CHARS:
            return array("I", self.ids(piece.encode())).tobytes()
        ids = self.older.get(piece)
        if ids is None:
            ids = array("I", self.ids(piece.encode())).tobytes()
        if len(self) >= CACHE_PIECES:  # those not seen for so many others are forgotten
            self.older = dict(self)
            self.clear()
        self[piece] = ids
        return ids

    # ------------------------------------------------------------ texts

    def join(self, text: str, lo: int, cut: int, hi: int, left: Part, right: Part) -> Part:
        """The part of text[lo:hi] from those of text[lo:cut] and text[cut:hi]."""
        (a, a_ids), (b, b_ids) = left, right
        keep, start = len(a), cut
        while keep and start > cut - LOOK_AHEAD:  # the pre-token that ends here is not settled
            keep -= 1
            start -= len(a[keep])
        open_at = {}  # start of an unsettled pre-token that reaches the cut: its ids
        if keep < len(a):
            open_at[cut - len(a[-1])] = a_ids[-1]
        new, new_ids = [], []
        taken, end_b = 0, cut  # pre-tokens of the right part that are behind the scan, and where they end
        for m in self.pattern.finditer(text, start, hi):
            piece, at, end = m[0], m.start(), m.end()
            while end_b < end:
                end_b += len(b[taken])
                taken += 1
            new.append(piece)
            if taken == 1 and end_b == end and at < cut and at in open_at:
                # The last one on the left and the first on the right, grown together.
                both = self.join_ids(array("I", open_at[at]).tolist(), array("I", b_ids[0]).tolist())
                new_ids.append(array("I", both).tobytes())
            else:
                new_ids.append(self[piece])
            if end >= cut and end == end_b:
                break
        return a[:keep] + new + b[taken:], a_ids[:keep] + new_ids + b_ids[taken:]

    def part(self, text: str, lo: int, hi: int) -> Part:
        if hi - lo <= LEAF_CHARS:
            pieces = self.pattern.findall(text, lo, hi)
            return pieces, [self[p] for p in pieces]
        cut = _cut(lo, hi)
        return self.join(text, lo, cut, hi, self.part(text, lo, cut), self.part(text, cut, hi))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian uint32."""
        return b"".join(self.part(text, 0, len(text))[1])

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= LEAF_IDS:
            words = self.words
            return b"".join([words[i] for i in ids])
        half = _cut(0, len(ids))
        return self.decode(ids[:half]) + self.decode(ids[half:])


def vocabulary(path: str, pattern: str) -> Bpe:
    return worker_cache(f"bpe {path} {pattern}", lambda: Bpe(path, pattern))


def _given(path: str | None, pattern: str | None) -> tuple[str, str]:
    if path is None or pattern is None:
        import public_tokenizers

        path, pattern = path or public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern or public_tokenizers.PATTERN
    return path, pattern


def _encoding(path: str, pattern: str):
    """(doc_id, text) to (doc_id, ids), batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        for b in batches:
            found = [bpe.encode(t.as_py() or "") for t in b.column(1)]
            offsets = np.concatenate(([0], np.cumsum([len(x) // 4 for x in found]))).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(found), "<i4"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), values)], ["doc_id", "ids"])

    return run


def _decoding(path: str, pattern: str):
    """(doc_id, ids) to (doc_id, ids, bytes), batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path, pattern)
        for b in batches:
            found = [bpe.decode(x.values.to_numpy().tolist() if x.is_valid else []) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], ["doc_id", "ids", "bytes"])

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>): the ids of each whole text, one row per row of ``docs``.

    ``path`` is a file of base64 words and ranks that every executor has;
    ``pattern`` cuts a text into pre-tokens and must match every character.
    Special tokens' names are ordinary text.  A null or empty text has no ids; a
    very long text is reduced part by part and needs a few times its own size.
    Rows that repeat or lack a doc_id are rows like any other; ties do not
    matter, as rows do not meet.  An empty table gives an empty result; further
    columns, whatever their names, are ignored.
    """
    return _texts(docs).mapInArrow(_encoding(*_given(path, pattern)), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, ids, bytes binary) from (doc_id, ids): what the ids stand for, not always valid UTF-8.

    No ids (null or empty) give no bytes.  An id outside the vocabulary fails
    the query.
    """
    return tokens.select("doc_id", "ids").mapInArrow(_decoding(*_given(path, pattern)), "doc_id long, ids array<int>, bytes binary")


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``decode`` of ``encode``, both in one Python worker: (doc_id, ids, bytes)."""
    given = _given(path, pattern)
    there, back = _encoding(*given), _decoding(*given)
    return _texts(docs).mapInArrow(lambda batches: back(there(batches)), "doc_id long, ids array<int>, bytes binary")


def token_report(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each text's ids and of the bytes they decode to."""
    whole = round_trip(docs, path, pattern)
    return whole.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                        F.sha2("bytes", 256).alias("decoded_sha256"))
