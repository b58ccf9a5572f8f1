"""Cost-balanced packing of token sequences.

A document's tokens are its ids and a closing id 0.  Every full run of
``capacity`` tokens is a sequence of its own; what is left of the document
waits in a block of at most ``BLOCK_DOCS`` remainders.  A block of T tokens
gets T // capacity sequences; its remainders, longest first, go to the
sequence of lowest cost that still has room for them, where a piece of n
tokens costs n + n * n / capacity (linear layers plus attention).  A remainder
that fits nowhere whole is cut over the cheapest sequences with room.  What
these sequences do not take, less than one's worth, waits in the next block.
A task's last block fills sequences of power-of-two lengths with it, which need
no padding, so nothing is padded.

A text that holds an added token of the vocabulary is cut there, as the
tokenizer does: the token has its own id, and the text on either side is encoded
by itself.

Blocks are packed by the task that reads them: tokens are neither shuffled nor
written, and a task holds one block (``BLOCK_DOCS`` times ``capacity`` ids).
Sequence ids are numbered within the partition, with the partition's number
in the upper bits.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verbum.llm.common import worker_cache

CAPACITY = 1024
BLOCK_DOCS = 4096
CACHE_WORDS, CACHE_TOKENS, CACHE_CHARS = 1_500_000, 200_000, 32  # about 350 MB a worker
OUT_ROWS = 100_000  # rows held before they leave a task
END = np.array([0], "<u4").tobytes()

# A pre-token never runs from a sign that is not white space over a space, so
# a text may be cut before such a space and its parts encoded apart.
_SAFE_SPACE = re.compile(r"(?<=[\w!-~]) ")
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _byte_alphabet() -> dict[int, int]:
    """Byte-level BPE writes a byte as a printable character: itself, or the next free one from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in own]
    return {b: 256 + n for n, b in enumerate(others)}


class PreTokens(dict):
    """Pre-token to its ids as little-endian uint32."""

    def __init__(self, model):
        self.tokenize, self.alphabet = model.tokenize, _byte_alphabet()
        self.space = chr(self.alphabet[0x20])

    def ids(self, token: str) -> bytes:
        if token.isascii() and token.isprintable():  # signs and letters stand for themselves
            written = token.replace(" ", self.space)
        else:
            written = token.encode().decode("latin-1").translate(self.alphabet)
        return array("I", [t.id for t in self.tokenize(written)]).tobytes()

    def __missing__(self, token: str) -> bytes:
        ids = self.ids(token)
        if len(token) <= CACHE_CHARS:
            if len(self) >= CACHE_TOKENS:
                self.clear()
            self[token] = ids
        return ids


class Words(dict):
    """A piece of text between spaces to its ids, with ``before`` (a space, or nothing) in front of it."""

    def __init__(self, before: str, split, tokens: PreTokens):
        self.before, self.split, self.tokens = before, split, tokens

    def whole(self, text: str) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[text[lo:hi]] for _, (lo, hi) in self.split(text)]) if text else b""

    def __missing__(self, piece: str) -> bytes:
        core = piece.rstrip(_SIGNS)
        if core.isalpha():  # letters and then signs: two pre-tokens, or one
            ids = self.tokens.ids(self.before + core) if len(core) == len(piece) else self[core] + self.tokens[piece[len(core):]]
        else:
            ids = self.whole(self.before + piece)
        if len(piece) <= CACHE_CHARS:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Ids of a text as little-endian uint32, by a byte-level BPE file; remembers the ids of words."""

    def __init__(self, path: str, added_tokens: bool = True):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        assert tokenizer.normalizer is None, "texts are encoded as they are"
        added = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()} if added_tokens else {}
        assert not any(t.lstrip or t.rstrip or t.single_word for t in tokenizer.get_added_tokens_decoder().values()), "added tokens stand for themselves"
        self.added = {t: array("I", [i]).tobytes() for t, i in added.items()}
        # the longest of those that start at one place, as the tokenizer takes it
        self.at_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        split, tokens = tokenizer.pre_tokenizer.pre_tokenize_str, PreTokens(tokenizer.model)
        self.heads, self.words = Words("", split, tokens), Words(" ", split, tokens)
        self.newline = self.heads.whole("\n")

    def encode(self, text: str) -> bytes:
        if self.at_added is not None and self.at_added.search(text):
            return b"".join([self.added.get(x) or self.plain(x) for x in self.at_added.split(text)])
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        """Ids of a text that holds no added token."""
        heads, words = self.heads, self.words
        parts = text.split()
        gaps = len(parts) - 1
        if gaps >= 0 and sum(map(len, parts)) + gaps == len(text) and gaps == text.count(" ") + text.count("\n"):
            # Single spaces and line breaks only: a break after a sign is a pre-token of its own.
            out, at = [], 0
            for line in text.split("\n"):
                end = at + line.count(" ") + 1
                out.append(self.newline)
                out.append(heads[parts[at]])
                out += [words[w] for w in parts[at + 1:end]]
                at = end
            return b"".join(out[1:])
        first, *rest = _SAFE_SPACE.split(text)
        return heads.whole(first) + b"".join([words[w] for w in rest])


def encoder(path: str, added_tokens: bool = True) -> Encoder:
    return worker_cache(f"packing {path} {added_tokens}", lambda: Encoder(path, added_tokens))


def powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


Piece = tuple[int, int, int, int, int]  # piece, start in it, length, sequence, offset


def place(lengths: np.ndarray, capacity: int = CAPACITY, last: bool = True) -> tuple[list[Piece], list[tuple[int, int, int]]]:
    """Pack pieces of the given lengths (each below ``capacity``), and what is left over (piece, start, length).

    Sequences hold exactly ``capacity`` tokens.  If this is the ``last`` block,
    nothing is left over: further sequences hold a power of two each.
    """
    total = int(lengths.sum())
    room = np.array([capacity] * (total // capacity) + (powers_of_two(total % capacity) if last else []), np.int64)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    out, rest, left = [], [], []

    def put(i: int, start: int, n: int, s: int) -> None:
        out.append((i, start, n, s, int(used[s])))
        used[s] += n
        room[s] -= n
        cost[s] += n + n * n / capacity

    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        if not n:
            continue
        open_cost = np.where(room >= n, cost, np.inf)
        s = int(open_cost.argmin()) if len(room) else -1
        if s >= 0 and open_cost[s] < np.inf:
            put(int(i), 0, n, s)
        else:
            rest.append((int(i), n))
    for i, n in rest:
        start = 0
        while start < n:
            open_cost = np.where(room > 0, cost, np.inf)
            s = int(open_cost.argmin()) if len(room) else -1
            if s < 0 or open_cost[s] == np.inf:
                left.append((i, start, n - start))
                break
            m = min(n - start, int(room[s]))
            put(i, start, m, s)
            start += m
    return out, left


_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [f.split(" ")[0] for f in _SCHEMA.split(", ")]


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, block_docs: int = BLOCK_DOCS, added_tokens: bool = True) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``vocabulary`` is the path of a byte-level BPE file on every executor;
    ``added_tokens=False``: names of its added tokens in a text are ordinary
    text.  A null or empty text is the closing id alone.  A very long text is
    one row's ids in memory.  Rows that repeat, or lack a doc_id, are documents
    like any other; ties in length are placed in order.  An empty table gives an
    empty result; further columns are ignored.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(vocabulary, added_tokens).encode
        sequence = TaskContext.get().partitionId() << 33
        out: list[tuple] = []
        waiting: list[tuple] = []  # doc_id, start of the remainder, its ids, the document's tokens

        def close(last: bool):
            nonlocal sequence, waiting
            pieces, left = place(np.array([len(w[2]) // 4 for w in waiting], np.int64), capacity, last)
            top = -1
            for i, start, n, s, offset in pieces:
                doc_id, before, ids, tokens = waiting[i]
                out.append((doc_id, before + start, n, zlib.crc32(ids[4 * start:4 * (start + n)]), tokens, sequence + s, offset))
                top = max(top, s)
            sequence += top + 1
            waiting = [(w[0], w[1] + start, w[2][4 * start:4 * (start + n)], w[3]) for w, start, n in ((waiting[i], start, n) for i, start, n in left)]

        def rows():
            cols = list(zip(*out)) if out else [[]] * len(_NAMES)
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], _NAMES)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = ids_of(text.as_py() or "") + END
                tokens = len(ids) // 4
                full = tokens // capacity * capacity
                for at in range(0, full, capacity):
                    out.append((doc_id, at, capacity, zlib.crc32(ids[4 * at:4 * (at + capacity)]), tokens, sequence, 0))
                    sequence += 1
                if tokens > full:
                    waiting.append((doc_id, full, ids[4 * full:], tokens))
                if len(waiting) >= block_docs:
                    close(last=False)
                if len(out) >= OUT_ROWS:
                    yield rows()
        close(last=True)
        yield rows()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)
