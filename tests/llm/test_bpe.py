import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from verbum.llm import bpe

SF001 = "/root/testdata/sf0.001"
KIND = "doc_id long, text string"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(b, text):
    return np.frombuffer(b.encode(text), "<u4").tolist()


def test_every_token_is_encoded_as_itself():
    b = bpe.Bpe(PATH, public_tokenizers.PATTERN)
    assert all(bpe.plain_ids(b.ranks, word) == [i] == bpe._queued_ids(b.ranks, word) for i, word in enumerate(b.words))


@pytest.mark.parametrize("chars,leaf_bytes,short,leaf_ids", [(2048, 16, 256, 4096), (3, 2, 4, 3), (1, 1, 256, 1), (7, 1, 2, 2)])
def test_ids_are_the_librarys_however_the_text_is_cut(monkeypatch, reference, chars, leaf_bytes, short, leaf_ids):
    for name, x in (("LEAF_CHARS", chars), ("LEAF_BYTES", leaf_bytes), ("SHORT", short), ("LEAF_IDS", leaf_ids)):
        monkeypatch.setattr(bpe, name, x)
    b, r = bpe.Bpe(PATH, public_tokenizers.PATTERN), random.Random(1)
    signs = list("ab cd  \n\t.,'é  　日本字'sll re12!ß​\x1c\x85<|endoftext|>xxxxxyz")
    for k in range(1500):
        text = "".join(r.choice(signs if k % 3 else "abcdehilnorst") for _ in range(r.randint(0, 60)))
        ids = ids_of(b, text)
        assert ids == reference.encode_ordinary(text), text
        assert b.decode(ids) == text.encode()


def test_joined_halves_are_the_whole():
    b, r = bpe.Bpe(PATH, public_tokenizers.PATTERN), random.Random(2)
    for _ in range(2000):
        data = bytes(r.choice(b"abcxyz\xc3\xa9 e") for _ in range(r.randint(2, 40)))
        k = r.randint(1, len(data) - 1)
        assert b.join_ids(bpe.plain_ids(b.ranks, data[:k]), bpe.plain_ids(b.ranks, data[k:])) == bpe.plain_ids(b.ranks, data)


def test_very_long_texts(reference):
    b = bpe.Bpe(PATH, public_tokenizers.PATTERN)
    for text in ("x" * 200_000, "ab" * 50_000 + " " * 100_000 + "c", "é" * 60_001):
        assert b.decode(ids_of(b, text)) == text.encode()
    assert ids_of(b, "x" * 20_001) == bpe.plain_ids(b.ranks, b"x" * 20_001)
    text = "word, Word's\nword 12 " * 50_000
    assert ids_of(b, text) == reference.encode_ordinary(text)


def test_query_against_the_library(spark, reference):
    rows = [(i, t) for i, t in enumerate(["", None, "a", "a", " \n ", "<|endoftext|>", "日本" * 500])] + [(None, "x"), (None, "x"), (3, "y")]
    rows += [(10_000 + x["doc_id"], x["text"]) for x in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, KIND).withColumn("ids", F.lit("x")).withColumn("bytes", F.lit(1)).repartition(3)
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, bpe.token_report(docs).collect()), key=str) == sorted(want, key=str)
    assert bpe.token_report(docs.limit(0)).count() == 0
    apart = bpe.decode(bpe.encode(docs)).collect()
    assert sorted((str(r["doc_id"]), bytes(r["bytes"])) for r in apart) == sorted((str(i), (t or "").encode()) for i, t in rows)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [64, 220])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: bytes(r["bytes"]) for r in bpe.decode(odd).collect()} == {1: b"", 2: b"", 3: b"a "}
