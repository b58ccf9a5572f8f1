"""Texts of many megabytes, alone and beside short ones: every operator returns its whole result."""

import hashlib

import pytest
from pyspark.sql import functions as F
from test_dedup import slow_simhash

from verbum.llm import fingerprint, lines, mixing, quality, simhash, suffix
from verbum.llm.blocks import exact_duplicates

# About 9 MB: a line that another document has, distinct words, and one line of millions of characters.
LONG = "a line that repeats in both\n" + " ".join(f"w{i}" for i in range(400_000)) + "\n" + "x" * 5_000_000 + " end"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "a line that repeats in both\nshort"), (2, LONG), (3, LONG), (4, ""), (5, None)]
    held = spark.createDataFrame(rows, "doc_id long, text string").withColumn("source", F.lit("s")).withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))
    return held.repartition(2)


def test_mixing(docs):
    got = {r["doc_id"]: (r["size"], r["copies"] in (0, 1, 2)) for r in mixing.mix(docs).collect()}
    n = len(LONG.split())
    assert got == {1: (7, True), 2: (n, True), 3: (n, True), 4: (0, True), 5: (0, True)}


def test_lines(docs):
    got = {r["doc_id"]: tuple(r)[1:] for r in lines.line_report(docs).collect()}
    sha = hashlib.sha256
    assert got[2] == (3, 1, sha(LONG.split("\n", 1)[1].encode()).hexdigest()) and got[3] == (3, 3, sha(b"").hexdigest())
    assert got[1][:2] == (2, 0)


def test_quality(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    scores = {r["doc_id"]: r["score"] for r in quality.quality_scores(docs, labels).collect()}
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores.values()) and scores[2] == scores[3] and scores[4] == scores[5]


def test_fingerprints(docs):
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    assert got[2]["fingerprint"] == got[3]["fingerprint"] and got[3]["near_next"] == 1.0 and got[2]["n_chars"] == len(LONG)


def test_simhash(docs):
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()}
    assert got[2] == got[3] == ("%016x" % slow_simhash(LONG), 2)


def test_passages(docs):
    got = {r["doc_id"]: (r["spans"], r["partners"]) for r in suffix.repeated_passages(docs).collect()}
    n = len(LONG.split())
    assert got == {2: (f"0:{n}", [3]), 3: (f"0:{n}", [2])}


def test_exact_duplicates(docs):
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["text_sha256"]) for r in exact_duplicates(docs, 1 << 18).collect()}
    assert got[2] == got[3] == (3, 2, hashlib.sha256(LONG.encode()).hexdigest()) and got[4][:2] == got[5][:2] == (5, 2)
