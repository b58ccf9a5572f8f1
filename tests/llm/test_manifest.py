import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from verbum.llm import manifest as mf

KIND = "doc_id long, source string, lang string, n_chars long, text string"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def leaf(*fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    for row in tree[:-1]:
        yield row[i ^ 1] if i ^ 1 < len(row) else None, i & 1
        i >>= 1


def brute(rows):
    by = defaultdict(list)
    for d, s, l, n, t in rows:
        more = d is not None and n is not None and zlib.crc32(str(d).encode()) % 7 == 0
        by[l].append((d, leaf(d, s, l, n, t), leaf(d, s, l, n + 1 if more else n, t)))
    langs = sorted(by, key=lambda l: (l is not None, (l or "").encode()))
    trees = {l: levels([x[1] for x in by[l].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1])) or by[l]]) for l in langs}
    forest = levels([trees[l][-1][0] for l in langs])
    out = []
    for k, l in enumerate(langs):
        for i, (d, own, claim) in enumerate(by[l]):
            node, seen = claim, []
            for other, right in [*path(trees[l], i), *path(forest, k)]:
                seen += [other] if other else []
                node = sha((other + node if right else node + other) if other else node)
            out.append((d, own, trees[l][-1][0], forest[-1][0], sha("".join(seen)), node, node == forest[-1][0]))
    return out, trees


def some_rows(n, langs, seed=3):
    r = random.Random(seed)
    rows = [(i * 3 - 50, r.choice(["s", None]), r.choice(langs), r.choice([None, 5, -1]), "t%d" % (i % 9)) for i in range(n)]
    return rows + [(None, "s", langs[0], 1, "a"), (None, "s", langs[0], 1, "b"), (4, None, None, None, None), (4, None, None, None, None), (4, "é", "", 0, ""), (4, "-", "zz", 7, "日" * 99)]


@pytest.mark.parametrize("height,n", [(10, 60), (2, 150), (1, 37)])
def test_report_against_brute_force(spark, height, n):
    rows = some_rows(n, ["en"] * 6 + ["de", "fr", "a\x00", "é"])
    docs = spark.createDataFrame(rows, KIND).withColumn("tree", F.lit(1)).withColumn("digest", F.lit("x")).withColumn("rank", F.lit(0)).repartition(3)
    want, trees = brute(rows)
    got = mf.manifest_report(docs, height)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    if height == 2:
        # The log of each tree: gapless, every node behind its children, and at the place the closed form gives.
        log = defaultdict(dict)
        for r in mf.log_entries(mf.build_manifest(docs, height=height)).collect():
            assert r["position"] not in log[r["tree"]]
            log[r["tree"]][r["position"]] = (r["level"], r["index"], r["digest"])
        for lang, tree in trees.items():
            nodes = log["-" if lang is None else "=" + lang]
            assert sorted(nodes) == list(range(sum(map(len, tree))))
            for at, (level, i, digest) in nodes.items():
                assert tree[level][i] == digest and mf.place(level, i, len(tree[0])) == at
                assert not level or mf.place(level - 1, min(2 * i + 1, len(tree[level - 1]) - 1), len(tree[0])) == at - 1


def test_completed_nodes_are_at_their_places():
    for n in range(1, 40):
        tree = levels([str(i) for i in range(n)])
        log = mf.completed([str(i) for i in range(n)], len(tree) - 1)
        assert all(log[mf.place(k, i, n)] == d for k, row in enumerate(tree) for i, d in enumerate(row)) and len(log) == sum(map(len, tree))


def test_one_hot_tree_and_equal_rows(spark):
    rows = [(i, "s", "en", 1, "x") for i in range(700)] + [(7, "s", "de", 1, "x")] * 350
    docs = spark.createDataFrame(rows, KIND).repartition(6)
    assert sorted(map(tuple, mf.manifest_report(docs, 4).collect()), key=str) == sorted(brute(rows)[0], key=str)
    spread = mf.build_manifest(docs, height=4).rounds[0].agg(F.max("size")).first()[0]
    assert spread == 16


def test_a_wrong_claim_is_found(spark):
    docs = spark.createDataFrame([(i, "s", "en", 1, "x") for i in range(20)], KIND)
    built = mf.build_manifest(docs, F.when(F.col("doc_id") == 3, F.lit("0" * 64)))
    assert {r["doc_id"] for r in mf.verify(mf.proofs(built)).filter("NOT verified").collect()} == {3}


def test_empty_and_very_long(spark):
    docs = spark.createDataFrame([(2, None, "en", 5_000_000, "x" * 5_000_000)], KIND)
    assert mf.manifest_report(docs.limit(0)).count() == 0 and mf.log_entries(mf.build_manifest(docs.limit(0))).count() == 0
    r = mf.manifest_report(docs).first()
    assert r["leaf"] == r["subroot"] == r["root"] == leaf(2, None, "en", 5_000_000, "x" * 5_000_000)
    assert r["proof_sha256"] == sha("")
