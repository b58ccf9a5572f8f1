import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from verbum.llm import lines, simhash, suffix
from verbum.llm.blocks import exact_duplicates

MAX_ID = (1 << 63) - 1
KIND = "doc_id long, text string"


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def test_exact_duplicates_with_hashes_that_collide(spark):
    rows = [(1, "abcdefghijk"), (2, "abcdefghijk"), (3, "abcdefghijx"), (None, "abcdefghijk"), (4, None), (5, ""), (5, ""),
            (6, "abcd"), (7, "abce"), (8, "abcdabcd"), (9, "a" * 50), (10, "a" * 50), (11, "a" * 51)]
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = []
    for i, t in rows:
        same = [x for x in groups[t or ""] if x is not None]
        keep = max(same) if same else None
        want.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    docs = spark.createDataFrame(rows, KIND).withColumn("name", F.lit(1)).withColumn("sha", F.lit("x"))
    for hash_of in (F.xxhash64, lambda c: F.length(c).cast("long")):
        got = [tuple(r) for r in exact_duplicates(docs, 2, hash_of).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert exact_duplicates(docs.limit(0)).count() == 0


def test_line_report_against_brute_force(spark):
    rows = [(i % 9 if i % 5 else None, "\n".join(["common line here %d" % (j % 3), " COMMON LINE here 0", "x", "é" * 9, "Éé" * 5][: 1 + (i + j) % 5]) if i % 7 else [None, ""][i % 2])
            for i in range(40) for j in range(3)]

    def key(line):
        return lower(re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))

    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(MAX_ID if i is None else i)
    want = []
    for i, t in rows:
        all_lines, j = (t or "").split("\n"), MAX_ID if i is None else i
        kept = [x for x in all_lines if len(key(x)) < 10 or len(held[key(x)]) == 1 or min(held[key(x)]) == j]
        want.append((i, len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    docs = spark.createDataFrame(rows, KIND).repartition(7)
    assert sorted(map(tuple, lines.line_report(docs).collect()), key=str) == sorted(want, key=str)
    odd = docs.withColumn("row", F.lit(2)).withColumn("lost", F.lit("q")).withColumn("id", F.lit(1)).withColumn("n_chars", F.lit(9))
    new = lines.drop_repeated_lines(odd)
    assert new.dtypes == odd.dtypes and new.count() == len(rows)
    assert sorted(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in new.collect()) == sorted(w[3] for w in want)
    assert lines.line_report(docs.limit(0)).count() == 0


def test_a_hot_line_is_settled_across_partitions(spark):
    docs = spark.range(600).select(F.col("id").alias("doc_id"), F.concat(F.lit("a very common line\nown line number "), F.col("id")).alias("text"))
    got = {r["doc_id"]: r["n_dropped"] for r in lines.line_report(docs).collect()}
    assert got == {i: int(i > 0) for i in range(600)}


def slow_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_against_brute_force(spark):
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(["a", "B", "c"]) for _ in range(r.randint(0, 6)))) for i in range(300)] + [(None, "a B c"), (300, None), (7, "a")]
    docs = spark.createDataFrame(rows, KIND).withColumn("h", F.lit("x"))
    got = simhash.near_duplicates(docs).collect()
    assert sorted((str(x["doc_id"]), x["fingerprint"]) for x in got) == sorted((str(i), "%016x" % slow_simhash(t)) for i, t in rows)
    fps = {int(x["fingerprint"], 16) for x in got}
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= 2:
                root[find(a)] = find(b)
    least = defaultdict(lambda: MAX_ID)
    for x in got:
        if x["doc_id"] is not None:
            f = find(int(x["fingerprint"], 16))
            least[f] = min(least[f], x["doc_id"])
    assert all(x["component_id"] == least[find(int(x["fingerprint"], 16))] for x in got)
    one = simhash.keep_one(docs)
    assert one.columns == docs.columns and sorted(x["doc_id"] for x in one.collect()) == sorted(least.values())
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_trie_join_finds_every_pair(spark):
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 40, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(i)) ^ (np.uint64(1) << np.uint64(j)) for b in base for i, j in r.integers(0, 64, (8, 2))]
    xs = np.unique(np.concatenate((base, np.array(near, np.uint64))))
    for k in (2, 3):
        want = {frozenset((int(a), int(b))) for i, a in enumerate(xs) for b in xs[i + 1:][np.bitwise_count(xs[i + 1:] ^ a) <= k]}
        fps = spark.createDataFrame([(int(x),) for x in xs.view(np.int64)], "fp long")
        got = {frozenset((x["a"] % (1 << 64), x["b"] % (1 << 64))) for x in simhash.trie_self_join(fps, k).collect()}
        assert got == want


def test_components_of_a_path(spark):
    links = spark.range(200).selectExpr("id + 1 AS a", "id AS b").filter("a != 100")
    got = {r["x"]: r["root"] for r in simhash.components(links).collect()}
    assert got == {i: 0 if i < 100 else 100 for i in range(201) if i != 99} | {99: 0}


def test_one_large_class_is_spread(spark, tmp_path):
    """Nine tenths of the values in one class, one value with very many neighbours: no task gets most rows of a stage."""
    links = spark.range(1, 901).selectExpr("id AS a", "id div 30 AS b").unionAll(spark.range(1, 300).selectExpr("id + 20000 AS a", "20000L AS b")).unionAll(spark.range(50).selectExpr("30000 + 2 * id AS a", "30001 + 2 * id AS b"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        labels = simhash.components(links)
        got = {r["x"]: r["root"] for r in labels.collect()}
        one = spark.range(900).selectExpr("id AS fp", "IF(id < 800, 0L, id) AS root")
        ids = one.groupBy("root").agg(F.min("fp").alias("component_id"))
        spread = simhash.spread_join(one, ids, "root", "fp").withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == {i: 0 for i in range(901)} | {20_000 + i: 20_000 for i in range(300)} | {30_000 + i: 30_000 + i // 2 * 2 for i in range(100)}
    assert sum(r["count"] for r in spread) == 900 and max(r["count"] for r in spread) < 200


def test_passages_against_brute_force(spark, monkeypatch):
    r = random.Random(5)
    words = ["w%d" % i for i in range(400)]
    shared = [[r.choice(words) for _ in range(r.randint(45, 90))] for _ in range(6)]
    rows = []
    for i in range(200):
        t = []
        for _ in range(r.randint(1, 4)):
            t += [r.choice(words) for _ in range(r.randint(0, 60))]
            if r.random() < 0.6:
                p = r.choice(shared)
                t += p[r.randint(0, 20):] if r.random() < 0.3 else p
        rows.append((i // 2 if i < 20 else i if i % 50 else None, " ".join(t)))
    seen = defaultdict(set)
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 49):
            seen[tuple(w[k:k + 50])].add(i)
    want = []
    for i, t in rows:
        w, merged = t.split(), []
        for k in range(len(w) - 49):
            if len(seen[tuple(w[k:k + 50])]) > 1:
                if merged and k <= merged[-1][1]:
                    merged[-1][1] = k + 50
                else:
                    merged.append([k, k + 50])
        if merged:
            want.append((i, ",".join(f"{a}:{b}" for a, b in merged)))
    docs = spark.createDataFrame(rows + [(900, None), (901, ""), (902, "a b")], KIND).repartition(5)
    for hot in (suffix.HOT, 3):
        monkeypatch.setattr(suffix, "HOT", hot)
        got = [(x["doc_id"], x["spans"]) for x in suffix.repeated_passages(docs).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)
    assert suffix.repeated_passages(docs.limit(0)).count() == 0


def classes(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    out = defaultdict(set)
    for x in nodes:
        out[find(x)].add(x)
    return {frozenset(c) for c in out.values()}


def test_partners_link_all_documents_that_share_passages(spark, monkeypatch):
    r = random.Random(8)
    words = ["w%d" % i for i in range(5000)]

    def some(n):
        return [r.choice(words) for _ in range(n)]

    one, long = some(60), some(110)
    rows = [(i, " ".join(some(5) + one + some(5))) for i in range(60)]
    # Pieces of a longer passage, some of which share nothing but a third piece.
    rows += [(100 + i, " ".join(some(5) + long[s:s + 55] + some(5))) for i, s in enumerate(r.choices(range(0, 56, 5), k=40))]
    # Two groups that a document of many partners holds together.
    left, seed, right = some(19), some(31), some(19)
    rows += [(200 + i, " ".join(some(5) + left + seed + some(5))) for i in range(8)] + [(220 + i, " ".join(some(5) + seed + right + some(5))) for i in range(8)]
    rows += [(240, " ".join(some(5) + left + seed + right + some(5)))]
    held = defaultdict(set)
    for i, t in rows:
        w = t.split()
        for k in range(len(w) - 49):
            held[tuple(w[k:k + 50])].add(i)
    nodes = {i for s in held.values() if len(s) > 1 for i in s}
    shared = {i: set().union(*(s for s in held.values() if i in s)) for i in nodes}
    want = classes(nodes, [(min(s), i) for s in held.values() if len(s) > 1 for i in s])
    docs = spark.createDataFrame(rows, KIND).repartition(5)
    for hot in (suffix.HOT, 3):
        monkeypatch.setattr(suffix, "HOT", hot)
        got = {x["doc_id"]: x["partners"] for x in suffix.repeated_passages(docs).collect()}
        assert got.keys() == nodes and all(set(ps) <= shared[i] - {i} for i, ps in got.items())
        found = classes(nodes, [(i, x) for i, ps in got.items() for x in ps])
        assert found == want, (hot, len(found), len(want))


def test_passages_of_documents_without_an_id(spark, monkeypatch):
    r = random.Random(9)

    def some(n):
        return ["w%d" % r.randint(0, 5000) for _ in range(n)]

    both, mixed, twice = some(60), some(70), " ".join(some(80))
    rows = [(None, " ".join(some(n) + both)) for n in range(1, 13)] + [(None, twice)] * 9
    rows += [(i if i % 3 else None, " ".join(some(i) + mixed)) for i in range(1, 13)]
    # One id with many texts: only those that another document shares.
    alone = some(60)
    rows += [(50, " ".join(some(n) + alone)) for n in range(1, 13)] + [(50, " ".join(some(3) + mixed))]
    want = [(None, "%d:%d" % (n, n + 60)) for n in range(1, 13)] + [(i if i % 3 else None, "%d:%d" % (i, i + 70)) for i in range(1, 13)] + [(50, "3:73")]
    docs = spark.createDataFrame(rows, KIND).repartition(5)
    for hot in (suffix.HOT, 3):
        monkeypatch.setattr(suffix, "HOT", hot)
        got = [(x["doc_id"], x["spans"]) for x in suffix.repeated_passages(docs).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), hot
