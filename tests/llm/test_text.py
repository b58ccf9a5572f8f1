import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from verbum.llm import fingerprint, mixing, packing, pii, quality, urls

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
KIND = "doc_id long, text string"


def slow_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        g = re.sub("[^0-9]", "", m[0])
        if 14 <= len(g) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(g[::-1])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_are_those_of_the_plain_patterns():
    r = random.Random(3)
    for signs in ("ab@.@-+1 2 3.4 5%_()é\n0 9", "0123456789 - .+x"):
        for _ in range(8000):
            t = "".join(r.choice(signs) for _ in range(r.randint(0, 60)))
            assert pii.base_spans(t) == slow_spans(t), t


def test_disguises_map_back_to_the_source(spark):
    cases = [("mail john.doe [at] example [dot] com now", "john.doe [at] example [dot] com"), ("bob at example dot co dot uk", "bob at example dot co dot uk"),
             ("ask аlice@exаmple.com ok", "аlice@exаmple.com"), ("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
             ("call plus one five five five one two three four five six seven please", "plus one five five five one two three four five six seven"),
             ("ip one nine two dot one six eight dot zero dot one", "one nine two dot one six eight dot zero dot one"),
             ("dial +1 415 five five five 0123 today", "+1 415 five five five 0123"), ("or + four nine three zero double one 234 56", "+ four nine three zero double one 234 56"),
             ("card four one one one 1111 1111 one one one one, 2024", "four one one one 1111 1111 one one one one"),
             ("write to jane.doe at example.com today", "jane.doe at example.com"), ("user42 at mail.example.org", "user42 at mail.example.org"),
             ("juan arroba ejemplo punto com", "juan arroba ejemplo punto com"), ("moi arobase exemple.fr", "moi arobase exemple.fr"),
             ("jàne@exámple.com", "jàne@exámple.com"), ("(ɑlice@example.com)", "ɑlice@example.com"), ("name_at_example_dot_com", "name_at_example_dot_com"),
             ("they were there in 2019 at example.com", None), ("look at v2.0 at example.com", None), ("élan à l'école, façade", None), ("np_dot_product_at_scale", None),
             ("at 10 one two three, 2024 five", None),
             ("look at example.com and the dot matrix", None), ("we saw one two three four things at home", None), (None, None), ("", None)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)] + [(None, "a@b.c"), (None, "a@b.c")], KIND).withColumn("spans", F.lit(1))
    got = pii.find_personal_data(docs).collect()
    for r in got:
        if r["doc_id"] is None:
            assert (r["n_email"], r["spans"]) == (1, "email:0:5")
            continue
        text, want = cases[r["doc_id"]]
        found = [text[int(a):int(b)] for _, a, b in (s.split(":") for s in r["spans"].split(",") if s)]
        base_found = [text[a:b] for a, _, b in slow_spans(text or "")]  # ASCII ends of a disguised one
        assert [x for x in found if x not in base_found] == ([want] if want else []), text
        assert r["n_added"] == bool(want)
        base = slow_spans(text or "")
        assert r["base_sha256"] == hashlib.sha256(pii.written(base).encode()).hexdigest()
    assert len(got) == len(cases) + 2 and pii.find_personal_data(docs.limit(0)).count() == 0


def test_a_disguised_span_inside_a_long_base_span_is_left_out():
    """However many base spans lie between: the enclosing one counts."""
    inner = "1.2.3.4" + "".join(f".{i % 9}.2.3.4" for i in range(12))
    text = f"x{inner}@example.com and bob [at] example [dot] com"
    base = pii.base_spans(text)
    assert len(base) > 9
    spans = pii.disguised_spans(text, base)
    assert [text[a:b] for a, _, b in spans] == ["bob [at] example [dot] com"]
    # The same with a look-alike inside the address' end: it lies in a base span that starts far before it.
    assert not [s for s in pii.disguised_spans("a" + ".1.2.3.4" * 10 + "@example.com \u2010", pii.base_spans("a" + ".1.2.3.4" * 10 + "@example.com \u2010"))]


def test_personal_data_in_very_long_texts(spark):
    rows = [(1, "a@" * 500_000 + "b.c"), (2, "1 2 3 4 5 6 7 8 9 " * 200_000), (3, "one two three four " * 100_000), (4, "x" * 5_000_000 + " bob [at] example [dot] com"), (5, "é" * 1_000_000 + "@"), (6, "+1" * 1_000_000)]
    got = {r["doc_id"]: r for r in pii.find_personal_data(spark.createDataFrame(rows, KIND)).collect()}
    assert got[1]["n_email"] == 1 and got[4]["spans"] == "email:5000001:5000027" and len(got) == 6


def test_urls_against_brute_force(spark):
    odd = [None, "", "nohost", "http://", "http://NET/", "http://a.NET", "http://x.example.net/en/?q", "http://x.example.net/en", "http://example.com/de/x#y", "http://xexample.com/de/",
           "https://a.b.org/fr/1", "://org/fr/", "http://a?://net/", "x://y://net/", "http://net:80/", "http://a.net/b\nc", "http://..net/", "http://a.net?/x", "http://a.net#/x", "http://net/"]

    def brute(x):
        if x is None or "://" not in x:
            return "", "", None, "allow"
        rest = x.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        host, path = raw.lower(), re.match(r"[^?#]*", rest[len(raw):])[0]
        fits = [(len(r), r, v) for r, v in urls.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.index("/"):])]
        return (host, path, *max(fits)[1:]) if fits else (host, path, None, "allow")

    pages = spark.createDataFrame([(i if i % 4 else None, x) for i, x in enumerate(odd + odd)], "page_id long, url string").withColumn("host", F.lit(1))
    want = [(r["page_id"], *brute(r["url"])) for r in pages.collect()]
    assert sorted(map(tuple, urls.judge_urls(pages).collect()), key=str) == sorted(want, key=str)
    assert urls.judge_urls(pages.limit(0)).count() == 0


def test_urls_with_very_long_hosts(spark):
    hosts = [".".join(["a"] * 200_000) + ".example.net", "a" * 2_000_000 + ".net", "." * 100_000 + "net", "b." * 100_000]
    pages = spark.createDataFrame([(i, f"http://{h}/en/x") for i, h in enumerate(hosts)] + [(9, "http://net/" + "x" * 3_000_000)], "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in urls.judge_urls(pages).collect()}
    assert got == {0: (hosts[0], "example.net/en/", "allow"), 1: (hosts[1], "net/", "block"), 2: (hosts[2], "net/", "block"), 3: (hosts[3], None, "allow"), 9: ("net", "net/", "block")}
    assert {r["verdict"] for r in urls.judge_urls(pages, rules=[], otherwise="block").collect()} == {"block"}


def _shingles(t):
    w = t.encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints_estimate_the_shared_shingles(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), reverse=True)
    got = {r["doc_id"]: r for r in fingerprint.fingerprints(docs).collect()}
    error = []
    for k, (i, t) in enumerate(rows):
        new = fingerprint.edited(t, rows[(k + 1) % len(rows)][1])
        a, b = _shingles(t), _shingles(new)
        assert got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest() and got[i]["n_chars"] == len(t)
        error.append(got[i]["near_edited"] - len(a & b) / len(a | b))
    assert abs(np.mean(error)) < 0.01 and np.std(error) < 0.06
    same = defaultdict(set)
    for i, t in rows:
        same[t].add(got[i]["fingerprint"])
    assert all(len(f) == 1 for f in same.values())
    odd = spark.createDataFrame([(5, "a b"), (5, "a b"), (None, None), (None, "x y"), (2, "")], KIND).withColumn("seq", F.lit(1))
    assert fingerprint.fingerprints(odd).count() == 5 and fingerprint.fingerprints(odd.limit(0)).count() == 0
    assert fingerprint.fingerprints(odd.limit(1)).first()["near_next"] == 1.0


def test_fingerprints_of_hot_ids(spark):
    """A third of the rows without an id, a third of one id, of these many of one text: each row meets the one the order says."""
    r = random.Random(3)

    def text():
        return " ".join(r.choice("abcdefg") for _ in range(r.randint(1, 12)))

    rows = [(None, text()) for _ in range(150)] + [(None, "same text of many")] * 150 + [(2 ** 40 + 7, text()) for _ in range(150)] + [(2 ** 40 + 7, "another one")] * 150
    rows += [(i, text()) for i in range(150)] + [(-i, text()) for i in range(1, 150)] + [(2 ** 60 + i, text()) for i in range(5)]
    docs = spark.createDataFrame(rows, KIND).repartition(5)
    hashed = [(x["doc_id"], x["text"], x["h"]) for x in docs.withColumn("h", F.xxhash64("text")).collect()]
    order = sorted(hashed, key=lambda x: (x[0] is None, -(x[0] or 0), x[2]))
    want = []
    for k, (i, t, _) in enumerate(order):
        new = fingerprint.edited(t, order[(k + 1) % len(order)][1])
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest()))
    for size in (fingerprint.RANGE_ROWS, 5):
        got = [tuple(x)[:3] for x in fingerprint.fingerprints(docs, size).collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    text = {r["doc_id"]: r for r in docs.collect()}
    got = mixing.mix(docs).collect()
    size, taken, target, longest = (defaultdict(float) for _ in range(4))
    for r in got:
        d = text[r["doc_id"]]
        s = d["source"]
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", d["text"])) and r["taken"] in (0, r["size"], 2 * r["size"])
        size[s] += r["size"]
        taken[s] += r["taken"]
        target[s], longest[s] = r["target"], max(longest[s], r["size"])
    assert len(got) == len(text) and all(abs(taken[s] - target[s]) <= longest[s] for s in size)
    weight, total, full = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}, 1.5 * sum(size.values()), set()
    while True:
        level = (total - sum(2 * size[s] for s in full)) / sum(weight[s] for s in size if s not in full)
        more = {s for s in size if s not in full and weight[s] * level > 2 * size[s]}
        if not more:
            break
        full |= more
    assert all(abs(target[s] - (2 * size[s] if s in full else weight[s] * level)) < 1e-6 * target[s] for s in size)
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_mix_of_odd_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "x"), (None, None, None), (2, "", None), (3, "  ", "y")], "doc_id long, text string, source string").withColumn("h", F.lit("s"))
    assert sorted(r["taken"] for r in mixing.mix(docs).collect()) == [0, 0, 0, 3, 6]
    assert mixing.mixed(docs).columns == docs.columns and [r["doc_id"] for r in mixing.mixed(docs).collect()] == [1, 1, 1]
    assert mixing.mix(docs.limit(0)).count() == 0
    monkeypatch.setattr(mixing, "LEAF", 3)  # several levels of the tree
    monkeypatch.setattr(mixing, "FAN", 2)
    many = spark.range(100).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"), (F.col("id") % 2).cast("string").alias("source"))
    rows = mixing.mix(many).collect()
    by = defaultdict(lambda: [0, 0])
    for r in rows:
        by[r["target"]][0] += r["taken"]
    assert len(rows) == 100 and all(abs(t - v[0]) <= 7 for t, v in by.items())


def test_mix_of_equal_rows_and_hot_keys(spark, monkeypatch):
    """A third of all rows without an id and of one text, in one source: they are spread, and settled like any other."""
    monkeypatch.setattr(mixing, "LEAF", 8)
    monkeypatch.setattr(mixing, "FAN", 4)
    rows = [(None, "one two three", "hot")] * 300 + [(i, "w " * (i % 9), ["hot", "cold", None][i % 3]) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixing.mix(docs).collect()
    taken, target, empties = defaultdict(int), {}, 0
    for r in got:
        taken[r["source_size"]] += r["taken"]
        target[r["source_size"]] = r["target"]
        assert r["copies"] in (0, 1, 2) and (r["size"] > 0 or r["copies"] <= r["target"] / r["source_size"] + 1e-6)
    assert len(got) == 900 and all(abs(taken[s] - t) <= 9 for s, t in target.items())
    key = lambda r: str(sorted(r.asDict().items(), key=str))
    assert sorted(map(key, mixing.mix(docs.repartition(3)).collect())) == sorted(map(key, got))
    copies = defaultdict(int)
    for r in got:
        copies[r["doc_id"]] += r["copies"]
    again = defaultdict(int)
    out = mixing.mixed(docs)
    for r in out.collect():
        again[r["doc_id"]] += 1
        assert tuple(r) in set(rows)
    assert out.columns == docs.columns and sum(again.values()) > 900
    # the buckets of the equal rows
    start = mixing.sized(docs).groupBy(*mixing._KEY).count()
    assert start.agg(F.max("count")).first()[0] == 300


def test_pivotal_rounding_keeps_expectations():
    """Over many seeds a row is rounded up as often as its fraction says, and words never change within a pair."""
    import pyarrow as pa

    def batch(ps):
        rows = [dict(doc_id=i, h=0, r=0, k=0, size=10 + i, rank=0, bucket=0, source_size=0, target=0.0, base=0, p=p) for i, p in enumerate(ps)]
        return pa.RecordBatch.from_pylist(rows, pa.schema([(f, k) for f, k in zip(mixing._FIELDS, mixing._KINDS)]))

    ps = [0.2, 0.7, 0.5, 0.35, 0.9, 0.1]
    up = np.zeros(len(ps))
    for seed in range(3000):
        for out in mixing._pivot(0, True, seed)(iter([batch(ps)])):
            for r in out.to_pylist():
                assert r["base"] in (0, 1)
                up[r["doc_id"]] += r["base"]
    # the last row of the tree is rounded to the nearer whole, so a source is off by part of one row
    assert np.abs(up / 3000 - ps).max() < 0.2 and abs((up / 3000 * (10 + np.arange(6))).sum() - (np.array(ps) * (10 + np.arange(6))).sum()) < 8
    for seed in range(200):
        a, b = [0] * 11, [0] * 11
        a[mixing._SIZE], b[mixing._SIZE], a[-1], b[-1] = 13, 29, 0.4, 0.7
        mixing._settle(a, b, random.Random(seed))
        assert abs(13 * a[-1] + 29 * b[-1] - (13 * 0.4 + 29 * 0.7)) < 1e-9 and min(abs(a[-1]), abs(1 - a[-1]), abs(b[-1]), abs(1 - b[-1])) < 1e-9


def test_packed_tokens_round_trip(spark):
    r = random.Random(1)
    signs = list("ab cd  \n\t.,'é  　日 本字'sll re12!ß​\x1c\x85<|endoftext|>")
    rows = [(i, "".join(r.choice(signs) for _ in range(r.randint(0, 300)))) for i in range(800)]
    rows += [(9000, None), (9001, ""), (9002, "word, Word\nword " * 20_000), (9003, "x" * 5000)]
    rows += [(10_000 + i, x["text"]) for i, x in enumerate(spark.read.parquet(f"{SF001}/documents.parquet").collect())]
    rows += [(20_000, "a <|endoftext|> b"), (20_001, "<|endoftext|><|endoftext|>x<|endoftext"), (20_002, "<|endoftext|>" * 3000)]
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.createDataFrame(rows, KIND).withColumn("length", F.lit(1))
    for added in (True, False):
        t.encode_special_tokens = not added  # the tokenizer's default is to know its added token
        ids = {i: np.array(t.encode(x or "", add_special_tokens=False).ids + [0], "<u4") for i, x in rows}
        _check_packed(packing.pack(docs, added_tokens=added).collect(), ids)
    assert sum(50256 == i for i in t.encode("a <|endoftext|> b", add_special_tokens=False).ids) == 0
    # blocks far smaller than the table: what one leaves over is carried on
    few = packing.pack(docs.coalesce(1), block_docs=16, added_tokens=False).collect()
    _check_packed(few, ids)
    used = defaultdict(int)
    for x in few:
        used[x["sequence_id"]] += x["length"]
    assert sum(n < 1024 for n in used.values()) <= 10
    assert packing.pack(docs.limit(0)).count() == 0


def _check_packed(got, ids):
    at, used = defaultdict(int), defaultdict(int)
    for x in sorted(got, key=lambda x: (x["doc_id"], x["start"])):
        a = ids[x["doc_id"]]
        assert x["start"] == at[x["doc_id"]] and x["doc_tokens"] == len(a)
        assert x["ids_crc32"] == zlib.crc32(a[x["start"]:x["start"] + x["length"]].tobytes())
        at[x["doc_id"]] += x["length"]
    assert all(at[i] == len(a) for i, a in ids.items())
    for x in sorted(got, key=lambda x: (x["sequence_id"], x["offset"])):
        assert x["offset"] == used[x["sequence_id"]]
        used[x["sequence_id"]] += x["length"]
    assert all(n <= 1024 and n & (n - 1) == 0 for n in used.values())


def slow_place(lengths, capacity, last):
    """The same rule, one step at a time over plain lists."""
    total = sum(lengths)
    room = [capacity] * (total // capacity) + ([2 ** b for b in range(20, -1, -1) if total % capacity >> b & 1] if last else [])
    full, cost, out, left = list(room), [0.0] * len(room), [], []

    def put(i, start, n, s):
        out.append((i, start, n, s, full[s] - room[s]))
        room[s] -= n
        cost[s] += n + n * n / capacity

    def cheapest(need):
        fits = [(cost[s], s) for s in range(len(room)) if room[s] >= need]
        return min(fits)[1] if fits else None

    rest = []
    for n, i in sorted(((n, i) for i, n in enumerate(lengths) if n), key=lambda x: (-x[0], x[1])):
        s = cheapest(n)
        if s is None:
            rest.append((i, n))
        else:
            put(i, 0, n, s)
    for i, n in rest:
        start = 0
        while start < n and cheapest(1) is not None:
            s = cheapest(1)
            m = min(n - start, room[s])
            put(i, start, m, s)
            start += m
        if start < n:
            left.append((i, start, n - start))
    return out, left


def test_places_against_the_plain_rule():
    r = random.Random(7)
    for _ in range(60):
        lengths = [r.choice([0, 1, r.randint(1, 63), r.randint(30, 40)]) for _ in range(r.randint(0, 60))]
        for last in (True, False):
            assert packing.place(np.array(lengths, np.int64), 64, last) == slow_place(lengths, 64, last)


def test_costs_are_balanced():
    r = np.random.default_rng(1)
    lengths = r.integers(1, 700, 2000)
    pieces, _ = packing.place(lengths, 1024, last=False)
    cost, plain = defaultdict(float), defaultdict(float)
    for _, _, n, s, _ in pieces:
        cost[s] += n + n * n / 1024
    # documents end to end, cut at every 1024th token
    at = 0
    for n in lengths.tolist():
        while n:
            m = min(n, 1024 - at % 1024)
            plain[at // 1024] += m + m * m / 1024
            at, n = at + m, n - m
    plain = list(plain.values())[:-1]
    assert np.std(list(cost.values())) < 0.5 * np.std(plain)


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{n}.parquet") for n in ("documents", "labels"))
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality.quality_scores(docs, labels).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] in known]
    assert len(got) == docs.count() and np.mean([r["predicted"] == known[r["doc_id"]] for r in held]) > 0.9
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    good = [r["score"] for r in held if known[r["doc_id"]]]
    bad = [r["score"] for r in held if not known[r["doc_id"]]]
    assert np.mean([a > b for a in good for b in bad]) > 0.9


def test_quality_without_labels_or_text(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, ""), (2, "a b")], KIND).withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(2, None), (7, 3)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert [r["score"] for r in got] == [0.5] * 4 and {r["predicted"] for r in got} == {1}
    assert quality.keep_good(docs, labels).count() == 4 and quality.quality_scores(docs.limit(0), labels).count() == 0
