"""Each stage's written rows against plain Python, on a table and on odd rows."""

import os
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from test_dedup import lower, slow_simhash
from verbum.llm import mixing, quality

SF001 = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def row_key(r):
    return tuple(str(x) for x in r)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=row_key)


def odd_documents(spark):
    rows = [(None, None, None, None, None)] * 3 + [(1, "", "en", "a", 0)] * 2 + [(2, " \t\n ", "en", None, 4), (2, "two texts of one id", "de", "a", 19), (2, "two texts of one id", "fr", "a", 19)]
    rows += [(3, "one line here\n" * 5 + "x", None, "b", 71), (4, "one line here\nanother one", "en", "b", 25), (5, "one line here\nanother one", "en", "b", 25)]
    rows += [(i, " ".join(f"word{(i * j) % 11}" for j in range(30)), "en", "abc"[i % 3], 1) for i in range(10, 40)]
    rows += [(None, "no id " * 40, "en", "c", 1), (50, "long " * 300_000, "en", "c", 1_500_000)]
    return spark.createDataFrame(rows, COLUMNS)


def check_lines(before, after):
    def key(line):
        return lower(line.strip(" \t\n\x0b\x0c\r"))

    top = 1 << 63
    held = defaultdict(set)
    for r in before:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= 10:
                held[key(line)].add(top if r[0] is None else r[0])

    def kept(r):
        own = top if r[0] is None else r[0]
        return "\n".join(x for x in (r[1] or "").split("\n") if len(key(x)) < 10 or len(held[key(x)]) == 1 or min(held[key(x)]) == own)

    assert Counter((r[0], kept(r), *r[2:4]) for r in before) == Counter((r[0], r[1] or "", *r[2:4]) for r in after)
    assert all(r[4] == len(r[1]) for r in set(after) - set(before))  # rewritten rows are counted anew


def check_near_duplicates(before, after):
    fps = {r: slow_simhash(r[1]) for r in set(before)}
    root = {f: f for f in fps.values()}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 2:
                root[find(a)] = find(b)
    classes = defaultdict(list)
    for r in before:
        classes[find(fps[r])].append(r)
    stays = {c: min((r[0] is None, r[0] or 0) for r in rows) for c, rows in classes.items()}
    assert Counter(find(fps[r]) for r in after) == Counter(dict.fromkeys(classes, 1))
    assert all((r[0] is None, r[0] or 0) == stays[find(fps[r])] and r in set(before) for r in after)


def check_packing(before, after):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = defaultdict(int)
    for r in before:
        want[r[0]] += len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1
    got, used = defaultdict(int), defaultdict(int)
    for r in after:
        got[r["doc_id"]] += r["length"]
        used[r["sequence_id"]] += r["length"]
    assert got == want and all(n == 1024 or n < 1024 and n & (n - 1) == 0 for n in used.values())


def run_stages(spark, docs, folder):
    """(name, rows before, DataFrame before, DataFrame after) of each stage, written as the pipeline writes them."""
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF001).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        yield name, docs, after
        docs = after


@pytest.mark.parametrize("odd", [False, True])
def test_every_stage_against_plain_python(spark, tmp_path, odd):
    docs = odd_documents(spark) if odd else spark.read.parquet(os.path.join(SF001, "documents.parquet"))
    labels = spark.read.parquet(os.path.join(SF001, "labels.parquet"))
    seen = []
    for name, before, after in run_stages(spark, docs, tmp_path):
        seen.append(name)
        if name != "packing":
            assert after.columns == docs.columns
        old, new = rows_of(before), rows_of(after)
        if name == "quality":
            good = {r["doc_id"] for r in quality.quality_scores(before, labels).filter("predicted = 1").collect()}
            if odd:  # ids are not unique: the score is that of the text
                scores = Counter(r["predicted"] for r in quality.quality_scores(before, labels).collect())
                assert len(new) == scores[1] and not Counter(new) - Counter(old)
            else:
                assert {r[0] for r in new} == good and new == [r for r in old if r[0] in good]
                known = {r["doc_id"]: r["quality"] for r in labels.collect()}
                assert sum(known.get(i, 1) for i in good) >= 0.9 * sum(known.get(r[0], 1) for r in old)
        elif name == "lines":
            check_lines(old, new)
        elif name == "near_duplicates":
            check_near_duplicates(old, new)
        elif name == "mixing":
            copies = Counter()
            for r in mixing.mix(before).collect():
                copies[r["doc_id"]] += r["copies"]
            assert Counter(r[0] for r in new) == +copies and not set(new) - set(old)
        else:
            check_packing(old, after.collect())
    assert seen == ["quality", "lines", "near_duplicates", "mixing", "packing"]


def test_stages_on_extra_columns_and_ties(spark):
    """Columns whose names the operators use themselves, rows that tie in everything: each stage keeps the columns."""
    docs = odd_documents(spark).withColumns({c: F.lit(c) for c in ("h", "row", "fp", "id", "times", "root", "k", "_salt", "bucket")})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF001)
        assert out.columns == docs.columns, name
        assert {r["fp"] for r in out.collect()} <= {"fp"}, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF001).count() > 0


def test_run_leaves_only_its_result(spark):
    from verbum.session import checkpoint_root

    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    out = corpus_pipeline.run(spark, SF001)
    assert out.count() > 0
    left = set(os.listdir(root)) - before
    assert len(left) == 1 and [x for x in os.listdir(os.path.join(root, *left)) if not x.startswith(".")] == ["packing"]
