"""Benchmark: the reference's three programs at their default parameters.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:

  {"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Queries (each timed end to end, results forced with a small collect):
  dictionary        word counts + top-K dictionary of the training side
  task_lr_full      LR (L-BFGS, <= 100 iterations) on K = 20,000 words
  task_svm_full     linear SVM (<= 400 iterations, rate 0.001) on K = 20,000 words
  task_reduced_both LR + SVM on m = 10,000 words chosen by coefficient weight,
                    reading the coefficient report task_svm_full wrote
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verbum.params import Params  # noqa: E402
from verbum.plans import tasks as tk  # noqa: E402
from verbum.session import build_session, scratch_path  # noqa: E402
from verbum.sources.coefficients import load_coefficients  # noqa: E402
from verbum.sources.corpus import TEST, TRAIN, fixture_corpus  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", app="verbum-bench", shuffle_partitions=int(cpus) * 2)
    params = Params()
    # the small fixture is one file with one row group: deal it over the cores
    train, test = (fixture_corpus(spark, sf_dir, side, partitions=int(cpus)) for side in (TRAIN, TEST))
    times: dict[str, float] = {}
    info: dict[str, object] = {}

    t = time.time()
    d = tk.dictionary_of(train, params.k)
    info["dictionary_rows"] = d.count()
    times["dictionary"] = time.time() - t

    t = time.time()
    r = tk.task_lr_full(train, test, params)
    info["lr_full"] = r.metrics.select("tp", "fp", "fn", "tn", "f1_pct").first().asDict()
    times["task_lr_full"] = time.time() - t

    t = time.time()
    r = tk.task_svm_full(train, test, params)
    info["svm_full"] = r.metrics.select("tp", "fp", "fn", "tn", "f1_pct").first().asDict()
    info["svm_full_iterations"] = r.model.iterations
    # as in the reference, task 2 writes the coefficient report task 3 reads
    coef_path = tk.write_svm_coefficients(r, params, scratch_path(spark, "coefficient-report"))
    times["task_svm_full"] = time.time() - t

    t = time.time()
    rows, _, svm = tk.task_reduced_both(train, load_coefficients(spark, coef_path), test, params)
    info["reduced"] = [x.asDict() for x in rows.collect()]
    info["svm_reduced_iterations"] = svm.model.iterations
    times["task_reduced_both"] = time.time() - t

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": int(cpus),
        "info": info,
    }
    print(json.dumps(out, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
