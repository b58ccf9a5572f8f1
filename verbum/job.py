"""The three tasks as a job on text files: ``python -m verbum.job TASK TRAIN TEST OUT``.

  svm   linear SVM on the full dictionary; ``--coefficients-out`` writes its coefficient report,
        ``--resume`` names a shared folder: a stopped training goes on from its last state there
  lr    logistic regression on the full dictionary; ``--coefficients-out`` likewise
  both  both models on a reduced dictionary; ``--coefficients`` names a coefficient report

Paths are folders or files that Spark reads; OUT gets the text report.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from verbum.operators.evaluate import comparison_report
from verbum.params import Params
from verbum.plans import tasks as tk
from verbum.session import own_tables
from verbum.sources import load_coefficients, scan_corpus, write_report


def run_job(spark: SparkSession, task: str, train: str, test: str, out: str, coefficients: str | None = None,
            coefficients_out: str | None = None, params: Params = Params(), resume: str | None = None) -> str:
    """Run one task from corpus files to the written report; tables made on the way are removed, the folder ``resume`` is not."""
    train_lines, test_lines = scan_corpus(spark, train), scan_corpus(spark, test)
    with own_tables(spark):
        if task == "both":
            if coefficients is None:
                raise ValueError("the task on a reduced dictionary needs a coefficient report")
            rows, _, _ = tk.task_reduced_both(train_lines, load_coefficients(spark, coefficients), test_lines, params)
            return write_report(comparison_report(rows), out)
        run, write = {"svm": (tk.task_svm_full, tk.write_svm_coefficients), "lr": (tk.task_lr_full, tk.write_lr_coefficients)}[task]
        if resume is not None and task != "svm":
            raise ValueError("only the SVM's training can be resumed")
        result = run(train_lines, test_lines, params, **({"resume": resume} if resume is not None else {}))
        if coefficients_out is not None:
            write(result, params, coefficients_out)
        return write_report(result.report, out)


def main() -> None:
    a = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    a.add_argument("task", choices=["svm", "lr", "both"])
    for path in ("train", "test", "out"):
        a.add_argument(path)
    a.add_argument("--coefficients")
    a.add_argument("--coefficients-out")
    a.add_argument("--resume")
    args = a.parse_args()
    spark = SparkSession.builder.appName("verbum").getOrCreate()
    run_job(spark, args.task, args.train, args.test, args.out, args.coefficients, args.coefficients_out, resume=args.resume)
    spark.stop()


if __name__ == "__main__":
    main()
