"""Tasks as a job on text files: corpus files in, report files out, nothing left behind."""

import os

import numpy as np
import pytest

from verbum.job import run_job
from verbum.params import FIXTURE_PARAMS as P
from verbum.session import checkpoint_root
from verbum.sources import load_coefficients
from verbum.sources.corpus import TEST, TRAIN, fixture_corpus

from conftest import SF001


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    for side in (TRAIN, TEST):
        fixture_corpus(spark, SF001, side).write.text(f"{folder}/{side}")
    return folder


def _report(spark, path):
    return [r.value for r in spark.read.text(path).collect()]


def _left(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    return set(os.listdir(root)), spark.sparkContext._jsc.getPersistentRDDs().size()


@pytest.mark.parametrize("task", ["svm", "lr"])
def test_a_task_and_the_reduced_task_on_its_coefficients(spark, corpus, tmp_path, task):
    before = _left(spark)
    coefs, out = f"{tmp_path}/coefficients", f"{tmp_path}/report"
    run_job(spark, task, f"{corpus}/train", f"{corpus}/test", out, coefficients_out=coefs, params=P)
    lines = _report(spark, out)
    assert lines[0].startswith("F1 score") and sum(int(x.split(" = ")[1]) for x in lines[1:]) == 39  # one of 40 has no dictionary word
    w = load_coefficients(spark, coefs).orderBy("pos").toPandas()
    assert list(w["pos"]) == list(range(P.k)) and np.isfinite(w["coef"]).all() and w["coef"].abs().max() > 0

    run_job(spark, "both", f"{corpus}/train", f"{corpus}/test", f"{tmp_path}/both", coefficients=coefs, params=P)
    lines = _report(spark, f"{tmp_path}/both")
    assert len(lines) == 12 and lines[0] == f"linear_svm on {P.m} words" and lines[6] == f"logistic_regression on {P.m} words"
    assert _left(spark) == before


def test_the_reduced_task_needs_coefficients(spark, corpus, tmp_path):
    with pytest.raises(ValueError, match="coefficient"):
        run_job(spark, "both", f"{corpus}/train", f"{corpus}/test", f"{tmp_path}/out", params=P)


def test_a_stopped_job_goes_on(spark, corpus, tmp_path, monkeypatch):
    """The second run starts at the state of the first and writes the report that an undisturbed run writes."""
    from verbum.operators import svm

    p, folder = P.with_(svm_max_iter=4), f"file:{tmp_path}/state"
    run_job(spark, "svm", f"{corpus}/train", f"{corpus}/test", f"{tmp_path}/whole", params=p)
    run_job(spark, "svm", f"{corpus}/train", f"{corpus}/test", f"{tmp_path}/half", params=p.with_(svm_max_iter=2), resume=folder)
    passes, real = [], svm._iteration_sums
    monkeypatch.setattr(svm, "_iteration_sums", lambda *a: passes.append(1) or real(*a))
    run_job(spark, "svm", f"{corpus}/train", f"{corpus}/test", f"{tmp_path}/rest", params=p, resume=folder)
    assert len(passes) == 2 and _report(spark, f"{tmp_path}/rest") == _report(spark, f"{tmp_path}/whole")
    with pytest.raises(ValueError, match="resumed"):
        run_job(spark, "lr", f"{corpus}/train", f"{corpus}/test", f"{tmp_path}/no", params=p, resume=folder)
