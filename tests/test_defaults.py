"""The registered tasks run at the reference's settings, on a trained model's coefficients."""

import duckdb

import __spark_entry__ as E
from verbum.plans import catalog
from verbum.plans import tasks as tk

from conftest import SF001


def test_model_comparison_at_the_reference_settings(spark, monkeypatch):
    seen = []

    def spy(name, module=tk):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda v, k, params, **kw: seen.append((name, k, params.lr_max_iter if name == "lr_fit" else params.svm_max_iter)) or real(v, k, params, **kw))

    spy("lr_fit")
    spy("lr_fit", catalog)
    spy("svm_train")
    rows = {r["model"]: tuple(r) for r in E.queries()["model_comparison"](spark, SF001).collect()}
    assert sorted(seen) == [("lr_fit", 10000, 400), ("lr_fit", 20000, 100), ("svm_train", 10000, 400), ("svm_train", 20000, 400)]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    for want in con.execute(E.oracle_sql()["svm_model_comparison_defaults"]).fetchall():
        assert rows[want[0]] == want
        lr = rows[want[0].replace("linear_svm", "logistic_regression")]
        assert lr[1] == want[1] and sum(lr[2:6]) == sum(want[2:6])


def test_entry_runs_at_the_reference_settings(spark, monkeypatch):
    seen, real = [], tk.svm_train
    monkeypatch.setattr(tk, "svm_train", lambda v, k, params, **kw: seen.append((k, params.svm_max_iter)) or real(v, k, params, **kw))
    E.entry(spark).collect()
    assert seen == [(20000, 400)]
