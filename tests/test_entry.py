"""Driver contract: entry smoke, registry consistency, and oracle agreement on the small fixture."""

import duckdb
import pytest

import __spark_entry__ as E
from oracle.sql import ORACLE_SQL
from verbum.plans.catalog import QUERIES

from conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and df.columns == ["tp", "fp", "fn", "tn", "precision", "recall", "f1", "f1_pct"]


def test_registry():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert set(QUERIES) <= set(s)


def _norm(v):
    if isinstance(v, float):
        return round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_oracle_agreement(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF001}/{table}.parquet')")
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, res.fetchall())


@pytest.mark.parametrize("name", ["lr_train", "lr_certificate", "lr_predict"])
def test_a_wrong_model_fails_its_sql(spark, monkeypatch, name):
    """The query with weights other than those of the fit: the SQL, or the bounds it states, disagree."""
    from verbum.operators import logreg as lg
    from verbum.plans import catalog, published

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    real = catalog.lr_fit

    def wrong(v, k, p):
        fit = real(v, k, p)
        if name == "lr_certificate":  # published and used alike: only the bounds can tell
            return lg.LrFit(fit.w * 0.01, fit.history, fit.model)
        return fit

    monkeypatch.setattr(catalog, "lr_fit", wrong)
    if name != "lr_certificate":
        monkeypatch.setattr(catalog, "publish", lambda spark, n, w: published.publish(spark, n, w + 0.001))
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) != _rows(dcols, res.fetchall())
