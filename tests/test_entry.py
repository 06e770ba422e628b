"""Driver contract: entry runs, every key has a callable, oracles cover the SQL-checkable keys,
and a sample of keys matches its DuckDB oracle at sf0.001."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]
ROWS_ONLY = {"pca_project", "fit_forest", "fit_adaboost", "fit_svr", "feature_importance"}


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["model", "params", "mse", "mae"]
    assert {r["model"] for r in rows} >= {"linear", "lasso", "ridge", "global_mean", "entity_mean"}


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    own = {k for k in q if k != "pipeline" and not k.startswith("op")}
    assert own - set(s) == ROWS_ONLY
    assert len(own) >= 100


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", ["rolling_mean", "lag_features", "fill_parent_mean", "zero_pad", "parse_dates",
                                 "join_indicator", "share_of_total", "missing_by_date", "histogram", "pivot_strict",
                                 "split_random", "cv_folds", "impute_median", "grid_search_linear", "spatial_join",
                                 "fit_knn", "event_in_force", "scan_fixed_width"])
def test_key_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF)
    cur = con.execute(E.oracle_sql()[key])
    a = _canon(sdf.columns, [tuple(r) for r in sdf.collect()])
    b = _canon([d[0] for d in cur.description], cur.fetchall())
    assert a == b
