"""Driver contract: entry(), queries() and oracle_sql() agree; a sample of
queries equals its DuckDB oracle on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from memberlens.sources.tables import TABLES

from .conftest import SF_SMALL

SAMPLE = ["feature_panel", "unit_profile", "metrics_grouping_sets", "bucket_quantile", "active_requests",
          "drift_score", "alert_hold", "best_runs", "auc", "lof", "silence_gaps", "stream_score"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "members_lag1" in df.columns


def test_oracles_have_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 100 and len(o) >= 90


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle_small(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    cols = sorted(ocols)
    key = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=key)
    orows = sorted((tuple(_norm(r[ocols.index(c)]) for c in cols) for r in cur.fetchall()), key=key)
    assert srows == orows
