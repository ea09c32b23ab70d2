"""Driver contract: entry(), queries() / oracle_sql(), and every query
against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from pricelens.plans.catalog import double_columns, load_all

SF001 = "/root/testdata/sf0.001"

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
CATALOG = load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "nombre_stations" in df.columns


def test_contract_keys():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert set(CATALOG) <= set(qs) and set(CATALOG) <= set(sqls)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(tbl):
    cols = sorted(tbl.column_names)
    data = [tbl.column(c).to_pylist() for c in cols]
    rows = [tuple(_norm(x) for x in r) for r in zip(*data)]
    return cols, sorted(rows, key=repr)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_matches_oracle(spark, duck, name):
    q = CATALOG[name]
    built = q.build(spark, SF001)
    # every double column is rounded on the oracle side too
    if q.sql is not None:
        assert sorted(double_columns(built)) == sorted(q.doubles), name
    got = q.spark(spark, SF001).toArrow()
    if q.sql is None:
        assert got.num_rows >= 0
        return
    want = duck.sql(q.oracle()).to_arrow_table()
    gc, gr = _rows(got)
    wc, wr = _rows(want)
    assert gc == wc
    assert len(gr) == len(wr)
    assert gr == wr
