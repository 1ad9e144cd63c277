"""Every registered query equals its DuckDB oracle on the whole sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = []
    for r in rows:
        vals = []
        for i in order:
            v = r[i]
            if isinstance(v, float):
                v = round(v, 9) if not math.isnan(v) else "nan"
            vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=repr)


def test_every_query_has_an_oracle():
    assert set(E._click_queries()) == set(E._click_oracles())


@pytest.mark.parametrize("name", sorted(E._click_queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rows, cols = df.collect(), df.columns
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _norm(rows, cols) == _norm(orows, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["category_id", "click_count", "order_count", "pay_count"]
    assert 0 < df.count() <= 10
