"""Every registered query against its SQL oracle in DuckDB (the driver's check),
on the smallest tables; rows-only entries must run and return rows."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from wharf.sources.tables import TABLES

QUERIES = {k: v for k, v in E.queries().items() if k not in E.LLM_QUERIES}
ORACLE = {k: v for k, v in E.oracle_sql().items() if k not in E.LLM_QUERIES}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"sample_n", "file_listing"}
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _canon(sdf.columns, srows) == _canon(ocols, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["rank", "r_name", "title", "artist", "play_count"]
    assert df.count() > 0
