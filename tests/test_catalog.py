"""Registered queries against their DuckDB oracles at sf0.001 (a fast subset plus the flow)."""

import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF

NAMES = [
    "landing_ingest", "explode_outer_items", "silver_cast", "dedup_latest", "latest_by_max",
    "expect_rejected", "expect_rule_counts", "quarantine_rows", "date_functions", "parse_json_column",
    "upsert_out_of_order", "upsert_actions", "upsert_month_change", "silver_end_to_end", "quarantine_end_to_end",
]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def canon(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in idx) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["lineitem", "orders", "events"]:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    from ledgerflow.plans import catalog

    assert set(catalog.QUERIES) == set(catalog.ORACLES) and set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert canon(df.columns, df.collect()) == canon(o_cols, res.fetchall())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "client_id" in df.columns
