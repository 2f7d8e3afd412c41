"""Every registered query against its DuckDB SQL at the smallest scale."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as contract
import oracle
import registry

SF = "/root/testdata/sf0.001"
TABLES = "customer orders events".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return repr(value + 0.0)
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value)


def test_contract_is_complete(spark):
    assert set(registry.QUERIES) == set(oracle.ORACLES)
    assert set(registry.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns[0] == "site_rank"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    result = duck.execute(oracle.ORACLES[name])
    order = [c[0] for c in result.description]
    assert sorted(order) == columns
    places = [order.index(c) for c in columns]
    want = sorted(tuple(plain(r[i]) for i in places) for r in result.fetchall())
    assert got == want


def test_pixels_of_a_long_table_match_oracle(spark, tmp_path):
    """Row keys of 60 times sf0.1: the raster runs to a latitude of 2,238 degrees."""
    con, name = duckdb.connect(), "stg_coastline_distance"
    for table in TABLES:
        con.execute(f"CREATE VIEW {table}0 AS SELECT * FROM '{SF}/{table}.parquet'")
    con.execute("CREATE VIEW shifted AS SELECT * REPLACE (o_orderkey + i * 499_000 AS o_orderkey) FROM orders0, range(19) t(i)")
    for table, source in zip(TABLES, ["customer0", "shifted", "events0"], strict=True):
        con.execute(f"COPY {source} TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    df = registry.QUERIES[name](spark, str(tmp_path))
    columns = sorted(df.columns)
    got = sorted(tuple(plain(v) for v in r) for r in df.select(*columns).collect())
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({oracle.ORACLES[name]})").fetchall()
    assert got == sorted(tuple(plain(v) for v in r) for r in want)
    assert max(r[columns.index("latitude")] for r in want) > 2200
