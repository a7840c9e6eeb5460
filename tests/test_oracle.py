"""Every registered query against its DuckDB twin."""

import os
import time
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tallymark.plans import catalog, oracle

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(rows):
    def show(v):
        if v is None:
            return "NULL"
        if isinstance(v, float):
            return repr(float(v))
        return str(v)

    return sorted(tuple(show(v) for v in row) for row in rows)


def test_every_query_of_the_log_has_a_twin():
    assert catalog.queries().keys() == oracle.oracle_sql().keys()


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_matches_duckdb(spark, duck, key):
    started = time.time()
    df = contract.queries()[key](spark, SF_DIR)
    names = sorted(df.columns)
    got = plain(df.select(*[f"`{n}`" for n in names]).collect())
    print(f"{key}: {time.time() - started:.2f}s, {len(got)} rows")
    twin = duck.sql(contract.oracle_sql()[key])
    assert sorted(twin.columns) == names
    quoted = ", ".join(f'"{n}"' for n in names)
    want = plain(duck.execute(f"SELECT {quoted} FROM ({contract.oracle_sql()[key]})").fetchall())
    assert len(got) == len(want)
    assert got == want
