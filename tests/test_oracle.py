"""Every query that has SQL gives the rows that SQL gives."""

import duckdb
import pytest

from cellweave.jobs.file_registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    df = QUERIES[name](spark, DATA)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{DATA}/events.parquet'")
    found = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    want = rows_of(columns, found.fetchall())
    assert sorted(columns) == sorted(df.columns)
    assert got == want
    assert got
