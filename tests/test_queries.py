"""Every query with SQL gives DuckDB's rows on the smallest tables; the others give rows."""

import decimal

import duckdb
import pyarrow as pa
import pytest

from vellum.plans import catalogue

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def plain(table: pa.Table) -> list[tuple]:
    def value(v):
        if isinstance(v, decimal.Decimal):
            v = int(v) if v == int(v) else float(v)
        if isinstance(v, list):
            return str([value(x) for x in v])
        if v is None or (isinstance(v, float) and v != v):
            return ""
        return repr(round(v, 9)) if isinstance(v, float) else str(v)

    return sorted(tuple(value(v) for v in row.values()) for row in table.select(sorted(table.column_names)).to_pylist())


@pytest.mark.parametrize("name", catalogue.queries())
def test_query(spark, duck, name):
    found = catalogue.queries()[name](spark, SMALL).toArrow()
    assert found.num_rows
    if sql := catalogue.oracle_sql().get(name):
        expected = duck.execute(sql).to_arrow_table()
        assert sorted(found.column_names) == sorted(expected.column_names)
        assert plain(found) == plain(expected)
