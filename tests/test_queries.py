"""Every query with SQL against DuckDB on the same files; the others run and give rows."""

import math
import os

import duckdb
import pytest

from tessera.plans.catalogue import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def canonical(rows):
    def one(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 5)
        return str(v).removesuffix(" 00:00:00") if v is not None and not isinstance(v, (int, str, bool)) else v

    return sorted((tuple(one(v) for v in r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in sorted(os.listdir(SF)):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    assert got
    if name in ORACLE_SQL:
        sql = ORACLE_SQL[name]
        want = duck.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()
        assert canonical(got) == canonical(want)
        types = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date"}
        kinds = {c: types.get(str(t), str(t)) for c, t in zip(duck.sql(sql).columns, duck.sql(sql).types, strict=True)}
        assert kinds == dict(df.dtypes)
