"""Every query of the library's own operators against its SQL in DuckDB, on the smallest tables."""

import datetime
import math

import duckdb
import pytest

from stratalake import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return str([plain(x) for x in v])
    if isinstance(v, datetime.datetime) and v.tzinfo:
        return v.replace(tzinfo=None)
    return int(v) if hasattr(v, "as_tuple") else v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=lambda r: tuple((x is not None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    found = registry.QUERIES[name](spark, SF)
    got = rows(found.columns, found.collect())
    if name in registry.ORACLES:
        want = duck.sql(registry.ORACLES[name])
        assert not [t for t in map(str, want.types) if "DECIMAL" in t or "HUGEINT" in t]
        assert sorted(found.columns) == sorted(want.columns)
        assert got == rows(want.columns, want.fetchall())
    else:
        assert got


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
