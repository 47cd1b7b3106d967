"""Every registered query vs its DuckDB oracle on the smallest scale factor."""

import math

import duckdb
import pytest

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _keys():
    import __spark_entry__ as E
    return sorted(E.oracle_sql())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("key", _keys())
def test_query_matches_oracle(spark, con, key):
    import __spark_entry__ as E
    sdf = E.queries()[key](spark, SF_SMALL)
    rel = con.sql(E.oracle_sql()[key])
    dtypes = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    assert stypes == dtypes
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(dcols, res.fetchall())
