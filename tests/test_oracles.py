"""Every query that has a DuckDB oracle must match it at sf0.001
(rows, columns, values rounded to 6 places) -- the same gate the driver
runs at sf0.01."""

import math

import pytest

from tests.conftest import SF001

TABLES = ["documents", "labels", "embeddings", "conversations", "benchmark", "pages"]


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_integer_ratio") and not isinstance(v, int):
        return round(float(v), 6)
    return v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _keys():
    import __spark_entry__ as E

    # the training-data operators have tests of their own
    return sorted(k for k in E.oracle_sql() if not k.startswith("op"))


@pytest.mark.parametrize("key", _keys())
def test_matches_oracle(spark, duck, key):
    import __spark_entry__ as E

    df = E.queries()[key](spark, SF001)
    cols = sorted(df.columns)
    rows = [r.asDict() for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    assert cols == sorted(rel.columns)
    types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: TYPES.get(t, types[c]) for c, t in df.dtypes} == types
    orows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    a = sorted((tuple(_norm(r[c]) for c in cols) for r in rows), key=repr)
    b = sorted((tuple(_norm(r[c]) for c in cols) for r in orows), key=repr)
    assert a == b
