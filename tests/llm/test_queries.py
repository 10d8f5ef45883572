"""Registered queries against their SQL form on the same tables."""

import duckdb
import pytest

import covaria.llm as llm
from tests.test_oracle import _comparable

ORACLES = llm.oracle_sql()
TYPES = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    df = llm.queries()[name](spark, sf_dir)
    connection = duckdb.connect()
    for name_ in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{sf_dir}/{name_}.parquet'")
    result = connection.execute(ORACLES[name])
    theirs = _comparable([d[0] for d in result.description], result.fetchall())
    types = {d[0]: str(d[1]) for d in result.description}
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    ours = _comparable(df.columns, [tuple(r) for r in df.collect()])
    assert ours == theirs and ours[1]
